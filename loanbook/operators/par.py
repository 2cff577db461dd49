"""Portfolio-at-risk reports and the monitor on their monthly changes."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanbook import params as P
from loanbook.functions import rules as R
from loanbook.plans.skew import pick_last

# fixed values: DPD bands of the report
BANDS = {
    "0": "(dpd = 0 or dpd is null)", "1_30": "dpd between 1 and 30", "31_60": "dpd between 31 and 60",
    "61_90": "dpd between 61 and 90", "91_180": "dpd between 91 and 180", "181_360": "dpd between 181 and 360",
    "360_plus": "dpd >= 361",
}
COUNTS = ("total_loans", "active_loans", *[f"lar_{b}" for b in BANDS], "total_written_off_loans")
AMOUNTS = ("total_disb_amount", "active_disb_amount", "active_outstanding", *[f"par_{b}" for b in BANDS],
           "total_written_off_amount")
METRICS = (
    "total_loans", "total_disb_amount", "active_loans", "active_disb_amount", "active_outstanding",
    *[f"lar_{b}" for b in BANDS], *[f"par_{b}" for b in BANDS], "total_written_off_loans",
    "total_written_off_amount",
)
# metrics whose later value is reported besides the change
SHOWN = (
    "total_loans", "total_disb_amount", "active_loans", "active_disb_amount", "active_outstanding",
    "total_written_off_loans", "total_written_off_amount",
)


def risk_rows(rows: DataFrame, end: date | Column, raw: bool = False) -> DataFrame:
    """Distinct account rows with DPD, amounts and the live flag.

    `raw` takes DPD from the text field alone and the plain disbursed amount;
    otherwise the derived DPD and the loan amount are used. In both, a DPD
    above zero already implies the overdue condition of the bands.
    """
    if raw:
        dpd = R.raw_dpd(F.col("days_past_due"))
        amount = F.abs("disbursed_amount")
        closed = R.not_closed(F.col("closed_dt"), end) == "N"
    else:
        dpd = R.derived_dpd(F.col("days_past_due"), F.col("asset_class"), F.col("das"))
        amount = R.loan_amount(F.col("high_credit"), F.col("disbursed_amount"), F.col("credit_limit"))
        closed = R.closed_ind_noc(F.col("closed_dt"), F.col("das"), end) == "Y"
    overdue = F.abs("amount_overdue_total")
    return rows.select(
        "account_key", "account_type", "lender_id", "reported_dt", "closed_dt", "das",
        F.abs("current_balance").alias("current_balance"), overdue.alias("amount_overdue_total"),
        F.abs("chargeoff_amt").alias("chargeoff_amt"), dpd.alias("dpd"), amount.alias("amount"),
        (F.col("das").isin(*P.ACTIVE_STRICT) & ~closed).alias("is_live"),
        *[c for c in ("run",) if c in rows.columns],
    ).distinct()


def risk_metrics(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Loans and balances at risk per key.

    An account counts once per report date, and the dates add up: rows are
    reduced to (keys, date, account) with flags, which are then summed.
    """
    written = "das in ('S06', 'S13')"
    per_account = [
        "sum(amount) as total_disb_amount", "max(int(is_live)) as active_loans",
        "sum(if(is_live, amount, 0)) as active_disb_amount",
        "sum(if(is_live, current_balance, 0)) as active_outstanding",
        f"max(int({written})) as total_written_off_loans",
        f"sum(if({written}, chargeoff_amt, 0)) as total_written_off_amount",
    ]
    for band, test in BANDS.items():
        per_account.append(f"max(int(is_live and {test})) as lar_{band}")
        per_account.append(f"sum(if(is_live and {test}, current_balance, 0)) as par_{band}")
    reduced = rows.groupBy(*dict.fromkeys([*keys, "reported_dt", "account_key"])).agg(
        *[F.expr(e) for e in per_account]
    )
    totals = ["count(account_key) as total_loans"] + [
        f"cast(sum(coalesce({c}, 0)) as bigint) as {c}" for c in COUNTS[1:]
    ] + [f"sum({c}) as {c}" for c in AMOUNTS]
    return reduced.groupBy(*keys).agg(*[F.expr(e) for e in totals])


def _with_institution(report: DataFrame, lender_dim: DataFrame) -> DataFrame:
    names = lender_dim.where(F.col("active") == 1).select("lender_id", F.col("institution_name").alias("institution"))
    return report.join(F.broadcast(names), "lender_id", "left")


def par_report(rows: DataFrame, lender_dim: DataFrame, as_of: date) -> DataFrame:
    """Lender x product: loans, active loans, loans and portfolio at risk in seven bands, write-offs."""
    report = risk_metrics(risk_rows(rows, as_of), ["lender_id", "account_type"])
    return _with_institution(report, lender_dim).select(
        F.lit(as_of).alias("reported_dt"), "lender_id", "institution", "account_type", *METRICS
    )


def par_report_one_lender(
    rows: DataFrame, lender_dim: DataFrame, as_of: date, lender: str, account_types: tuple[str, ...]
) -> DataFrame:
    """The same report for one lender and some products, on raw DPD and rows known by `as_of`."""
    chosen = rows.where(
        (F.col("lender_id") == lender) & F.col("account_type").isin(*account_types)
        & (F.col("reported_dt") <= F.lit(as_of)) & (F.col("disbursed_dt") <= F.lit(as_of))
    )
    report = risk_metrics(risk_rows(chosen, as_of, raw=True), ["lender_id", "account_type"])
    return _with_institution(report, lender_dim).select(
        F.lit(as_of).alias("reported_dt"), "lender_id", "institution", "account_type",
        *[m for m in METRICS if m not in ("lar_0", "par_0")],
    )


def par_report_by_month(rows: DataFrame, lender_dim: DataFrame) -> DataFrame:
    """The report for every report date and run found in `rows`: the appended report history."""
    report = risk_metrics(
        risk_rows(rows, F.col("reported_dt")), ["run", "reported_dt", "lender_id", "account_type"]
    )
    return _with_institution(report, lender_dim).select(
        "run", "reported_dt", "lender_id", "institution", "account_type", *METRICS
    )


# --- monitor -------------------------------------------------------------------------
REPORT_KEYS = ["lender_id", "reported_dt", "account_type"]


def report_dedupe(report: DataFrame, as_of: date) -> DataFrame:
    """The run with the most loans per (lender, date, product), over the last four months."""
    recent = report.where(
        F.col("reported_dt").between(F.lit(P.shift_months(as_of, -3)), F.lit(as_of))
    )
    return pick_last(recent, REPORT_KEYS, [F.col("total_loans"), F.col("run")]).drop("run")


def month_over_month(report: DataFrame, as_of: date) -> DataFrame:
    """Change of 21 metrics from each month to the next, keeping one-sided months inside the range.

    Each report row is counted once as the earlier and once as the later side
    of a pair, so the full outer self join becomes one aggregate.
    """
    first = P.shift_months(as_of, -3)
    sides = F.explode(F.array(
        F.struct(R.shift_month(F.col("reported_dt"), 1).alias("pair_dt"), F.lit(True).alias("is_from")),
        F.struct(F.col("reported_dt").alias("pair_dt"), F.lit(False).alias("is_from")),
    ))
    rows = report.where(F.col("account_type").isNotNull()).select("*", sides.alias("side"))
    rows = rows.select("*", "side.pair_dt", "side.is_from")
    aggs = [
        "max(if(is_from, reported_dt, null)) as reported_dt_from",
        "max(if(not is_from, reported_dt, null)) as reported_dt_to",
        "max(if(is_from, institution, null)) as institution_from",
        "max(if(not is_from, institution, null)) as institution_to",
    ]
    for m in METRICS:
        aggs += [f"max(if(is_from, {m}, null)) as a_{m}", f"max(if(not is_from, {m}, null)) as b_{m}"]
    pairs = rows.groupBy("lender_id", "account_type", "pair_dt").agg(*[F.expr(a) for a in aggs])
    inside = (F.col("reported_dt_to") != F.lit(first)) | (F.col("reported_dt_from") != F.lit(as_of))
    out = []
    for m in METRICS:
        if m in SHOWN:
            out.append(f"coalesce(b_{m}, 0) as {m}_to")
        out.append(f"coalesce(b_{m}, 0) - coalesce(a_{m}, 0) as {m}_diff")
        change = f"try_divide(cast(b_{m} - a_{m} as double), cast(a_{m} as double)) * 100"
        out.append(
            f"if(a_{m} is null or b_{m} is null, 0D, cast(round(cast({change} as decimal(38,8)), 2) as double))"
            f" as {m}_perc_diff"
        )
    return pairs.where(inside).selectExpr(
        f"'{as_of:%Y%m}' as month_run", "lender_id", "coalesce(institution_to, institution_from) as institution",
        "account_type", "reported_dt_from", "reported_dt_to", *out,
    )


def share_filter(report: DataFrame) -> DataFrame:
    """Lenders holding more than half a percent of a product's active balance at a date."""
    total = F.sum("active_outstanding").over(Window.partitionBy("reported_dt", "account_type"))
    shares = report.select(*REPORT_KEYS, "active_outstanding", total.alias("total"))
    return shares.where(F.col("active_outstanding") * 200 > F.col("total")).select(*REPORT_KEYS).distinct()


def report_outliers(changes: DataFrame, material: DataFrame) -> DataFrame:
    """All months of any (lender, product) that moved sharply in a material month.

    Loans and balance move sharply at 10 percent, bands of loans at risk at 20.
    """
    limits = {"active_loans": 10, "active_outstanding": 10}
    limits.update({f"lar_{b}": 20 for b in BANDS if b != "0"})
    sharp = " or ".join(f"abs({m}_perc_diff) >= {n}" for m, n in limits.items())
    moved = changes.where(sharp).where("reported_dt_from is not null and reported_dt_to is not null").select(
        "lender_id", "account_type", F.explode(F.array("reported_dt_from", "reported_dt_to")).alias("reported_dt")
    )
    outliers = moved.join(material, REPORT_KEYS, "left_semi").select("lender_id", "account_type").distinct()
    return changes.join(outliers, ["lender_id", "account_type"], "left_semi")
