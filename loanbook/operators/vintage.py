"""Vintage cubes of the retail and the commercial book."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanbook import params as P
from loanbook.functions import buckets as B
from loanbook.functions import rules as R

_ZERO = "(derived_dpd = 0 or derived_dpd is null)"
_OVER = "amount_overdue_total > 0.01 * coalesce(sanctioned_amount, 0)"
# fixed values: delinquency bands of the cubes
CUBE_BANDS = {
    "ns": f"{_ZERO} and {_OVER}", "curr": f"{_ZERO} and not ({_OVER})", "dpd_0": _ZERO,
    "dpd_1_30": "derived_dpd between 1 and 30", "dpd_31_60": "derived_dpd between 31 and 60",
    "dpd_61_90": "derived_dpd between 61 and 90", "dpd_91_180": "derived_dpd between 91 and 180",
    "dpd_181_360": "derived_dpd between 181 and 360", "dpd_91_360": "derived_dpd between 91 and 360",
    "dpd_gtr_360": "derived_dpd > 360", "dpd_gtr_30": "derived_dpd > 30", "dpd_gtr_60": "derived_dpd > 60",
    "dpd_gtr_90": "derived_dpd > 90",
}
CUBE_KEYS = [
    "ind", "account_type", "product_category", "ticket_size", "disbursed_dt", "lender_type", "lender_type1",
    "lender_type2", "mob", "act_reported_dt",
]


def lender_columns(lender: Column, p: P.RunParams) -> list[Column]:
    """Lender class and the two peer lists, with the self lender named apart."""
    return [
        R.lender_class(lender, p.self_lender).alias("lender_type"),
        R.peer_group(lender, p.vintage_group_1, "OTHERS", p.self_lender).alias("lender_type1"),
        R.peer_group(lender, p.vintage_group_2, "OTHERS", p.self_lender).alias("lender_type2"),
    ]


def retail_columns(day: Column, balance: Column, amounts: list[Column]) -> list[Column]:
    """Delinquency, open flag, balances and exposure of one account row reported at `day`."""
    return [
        R.derived_dpd(F.col("days_past_due"), F.col("asset_class"), F.col("das")).alias("derived_dpd"),
        F.last_day(day).alias("act_reported_dt"),
        R.zero_if_null(F.abs(balance)).alias("current_balance"),
        R.zero_if_null(F.abs("amount_overdue_total")).alias("amount_overdue_total"),
        F.abs("chargeoff_amt").alias("chargeoff_amt"),
        R.not_closed(F.col("closed_dt"), day).alias("not_closed_ind"),
        R.exposure_amount(balance, *amounts).alias("sanctioned_amount"),
    ]


TREND_COLUMNS = (
    "account_key", "lender_id", "act_reported_dt", "reported_dt", "current_balance", "days_past_due", "asset_class",
    "das", "closed_dt", "amount_overdue_total", "chargeoff_amt",
)
TERMS = ("high_credit", "disbursed_amount", "credit_limit", "account_type", "disbursed_dt")


def retail_rows(source: DataFrame, ind: str) -> DataFrame:
    """Rule columns over rows that carry both a report and the account's terms."""
    day = F.col("act_reported_dt")
    amounts = [F.col(c) for c in ("high_credit", "disbursed_amount", "credit_limit")]
    return source.select(
        F.lit(ind).alias("ind"), "account_key", "lender_id", "account_type", "das", "closed_dt",
        F.col("disbursed_dt").alias("disbursed_on"),
        F.last_day("disbursed_dt").alias("disbursed_dt"),
        R.months_on_book(day, F.col("disbursed_dt")).alias("mob"),
        *retail_columns(day, F.col("current_balance"), amounts),
    )


def with_terms(trend: DataFrame, prod: DataFrame) -> DataFrame:
    """History rows with the static terms of their account."""
    return trend.select(*TREND_COLUMNS).join(prod.select("account_key", *TERMS), "account_key")


def cube(rows: DataFrame, statuses) -> DataFrame:
    """5 totals, 13 loan counts and 13 balances per cube key, in one aggregate."""
    live = f"not_closed_ind = 'Y' and das in ({', '.join(repr(s) for s in statuses)})"
    aggs = [
        "count(account_key) as total_loans", "count_if(live) as active_loans",
        "sum(sanctioned_amount) as total_disb_amount",
        "sum(if(live, sanctioned_amount, 0)) as total_activ_disb_amount",
        "sum(if(live, current_balance, 0)) as total_active_pos",
    ]
    for band, test in CUBE_BANDS.items():
        aggs.append(f"count_if(live and {test}) as loans_{band}")
        aggs.append(f"sum(if(live and {test}, current_balance, 0)) as pos_{band}")
    return rows.withColumn("live", F.expr(live)).groupBy(*CUBE_KEYS).agg(*[F.expr(a) for a in aggs])


def vintage_cube(trend: DataFrame, prod: DataFrame, p: P.RunParams) -> DataFrame:
    """Retail cube from history (T) and current rows (P) of non-commercial accounts.

    `prod` carries commercial_ind of the cross-bureau match.
    """
    reported = F.col("reported_dt").between(F.lit(p.vintage_reported_from), F.lit(p.as_of))
    eligible = prod.where(
        F.col("account_type").isin(*P.VINTAGE_TYPES) & (F.col("active") == 1) & (F.col("commercial_ind") != 1)
        & (F.col("disbursed_dt") >= F.lit(p.vintage_disbursed_from))
    )
    past = retail_rows(with_terms(trend.where(reported), eligible), "T")
    current = retail_rows(eligible.where(reported), "P")
    rows = past.unionByName(current).select(
        "*",
        R.product_category(F.col("account_type")).alias("product_category"),
        B.bucket(F.col("sanctioned_amount"), B.AMOUNT10).alias("ticket_size"),
        *lender_columns(F.col("lender_id"), p),
    )
    return cube(rows, P.ACTIVE_BOOK)


def _commercial_rows(source: DataFrame, ind: str, p: P.RunParams) -> DataFrame:
    text = F.coalesce("dpd", F.lit("0"))
    day = F.col("reported_dt")
    exposure = R.exposure_amount(F.col("current_balance"), F.col("sanctioned_amount"), F.col("drawing_power"))
    rows = source.select(
        F.lit(ind).alias("ind"), "account_key", F.col("credit_type").alias("account_type"), "das",
        F.last_day("sanctioned_dt").alias("disbursed_dt"), day.alias("act_reported_dt"),
        R.months_on_book(day, F.col("sanctioned_dt")).alias("mob"),
        R.zero_if_null(F.abs("current_balance")).alias("current_balance"),
        R.zero_if_null(F.abs("amount_overdue_total")).alias("amount_overdue_total"),
        exposure.alias("sanctioned_amount"),
        R.derived_dpd_commercial(text, R.norm_asset_class(F.col("asset_class")), F.col("das")).alias("derived_dpd"),
        R.not_closed(F.coalesce("loan_expiry_dt", "closed_dt"), day).alias("not_closed_ind"),
        *lender_columns(F.col("contributor_id"), p),
    )
    return rows.select(
        "*",
        R.product_category(F.col("account_type"), "commercial").alias("product_category"),
        B.bucket(F.col("sanctioned_amount"), B.AMOUNT10).alias("ticket_size"),
    )


def vintage_cube_commercial(trend: DataFrame, prod: DataFrame, p: P.RunParams) -> DataFrame:
    """Commercial cube: expiry counts as closing, missing DPD as zero, other status list."""
    reported = F.col("reported_dt").between(F.lit(p.vintage_reported_from), F.lit(p.as_of))
    eligible = prod.where(F.col("sanctioned_dt") >= F.lit(p.vintage_disbursed_from))
    terms = eligible.select("account_key", "sanctioned_dt", "credit_type")
    past = _commercial_rows(trend.where(reported).join(terms, "account_key"), "T", p)
    current = _commercial_rows(eligible.where(reported), "P", p)
    return cube(past.unionByName(current), P.ACTIVE_PORTFOLIO)
