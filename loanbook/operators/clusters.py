"""Cluster profile: lender mix, threshold flags, income ranks and the wide metric matrix."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanbook import params as P
from loanbook.functions import metrics as M
from loanbook.functions import rules as R
from loanbook.operators.entity import attach_inner
from loanbook.operators.snapshot import closed_known, derive_account_rows, open_closed_union
from loanbook.plans.rank import descending_ranks
from loanbook.sources.hot import UNKNOWN, HotKeys

# fixed values: lender mix of a cluster
ONLY_SELF = "ONLY SELF"
SELF_WITH_OTHERS = "SELF WITH OTHERS"
OTHER = "OTHER CLUSTERS"

KEYS = ["as_of", "clst_id"]
# A cluster's accounts are dealt out to this many parts, so that a large cluster is never one task's work.
PART, CLUSTER_PARTS = "cluster_part", 8
REPORT_LAG_DAYS = 39


def loan_amount() -> Column:
    return R.loan_amount(F.col("high_credit"), F.col("disbursed_amount"), F.col("credit_limit"))


def active(day: Column | None = None) -> Column:
    return R.is_active(F.col("closed_dt"), F.col("das"), F.col("as_of") if day is None else day)


def cluster_base(
    macro_open: DataFrame, macro_closed: DataFrame, clusters: DataFrame, extra: DataFrame, dates: tuple[date, ...],
    hot: HotKeys = UNKNOWN, by_cluster: bool = False,
) -> DataFrame:
    """Derived account rows with cluster and income columns, for several as-of dates in one scan.

    Every consumer with a cluster touches that cluster, so the same-cluster
    universe of the rows themselves is an inner join with the map. Rows are
    unique per (as_of, account_key, consumer_key).

    What does not depend on the date is derived and joined once for all dates:
    the rows known by the last of them, to be repeated per date at the end. With
    `by_cluster` they are moved there by cluster and `PART`, so that
    `cluster_profile` need not move the rows of every date.
    """
    last = max(dates)
    opened = macro_open.where(F.col("disbursed_dt") <= F.lit(last)).withColumn("opened", F.lit(True))
    closed = macro_closed.withColumn("opened", F.lit(False))
    rows = derive_account_rows(open_closed_union(opened, closed, last, last + timedelta(REPORT_LAG_DAYS)), last)
    joined = attach_inner(rows, clusters, known=hot.consumers).join(extra, ["account_key", "consumer_key"], "left")
    if by_cluster:
        part = F.pmod(F.xxhash64("account_key"), F.lit(CLUSTER_PARTS)).cast("int")
        joined = joined.withColumn(PART, part).repartition("clst_id", PART)
    day = F.col("as_of")
    known = F.when(F.col("opened"), F.col("disbursed_dt") <= day).otherwise(
        closed_known(day, F.date_add(day, REPORT_LAG_DAYS))
    )
    dated = joined.select("*", F.explode(F.array(*[F.lit(d) for d in dates])).alias("as_of")).where(known)
    return dated.withColumn("age", R.age_at(day, F.col("birth_dt"))).drop("opened")


def cluster_mix(rows: DataFrame, self_lender: str) -> DataFrame:
    """Loans per cluster against the self lender's, labelled with the lender mix."""
    counts = M.distinct_rollup(
        rows, KEYS, "account_key",
        flags={"total_loans_self": F.col("lender_id") == self_lender, "total_active_loans": active()},
        sums={"active_outstanding": F.when(active(), F.col("current_balance")).otherwise(0)},
        total="total_loans",
    )
    return counts.withColumn("clust_ind", mix_label(F.col("total_loans"), F.col("total_loans_self")))


def mix_label(total: Column, own: Column) -> Column:
    return F.when(own == 0, F.lit(OTHER)).when(total == own, F.lit(ONLY_SELF)).otherwise(F.lit(SELF_WITH_OTHERS))


def threshold_flags(rows: DataFrame, overall: DataFrame, per_type: DataFrame) -> DataFrame:
    """1 where balance, amount and minimum due stay under their caps, else 0; without a cap 1.

    The one row of overall caps enters as scalar subqueries; the caps per
    account type join by type and only while active.
    """
    caps_row = overall.select(F.struct("balance_cap", "amount_cap", "min_due_cap")).scalar()
    balance = R.zero_if_null(F.abs("current_balance"))
    amount = R.zero_if_null(loan_amount())
    due = R.zero_if_null(F.abs("min_amount_due"))
    caps = per_type.where(F.col("active") == 1).select(
        "account_type", F.col("balance_cap").alias("type_balance"), F.col("amount_cap").alias("type_amount")
    )
    out = rows.join(caps, "account_type", "left")
    under_type = F.col("type_balance").isNull() | (
        (balance <= F.col("type_balance")) & (amount <= F.col("type_amount"))
    )
    return out.select(
        *rows.columns,
        M.flag(caps_row["min_due_cap"].isNull() | (due <= caps_row["min_due_cap"])).alias("min_amt_threshold"),
        M.flag(
            caps_row["balance_cap"].isNull() | ((balance <= caps_row["balance_cap"]) & (amount <= caps_row["amount_cap"]))
        ).alias("threshold_flag_overall"),
        M.flag(under_type).alias("threshold_acnt_type"),
    )


def income_row_rank(rows: DataFrame, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Rank of each row among its cluster's rows with a known income, newest first; NULL without income.

    By report and disbursal date, then income from the largest, account and
    consumer. No large cluster is sorted whole, not even the rows of one that
    share both dates and the income: see `descending_ranks`. What is
    read more than once goes through `keep`, such as a scope's `share`.
    """
    dates, ties = ["reported_dt", "disbursed_dt"], ["account_key", "consumer_key"]
    return descending_ranks(rows, KEYS, dates, {"annual_income": "rw", "monthly_income": "rw_month"}, ties, keep)


# --- metric matrix ------------------------------------------------------------------
# Aggregated segments. Their complements follow by subtraction, and segments
# that depend on the lender mix (one value per cluster) are chosen afterwards,
# so neither needs an aggregate of its own.
SEGMENTS = ("all", "self", "banks", "secured", "unsecured", "cl")
COMPLEMENTS = {
    "other": ("self",), "nonbanks": ("banks",), "other_product": ("secured", "unsecured"), "noncl": ("cl",),
}
MIXED = {
    "only_self": ((ONLY_SELF,), "self"),
    "with_others": ((SELF_WITH_OTHERS,), "all"),
    "mixed": ((ONLY_SELF, SELF_WITH_OTHERS), "all"),
    "others": ((OTHER,), "other"),
}
BY_LENDER = {"self_lender": "self", "other_lender": "other"}
BY_KIND = ("banks", "nonbanks", "secured", "unsecured", "other_product")


def _segment_tests(self_lender: str) -> dict[str, Column]:
    kind, product = R.lender_type(F.col("lender_id")), R.product_class(F.col("account_type"))
    personal = F.col("account_type") == P.CONSUMER_LOAN_TYPE
    return {
        "all": F.lit(True), "self": F.col("lender_id") == self_lender, "banks": kind == "Banks",
        "secured": product == "Secured", "unsecured": product == "Unsecured", "cl": personal,
    }


def _top(income: str) -> Column:
    """Newest row with a known income, as an ordered struct; NULL rows are skipped by max."""
    due = F.when(F.col("min_amt_threshold") == 1, F.col("min_amount_due"))
    payload = F.struct(
        "reported_dt", "disbursed_dt", F.col(income).alias("income"),
        (-F.col("account_key")).alias("account_rank"), (-F.col("consumer_key")).alias("consumer_rank"),
        "lender_id", F.col("kept"), due.alias("min_due"),
    )
    return F.max(F.when(F.col(income).isNotNull(), payload))


def _part(segment: str, measure: str) -> str:
    """The measure inside the segment, 0 for kept accounts outside it, NULL for accounts not kept."""
    return f"case when in_{segment} then {measure} when is_kept = 1 then 0 end"


def _complements() -> list[str]:
    """Metrics of the complement segments.

    Counts subtract. A sum is NULL only if every kept account lies in the
    complement and none carries the amount; then the total is NULL as well.
    """
    out = []
    for name, parts in COMPLEMENTS.items():
        for measure in ("loans", "active_loans"):
            out.append(f"{measure}_all - " + " - ".join(f"{measure}_{s}" for s in parts) + f" as {measure}_{name}")
        sums = ["outstanding"] + ([] if name == "noncl" else ["disb", "act_disb"])
        for measure in sums:
            inside = " + ".join(f"loans_{s}" for s in parts)
            rest = " - ".join(f"coalesce({measure}_{s}, 0)" for s in parts)
            out.append(
                f"if({inside} = 0, {measure}_all, coalesce({measure}_all, 0) - {rest}) as {measure}_{name}"
            )
    return out


def cluster_profile(rows: DataFrame, self_lender: str, top_row: bool = False) -> DataFrame:
    """106 metrics per cluster over the rows under all thresholds, in one pass.

    With `top_row` also the account and consumer of the newest row with a known
    annual income, the one that `income_row_rank` ranks first.

    Step 1 reduces rows to one per (cluster, account); step 2 sums the matrix
    {measure} x {segment} per cluster. Distinct counts are sums of per-account
    flags, so nothing is expanded per metric, and rows of a large cluster
    combine on the map side of both steps. Rows that lie by cluster and `PART`
    are reduced where they are, to one row per part, and only those are moved.
    Lender mix, incomes and minimum due come out of the same pass. An
    account_key identifies one account of one lender and type.
    """
    flagged = rows.withColumn(
        "kept", (F.col("threshold_flag_overall") == 1) & (F.col("threshold_acnt_type") == 1)
    )
    kept, live = F.col("kept"), F.col("kept") & active()
    balance, amount = M.cents(F.col("current_balance")), M.cents(loan_amount())
    # The cluster leads, since sorts compare their first key fastest and dates are few.
    keys = [*reversed(KEYS)]
    part = [PART] if PART in rows.columns else []
    per_account = flagged.groupBy(*keys, *part, "account_key", "lender_id", "account_type").agg(
        M.any_if(kept, "is_kept"), M.any_if(live, "is_live"),
        F.min(F.when(kept, F.col("disbursed_dt"))).alias("min_disb"),
        F.max(F.when(kept, F.col("dpd"))).alias("max_dpd"),
        F.sum(F.when(live, balance).when(kept, 0)).alias("outstanding"),
        F.sum(F.when(kept, amount)).alias("disb"),
        F.sum(F.when(live, amount).when(kept, 0)).alias("act_disb"),
        _top("annual_income").alias("top_annual"), _top("monthly_income").alias("top_monthly"),
    )
    tests = _segment_tests(self_lender)
    per_account = per_account.withColumns({f"in_{name}": test for name, test in tests.items()})
    aggs = ["count(1) as all_loans", "count_if(in_self) as all_loans_self", "max(top_annual) as top_annual",
            "max(top_monthly) as top_monthly"]
    for seg in SEGMENTS:
        aggs += [
            f"sum(if(in_{seg}, is_kept, 0)) as loans_{seg}",
            f"sum(if(in_{seg}, is_live, 0)) as active_loans_{seg}",
            f"sum({_part(seg, 'outstanding')}) as outstanding_{seg}",
        ]
        if seg != "cl":
            aggs += [f"sum({_part(seg, m)}) as {m}_{seg}" for m in ("disb", "act_disb")]
    for seg, test in (("all", "true"), ("self", "in_self"), ("other", "not in_self")):
        aggs += [f"min(if({test}, min_disb, null)) as min_disb_{seg}",
                 f"max(if({test}, max_dpd, null)) as max_dpd_{seg}"]
    per_cluster = per_account.groupBy(*keys).agg(*[F.expr(a) for a in aggs]).where(F.col("loans_all") > 0)
    money = [c for c in per_cluster.columns if c.startswith(("outstanding_", "disb_", "act_disb_"))]
    per_cluster = per_cluster.withColumns({c: M.from_cents(c) for c in money})
    complete = per_cluster.select(
        "*", *[F.expr(e) for e in _complements()],
        mix_label(F.col("all_loans"), F.col("all_loans_self")).alias("clust_ind"),
    )
    first = [(-F.col(f"top_annual.{rank}")).alias(name) for rank, name in TOP_ROW.items()] if top_row else []
    return complete.select(*KEYS, "clust_ind", *_profile_columns(self_lender), *first)


TOP_ROW = {"account_rank": "top_account", "consumer_rank": "top_consumer"}


def _mix_in(labels) -> str:
    return "clust_ind in (" + ", ".join(f"'{x}'" for x in labels) + ")"


def _by_mix(measure: str, default: str) -> list[str]:
    return [
        f"if({_mix_in(labels)}, {measure}_{seg}, {default}) as {measure}_{name}"
        for name, (labels, seg) in MIXED.items()
    ]


def _by_lender(measure: str) -> list[str]:
    return [f"{measure}_{seg} as {measure}_{name}" for name, seg in BY_LENDER.items()]


def _as_is(measure: str, segments) -> list[str]:
    return [f"{measure}_{seg}" for seg in segments]


def _present(name: str, test: str) -> str:
    return f"if({test}, 1L, 0L) as clusters_{name}"


def _profile_columns(self_lender: str) -> list[Column]:
    cols: list[str] = []
    for measure in ("min_disb", "max_dpd"):
        cols += [f"{measure}_all", *_by_mix(measure, "null"), *_by_lender(measure)]
    # inside one cluster a distinct cluster count is 1 where the segment has any loan
    cols.append(_present("all", "loans_all > 0"))
    cols += [
        _present(name, f"{_mix_in(labels)} and loans_{seg} > 0") for name, (labels, seg) in MIXED.items()
    ]
    cols += [_present(seg, f"loans_{seg} > 0") for seg in BY_KIND]
    cols += [_present(name, f"loans_{seg} > 0") for name, seg in BY_LENDER.items()]
    for measure in ("loans", "active_loans", "outstanding"):
        cols += [
            *_as_is(measure, ("all", "cl", "noncl")), *_by_mix(measure, "0"), *_as_is(measure, BY_KIND),
            *_by_lender(measure),
        ]
    for measure in ("disb", "act_disb"):
        cols += [f"{measure}_all", *_by_mix(measure, "0"), *_as_is(measure, BY_KIND), *_by_lender(measure)]
    return [F.expr(c) for c in cols] + _due_columns(self_lender) + _income_columns(self_lender)


def _due_columns(self_lender: str) -> list[Column]:
    """Minimum due of the newest annual-income row.

    A segment is NULL only when all kept rows lie in it and none carries a due.
    """
    top = F.col("top_annual")
    due = F.when(top["kept"], top["min_due"])
    own = top["lender_id"] == self_lender
    cols = [due.alias("min_due_all")]
    cols += [
        F.when(F.col("clust_ind").isin(*labels), due).otherwise(0).alias(f"min_due_{name}")
        for name, (labels, _) in MIXED.items()
    ]
    cols.append(F.coalesce(F.when(own, due), F.when(F.col("loans_other") > 0, 0)).alias("min_due_self_lender"))
    cols.append(F.coalesce(F.when(~own, due), F.when(F.col("loans_self") > 0, 0)).alias("min_due_other_lender"))
    return cols


def _income_columns(self_lender: str) -> list[Column]:
    """Annual income of the newest row, against twelve times the newest monthly one.

    When both are the same row the annual figure alone counts.
    """
    a, m = F.col("top_annual"), F.col("top_monthly")
    yearly = F.when(a["kept"], a["income"])
    same_row = (a["account_rank"] == m["account_rank"]) & (a["consumer_rank"] == m["consumer_rank"])
    monthly = F.when(m["kept"] & ~F.coalesce(same_row, F.lit(False)), m["income"] * 12)

    def best(test=None) -> Column:
        if test is None:
            return F.greatest(yearly, monthly)
        return F.greatest(F.when(test(a), yearly), F.when(test(m), monthly))

    own = lambda top: top["lender_id"] == self_lender
    foreign = lambda top: top["lender_id"] != self_lender
    cols = [best().alias("annual_income_all")]
    cols += [
        F.when(F.col("clust_ind").isin(*labels), best()).alias(f"annual_income_{name}")
        for name, (labels, _) in MIXED.items()
    ]
    return cols + [best(own).alias("annual_income_self_lender"), best(foreign).alias("annual_income_other_lender")]


def account_type_cluster_counts(rows: DataFrame) -> DataFrame:
    """Clusters and loans per account type, all and active.

    Reduced to (type, cluster, account) first; both entities are then counted
    from rows that appear once.
    """
    reduced = rows.groupBy("account_type", "clst_id", "account_key").agg(M.any_if(active(), "live"))
    clusters = M.distinct_rollup(
        reduced, ["account_type"], "clst_id", {"total_active_clusters": F.col("live") == 1}, total="total_clusters"
    )
    loans = M.distinct_rollup(
        reduced, ["account_type"], "account_key", {"total_active_loans": F.col("live") == 1}, total="total_loans"
    )
    return clusters.join(loans, "account_type")
