"""Dashboards over cluster profiles of several months."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanbook import params as P
from loanbook.functions import buckets as B
from loanbook.functions import metrics as M
from loanbook.functions import rules as R
from loanbook.operators import clusters as C
from loanbook.plans.skew import skew_join
from loanbook.sources.hot import UNKNOWN, HotKeys

AMOUNT_SEGMENTS = ("all", "secured", "unsecured", "other_product")
PART_SEGMENTS = (
    "all", "only_self", "with_others", "others", "mixed", "self_lender", "other_lender", "cl", "noncl", *C.BY_KIND,
)


def _dpd(name: str) -> Column:
    return B.bucket(F.col(name), B.DPD7).alias(f"{name}_bucket")


def _amount(name: str) -> Column:
    return B.bucket(F.col(name), B.AMOUNT6).alias(f"{name}_bucket")


def _count(name: str) -> Column:
    return B.bucket(F.col(name), B.LOAN_COUNT6).alias(f"{name}_bucket")


def _cluster_counts() -> list[Column]:
    """Profiles hold one row per cluster and month, so clusters are counted as rows.

    Corrected: segment counts ask for a loan in the segment; counting non-NULL
    flags would always give the total.
    """
    mix = F.col("clust_ind")
    out = [
        F.count(F.lit(1)).alias("total_clusters"),
        M.count_if(F.col("active_loans_all") != 0, "active_clusters"),
        M.count_if(mix == C.ONLY_SELF, "only_self_clusters"),
        M.count_if(mix == C.SELF_WITH_OTHERS, "with_others_clusters"),
        M.count_if(mix == C.OTHER, "other_clusters"),
    ]
    for seg in ("self_lender", "other_lender", *C.BY_KIND):
        out.append(M.count_if(F.col(f"clusters_{seg}") > 0, f"total_clusters_{seg}"))
    return out


def _sums(*names: str) -> list[Column]:
    return [F.expr(f"sum({n}) as {n}") for n in names]


def portfolio_dashboard(profile: DataFrame) -> DataFrame:
    """Months x DPD band x four balance bands x lender mix."""
    amounts = [f"outstanding_{s}" for s in AMOUNT_SEGMENTS]
    keyed = profile.select("*", _dpd("max_dpd_all"), *[_amount(a) for a in amounts])
    average = R.ratio(
        F.sum("outstanding_all"), F.when(F.sum("active_loans_all") == 0, 1).otherwise(F.sum("active_loans_all"))
    )
    return keyed.groupBy("as_of", "max_dpd_all_bucket", *[f"{a}_bucket" for a in amounts], "clust_ind").agg(
        *_cluster_counts(),
        *_sums(*[f"active_loans_{s}" for s in PART_SEGMENTS]),
        *_sums(*[f"outstanding_{s}" for s in PART_SEGMENTS]),
        average.alias("avg_outstanding"),
    )


def account_count_dashboard(profile: DataFrame) -> DataFrame:
    """Months x DPD band x three active-loan-count bands x lender mix."""
    counts = ["active_loans_all", "active_loans_secured", "active_loans_unsecured"]
    keyed = profile.select("*", _dpd("max_dpd_all"), *[_count(c) for c in counts])
    return keyed.groupBy("as_of", "max_dpd_all_bucket", *[f"{c}_bucket" for c in counts], "clust_ind").agg(
        *_cluster_counts(), *_sums("active_loans_all", *[f"active_loans_{s}" for s in C.BY_KIND])
    )


def account_dashboard(base: DataFrame, profile: DataFrame, self_lender: str, hot: HotKeys = UNKNOWN) -> DataFrame:
    """Account rows joined with their cluster's profile, by eight bucket keys.

    `profile` names the newest row with a known income of each cluster
    (`top_row`); incomes and dues count there alone. Rows of `base` are unique
    by account and consumer, and are reduced to one per (keys, cluster,
    account) before the two kinds of distinct counts.
    """
    rows = base.where((F.col("threshold_flag_overall") == 1) & (F.col("threshold_acnt_type") == 1))
    facts = profile.select("as_of", "clst_id", "clust_ind", "loans_all", "active_loans_all", *C.TOP_ROW.values())
    joined = skew_join(rows, facts, ["as_of", "clst_id"], "inner", "account_key", known=hot.clusters)
    status = F.col("das").isin(*P.ACTIVE_PORTFOLIO)
    top = (F.col("account_key") == F.col("top_account")) & (F.col("consumer_key") == F.col("top_consumer"))
    keyed = joined.select(
        "as_of", "clust_ind",
        B.bucket(C.loan_amount(), B.AMOUNT6).alias("ticket_size"),
        R.lender_type(F.col("lender_id"), self_lender).alias("lender_type"),
        R.product_class(F.col("account_type"), "dashboard").alias("product"),
        _count("loans_all"), _count("active_loans_all"),
        B.dpd_account(F.col("dpd"), status).alias("dpd_bucket"),
        "clst_id", "account_key",
        C.active().alias("live"), "current_balance", C.loan_amount().alias("amount"),
        F.when(top & (F.col("min_amt_threshold") == 1), F.col("min_amount_due")).alias("due"),
        F.when(top, F.col("annual_income")).alias("income"),
    )
    keys = ["as_of", "clust_ind", "ticket_size", "lender_type", "product", "loans_all_bucket",
            "active_loans_all_bucket", "dpd_bucket"]
    reduced = keyed.groupBy(*keys, "clst_id", "account_key").agg(
        M.any_if(F.col("live"), "live"),
        M.sum_if(F.col("live"), F.col("current_balance"), "total_act_outstanding_amount"),
        F.sum("amount").alias("total_disb_amount"),
        M.sum_if(F.col("live"), F.col("amount"), "total_act_disb_amount"),
        F.sum("due").alias("min_amount_due"), F.sum("income").alias("annual_income"),
    )
    # A filter keeps both counts of an entity in one distinct group, so rows are expanded per entity, not per count.
    return reduced.groupBy(*keys).agg(
        F.count_distinct("clst_id").alias("total_clusters"),
        F.expr("count(distinct clst_id) filter (where live = 1)").alias("active_clusters"),
        F.count_distinct("account_key").alias("total_loans"),
        F.expr("count(distinct account_key) filter (where live = 1)").alias("total_active_loans"),
        *_sums("total_act_outstanding_amount", "total_disb_amount", "total_act_disb_amount", "min_amount_due",
               "annual_income"),
    )


def income_backfill(profile: DataFrame, prior: DataFrame) -> DataFrame:
    """Missing or zero income replaced by the greatest earlier one of the cluster."""
    old = prior.groupBy("clst_id").agg(F.max("annual_income_all").alias("old_income"))
    income = F.col("annual_income_all")
    return profile.join(old, "clst_id").withColumn(
        "annual_income_latest", F.when(R.zero_if_null(income) == 0, F.col("old_income")).otherwise(income)
    ).drop("old_income")


DTI_COLUMNS = (
    "as_of", "clst_id", "clust_ind", "min_due_all", "annual_income_all", "outstanding_all", "active_loans_all",
)


def dti_table(profile: DataFrame) -> DataFrame:
    """Debt, portfolio and minimum-due ratios per cluster, on the back-filled income."""
    ratios = R.debt_ratios(
        F.col("min_due_all"), F.col("annual_income_latest"), F.col("outstanding_all"), F.col("active_loans_all")
    )
    return profile.select("*", *[expr.alias(name) for name, expr in ratios.items()])


DPD_COLUMNS = tuple(
    f"max_dpd_{s}" for s in ("all", "only_self", "with_others", "others", "mixed", "self_lender", "other_lender")
)


DTI_SUMS = (
    "loans_all", "active_loans_all", "outstanding_all", "disb_all", "act_disb_all",
    "min_due_all", "min_due_only_self", "min_due_with_others", "min_due_others",
    "annual_income_all", "annual_income_only_self", "annual_income_with_others", "annual_income_mixed",
    "annual_income_others",
)
DTI_DASHBOARD_COLUMNS = tuple(dict.fromkeys((
    *DTI_COLUMNS, *DPD_COLUMNS, *DTI_SUMS, *[f"clusters_{s}" for s in ("self_lender", "other_lender", *C.BY_KIND)],
)))


def dti_dashboard(ratios: DataFrame) -> DataFrame:
    """Clusters and sums by seven DPD bands, five ratio bands, month and lender mix."""
    ratio_bands = {
        "debt_income_ratio_bucket": (F.col("debt_income_ratio") * 100, B.DTI6),
        "debt_to_income_final_bucket": (F.col("debt_to_income_final"), B.DTI6),
        "debt_to_income_active_bucket": (F.col("debt_to_income_active"), B.DTI6),
        "portfolio_to_income_bucket": (F.col("portfolio_to_income"), B.PTI6),
        "min_due_ratio_bucket": (F.col("min_due_ratio"), B.MIN_DUE_RATIO10),
    }
    keyed = ratios.select(
        "*", *[_dpd(c) for c in DPD_COLUMNS],
        *[B.bucket(value, spec).alias(name) for name, (value, spec) in ratio_bands.items()],
    )
    return keyed.groupBy("as_of", *[f"{c}_bucket" for c in DPD_COLUMNS], *ratio_bands, "clust_ind").agg(
        *_cluster_counts(), *_sums(*DTI_SUMS),
    )
