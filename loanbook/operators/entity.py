"""Borrower resolution: clusters, best rows and surviving attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanbook.functions import rules as R
from loanbook.plans.skew import hot_among, pick_first, pick_last, skew_join
from loanbook.sources.hot import UNKNOWN, HotKeys

SURVIVING = ("monthly_income", "annual_income", "birth_dt", "gender", "occupation")


def cluster_map(pairs: DataFrame) -> DataFrame:
    """Greatest cluster id per candidate."""
    return pairs.groupBy("candidate_id").agg(F.max("clst_id").alias("clst_id"))


def _by_consumer(clusters: DataFrame) -> DataFrame:
    return clusters.select(F.col("candidate_id").alias("consumer_key"), "clst_id")


def attach_cluster(
    rows: DataFrame, clusters: DataFrame, keys_like: DataFrame | None = None, known: list | None = None
) -> DataFrame:
    """Cluster of each row's consumer; consumers without one stand for themselves."""
    joined = skew_join(rows, _by_consumer(clusters), ["consumer_key"], "left", "account_key", keys_like, known=known)
    return joined.withColumn("clst_id", F.coalesce("clst_id", "consumer_key"))


def attach_inner(
    rows: DataFrame, clusters: DataFrame, keys_like: DataFrame | None = None, known: list | None = None
) -> DataFrame:
    """Rows whose consumer has a cluster, with that cluster."""
    return skew_join(rows, _by_consumer(clusters), ["consumer_key"], "inner", "account_key", keys_like, known=known)


def same_cluster_universe(base: DataFrame, clusters: DataFrame, accounts: DataFrame) -> DataFrame:
    """All account rows of every member of any cluster that a base consumer belongs to."""
    touched = clusters.join(
        base.select(F.col("consumer_key").alias("candidate_id")).distinct(), "candidate_id", "left_semi"
    ).select("clst_id").distinct()
    members = clusters.join(touched, "clst_id", "left_semi")
    return attach_inner(accounts, members, keys_like=accounts)


def latest_consumer(consumer: DataFrame) -> DataFrame:
    """Newest row per consumer (ties: the greatest account)."""
    return pick_last(consumer, ["consumer_key"], [F.col("insert_dt"), F.col("account_key")])


def unique_account_row(party: DataFrame, geo_fill: DataFrame) -> DataFrame:
    """Best consumer row per account: fullest address, then ownership, then consumer.

    Corrected: the three ranks are compared one after the other and not as one
    concatenated text, in which 10 sorts before 2.
    """
    parts = ["state", "district", "pin_code"]
    fill = geo_fill.select("consumer_key", *[F.col(c).alias(f"fill_{c}") for c in parts])
    filled = party.join(fill, "consumer_key", "left").select(
        *[c for c in party.columns if c not in parts],
        *[F.coalesce(c, f"fill_{c}").alias(c) for c in parts],
    )
    ranked = filled.select(
        "*",
        R.sdp_rank(*[F.col(c) for c in parts]).alias("sdp"),
        R.ownership_flag(F.col("ownership_ind")).alias("ownership_ind_flag"),
    )
    order = [F.col("sdp"), F.col("ownership_ind_flag"), F.col("consumer_key")]
    return pick_first(ranked, ["account_key"], order)


def cross_bureau_flag(retail: DataFrame, commercial: DataFrame) -> DataFrame:
    """commercial_ind = 1 for retail accounts that also exist in the commercial book."""
    found = commercial.select(
        F.col("contributor_id").alias("lender_id"), F.col("account_number").alias("account_nbr")
    ).distinct().withColumn("found", F.lit(1))
    return retail.join(found, ["lender_id", "account_nbr"], "left").withColumn(
        "commercial_ind", F.coalesce("found", F.lit(0))
    ).drop("found")


def _newest() -> list[Column]:
    return [F.col("reported_dt"), F.col("disbursed_dt")]


def _tiebreak() -> list[Column]:
    return [F.col("account_key"), F.col("consumer_key")]


def _golden(members: DataFrame) -> Column:
    """Order of address rows: fullest address, newest report, newest disbursal."""
    rank = R.sdpcl_rank(*[F.col(c) for c in ("state", "district", "pin_code", "city", "locality")])
    return F.struct(-rank, *_newest(), *_tiebreak())


ADDRESS = ("pin_code", "state", "locality", "city", "district")
MEMBER_KEYS = ("consumer_key", "account_key", "lender_id", "clst_id", "disbursed_dt", "reported_dt")


def _golden_aggs(members: DataFrame) -> list[Column]:
    return [
        F.max_by(F.struct(*ADDRESS), _golden(members)).alias("address"),
        F.max(F.coalesce("is_commercial", F.lit(False))).alias("is_commercial"),
    ]


def _survivor_aggs() -> list[Column]:
    out = []
    for name in SURVIVING:
        # incomes prefer the larger value among rows of equal dates
        extra = [F.col(name)] if name.endswith("income") else []
        order = F.when(F.col(name).isNotNull(), F.struct(*_newest(), *extra, *_tiebreak()))
        out.append(F.max_by(name, order).alias(name))
    return out


def golden_address(members: DataFrame) -> DataFrame:
    """Every member row with the best address of its cluster and the cluster's commercial flag."""
    best = members.groupBy("clst_id").agg(*_golden_aggs(members), F.count(F.lit(1)).alias("n_members"))
    return _with_best(members, best, "address.*", "is_commercial")


def _with_best(members: DataFrame, best: DataFrame, *columns: str) -> DataFrame:
    """Member rows with columns of their cluster's one row, which counts its members and so names the hot clusters."""
    hot = hot_among(best, ["clst_id"], "n_members")
    return skew_join(members.select(*MEMBER_KEYS), best.select("clst_id", *columns), ["clst_id"], "left", "account_key", hot=hot)


def survivorship(members: DataFrame) -> DataFrame:
    """Newest non-null value of each attribute per cluster, in one pass."""
    return members.groupBy("clst_id").agg(*_survivor_aggs())


def one_view(members: DataFrame) -> DataFrame:
    """Member rows with best address, commercial flag and surviving attributes: one aggregate, one join."""
    best = members.groupBy("clst_id").agg(*_golden_aggs(members), *_survivor_aggs(), F.count(F.lit(1)).alias("n_members"))
    return _with_best(members, best, "address.*", "is_commercial", *SURVIVING)


def market_entry(rows: DataFrame, years: tuple[int, ...]) -> DataFrame:
    """Rows disbursed on the first disbursal date of their cluster, labelled with its year if it is one of `years`.

    The join runs on (cluster, date), so a large cluster spreads over its dates.
    """
    first = rows.groupBy("clst_id").agg(F.min("disbursed_dt").alias("disbursed_dt"))
    year = F.year("disbursed_dt")
    return rows.join(first, ["clst_id", "disbursed_dt"], "left_semi").withColumn(
        "entry_year",
        F.when(year.isin(*years), year.cast("string")).otherwise(F.lit("Others")),
    )


def cluster_min_disbursal(snapshot: DataFrame, clusters: DataFrame, per: tuple[str, ...] = ()) -> DataFrame:
    """First disbursal of the cluster, per consumer with a loan; for each value of the columns `per` by itself."""
    per_consumer = snapshot.groupBy(*per, F.col("consumer_key").alias("candidate_id")).agg(
        F.min("disbursed_dt").alias("first_dt")
    )
    linked = clusters.join(per_consumer, "candidate_id")
    first = linked.groupBy(*per, "clst_id").agg(F.min("first_dt").alias("min_disb_dt"))
    return linked.select(*per, "clst_id", F.col("candidate_id").alias("consumer_key")).join(first, [*per, "clst_id"])


def income_extra_cols(consumers: DataFrame, clusters: DataFrame, accounts: DataFrame, hot: HotKeys = UNKNOWN) -> DataFrame:
    """Consumer incomes with cluster and account terms, matched on the cleaned account number."""
    clean = lambda c: F.upper(F.trim(c))
    left = attach_inner(consumers, clusters, known=hot.consumers).withColumn("nbr", clean("account_nbr"))
    right = accounts.select(
        "account_key", clean("account_nbr").alias("nbr"), "min_amount_due", "account_type", "disbursed_dt",
        "suppress_indicator",
    )
    return left.join(right, ["account_key", "nbr"]).drop("nbr")

