"""Caps by month, from stored histograms that are merged over months."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanbook.plans.skew import bin_of_rank, exact_in_bin, histogram, in_columns, merged_histogram, percent_rank, stacked

ALL_TYPES = "ALL"
PERCENT = 99
CAPS = {"balance": "balance_cap", "amount": "amount_cap", "due": "min_due_cap"}
KEYS = ["scope", "measure"]
ALL_MONTHS = 999912  # later than any month
NO_MONTH = 0  # of accounts without a report; known from the start


def amounts(accounts: DataFrame, month) -> DataFrame:
    """The capped amounts of accounts, under their type: mon_yr, scope, measure, v, bin."""
    values = {"balance": F.abs("current_balance"), "amount": F.abs("disbursed_amount"), "due": F.abs("min_amount_due")}
    rows = accounts.select(
        F.coalesce(month, F.lit(NO_MONTH)).alias("mon_yr"), F.col("account_type").alias("scope"),
        *[value.alias(name) for name, value in values.items()],
    )
    return stacked(rows, ["mon_yr", "scope"], {name: F.col(name) for name in values})


def _and_all_types(df: DataFrame) -> DataFrame:
    """Every row once for its type and once for all types."""
    return df.withColumn("scope", F.explode(F.array(F.col("scope"), F.lit(ALL_TYPES))))


def month_histograms(rows: DataFrame) -> DataFrame:
    """The histograms of `amounts`, to be stored: one row per month, scope, measure and bin that has any.

    Amounts are counted by type; those of all types are merged from these counts.
    """
    keys = ["mon_yr", *KEYS]
    return merged_histogram(_and_all_types(histogram(rows, keys)), keys)


def caps_at(rows: DataFrame, histograms: DataFrame, months: tuple[int, ...], percent: int = PERCENT) -> DataFrame:
    """Caps of every scope as known in each of the months: mon_yr, scope and the caps.

    The stored histograms up to a month are merged and give the bin of the
    wanted rank; of the accounts only those in that bin are read for the value,
    and repeated per scope and month.
    """
    def upto(df: DataFrame) -> DataFrame:
        known = F.filter(F.array(*[F.lit(m) for m in months]), lambda m: m >= F.col("mon_yr"))
        return df.withColumn("mon_yr", F.explode(known))

    keys = ["mon_yr", *KEYS]
    coarse = bin_of_rank(merged_histogram(upto(histograms), keys), keys, percent_rank(percent))
    wanted = F.broadcast(coarse.select("measure", "bin").distinct())
    near = rows.join(wanted, ["measure", "bin"], "left_semi")
    return in_columns(exact_in_bin(upto(_and_all_types(near)), coarse, keys), ["mon_yr", "scope"], CAPS)


def per_type(caps: DataFrame) -> DataFrame:
    """Caps per account type, as `threshold_flags`, cards and flows take them."""
    return caps.where(F.col("scope") != ALL_TYPES).select(
        F.col("scope").alias("account_type"), "balance_cap", "amount_cap", F.lit(1).alias("active")
    )


def overall(caps: DataFrame) -> DataFrame:
    """One row of caps over all accounts."""
    return caps.where(F.col("scope") == ALL_TYPES).select("balance_cap", "amount_cap", "min_due_cap")
