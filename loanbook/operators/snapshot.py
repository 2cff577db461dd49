"""As-of portfolios rebuilt from current rows, monthly history and restatements."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanbook.functions import rules as R
from loanbook.operators.entity import latest_consumer

DateLike = Column | date


def _day(value: DateLike) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def hanging_accounts(trend: DataFrame, prod: DataFrame, as_of: date) -> DataFrame:
    """Accounts with history up to `as_of` but no current row by then, with their last report date."""
    last = trend.where(F.col("act_reported_dt") <= F.lit(as_of)).groupBy("account_key").agg(
        F.max("act_reported_dt").alias("max_rpt_dt")
    )
    current = prod.where(F.col("act_reported_dt") <= F.lit(as_of)).select("account_key")
    return last.join(current, "account_key", "left_anti")


def _newest_rows(history: DataFrame, as_of: date) -> DataFrame:
    """The rows of each account's last date up to `as_of`, all of them where several have it; one scan, one shuffle by account."""
    day = F.col("act_reported_dt")
    last = F.max(day).over(Window.partitionBy("account_key"))
    return history.where(day <= F.lit(as_of)).withColumn("last", last).where(day == F.col("last")).drop("last")


def latest_update(updates: DataFrame, as_of: date) -> DataFrame:
    """Restatement rows at each account's last date up to `as_of`; ties are kept."""
    return _newest_rows(updates, as_of).distinct()


FROM_TREND = (
    "act_reported_dt", "lender_id", "account_status", "das", "amount_overdue_total", "current_balance",
    "chargeoff_amt", "closed_dt", "days_past_due", "min_amount_due",
)
FROM_UPDATE = (
    "account_nbr", "disbursed_amount", "disbursed_dt", "instal_freq", "loan_category", "loan_cycle_id",
    "loan_purpose", "num_installment", "suppress_indicator",
)
FROM_CURRENT = ("consumer_key", "high_credit", "centre_id", "group_id")


def as_of_snapshot(prod: DataFrame, trend: DataFrame, updates: DataFrame, as_of: date) -> DataFrame:
    """One portfolio per date: current rows (P) and hanging history rows (T).

    Hanging rows take balances from history, terms from the last restatement
    and ownership from the current row, whatever its date. History of accounts
    with a current row by then is left out before the newest rows are looked for.
    """
    reported = F.col("act_reported_dt") <= F.lit(as_of)
    known = prod.where(reported).select("account_key")
    old = _newest_rows(trend.join(known, "account_key", "left_anti"), as_of).select("account_key", *FROM_TREND)
    terms = latest_update(updates.join(known, "account_key", "left_anti"), as_of).select("account_key", *FROM_UPDATE)
    owner = prod.where(reported.isNull() | ~reported).select("account_key", *FROM_CURRENT)
    past = old.join(terms, "account_key").join(owner, "account_key", "left").withColumn("data_ind", F.lit("T"))
    current = prod.where(reported).select(
        "account_key", *FROM_TREND, *FROM_UPDATE, *FROM_CURRENT, F.lit("P").alias("data_ind")
    )
    return current.unionByName(past).withColumn("as_of", F.lit(as_of))


STATIC = (
    "account_nbr", "credit_limit", "disbursed_amount", "disbursed_dt", "instal_freq", "num_installment",
    "suppress_indicator",
)
HISTORY = (
    "account_key", "lender_id", "account_type", "reported_dt", "act_reported_dt", "min_amount_due",
    "current_balance", "amount_overdue_total", "days_past_due", "chargeoff_amt", "asset_class", "das",
)
PERSON = ("consumer_key", "state", "district", "pin_code", "birth_dt", "gender", "ownership_ind")


def prod_plus_trend(trend: DataFrame, prod: DataFrame, consumer: DataFrame) -> DataFrame:
    """Full history: every trend row with its account's static terms, plus current rows.

    Closing dates of history rows count only under a closed status. `year` is
    the partition column for writing. Consumers join by their newest account,
    history and current rows by themselves, so that neither is moved where it
    lies by account already.
    """
    active = prod.where(F.col("active") == 1)
    static = active.select("account_key", *STATIC, F.col("closed_dt").alias("prod_closed_dt")).distinct()
    past = trend.select(*HISTORY).join(static, "account_key").select(
        *HISTORY, *STATIC,
        F.when(F.col("das").isin("S06", "S07"), F.col("prod_closed_dt")).alias("closed_dt"),
        F.lit("T").alias("data_ind"),
    )
    current = active.select(*HISTORY, *STATIC, "closed_dt", F.lit("P").alias("data_ind"))
    people = latest_consumer(consumer).select("account_key", *PERSON)
    everything = people.join(past, "account_key", "right").unionByName(people.join(current, "account_key", "right"))
    return everything.withColumn("year", F.year("act_reported_dt"))


def partition_upsert(base: DataFrame, delta: DataFrame, period: str, key: str) -> DataFrame:
    """Replacement content of the periods that `delta` touches: delta rows win by key."""
    touched = delta.select(period).distinct()
    kept = base.join(touched, period, "left_semi").join(delta.select(period, key), [period, key], "left_anti")
    return kept.unionByName(delta.select(*base.columns))


def closed_known(end: DateLike, report_cut: DateLike, cap_all: bool = True) -> Column:
    """Whether a closed row is known by the cut-off dates, as `open_closed_union` keeps it."""
    closing = F.col("closed_dt")
    reported = F.col("reported_dt") <= _day(report_cut)
    inserted = F.col("act_insert_dt") <= _day(report_cut)
    if cap_all:
        return (closing.isNull() | (closing <= _day(end))) & reported & inserted
    return reported & (closing.isNull() | ((closing <= _day(end)) & inserted))


def open_closed_union(
    open_rows: DataFrame,
    closed_rows: DataFrame,
    end: DateLike,
    report_cut: DateLike,
    cap_all: bool = True,
) -> DataFrame:
    """Open snapshot plus closed rows known by the cut-off dates.

    With `cap_all` every closed-table row must be reported and inserted by
    `report_cut`; otherwise rows without a closing date skip the insert cap.
    """
    return open_rows.unionByName(closed_rows.where(closed_known(end, report_cut, cap_all)))


def derive_account_rows(rows: DataFrame, end: DateLike) -> DataFrame:
    """Row rules applied to macro rows: absolute amounts, DPD, frequency, age, address rank."""
    money = ("high_credit", "disbursed_amount", "credit_limit", "amount_overdue_total", "current_balance",
             "chargeoff_amt")
    dpd, cls, das = F.col("days_past_due"), F.col("asset_class"), F.col("das")
    return rows.select(
        *[c for c in rows.columns if c not in money + ("instal_freq", "days_past_due")],
        *[F.abs(c).alias(c) for c in money],
        R.norm_instal_freq(F.col("instal_freq")).alias("instal_freq"),
        F.coalesce(R.raw_dpd(dpd), F.lit(0)).alias("days_past_due"),
        R.derived_dpd(dpd, cls, das).alias("dpd"),
        R.age_at(_day(end), F.col("birth_dt")).alias("age"),
        R.sdp_rank(F.col("state"), F.col("district"), F.col("pin_code")).alias("sdp"),
        R.ownership_flag(F.col("ownership_ind")).alias("ownership_ind_flag"),
    )
