"""History as validity intervals, and portfolios of many dates from one pass over it."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanbook.operators.snapshot import FROM_CURRENT, FROM_TREND, FROM_UPDATE

DAY = "act_reported_dt"


def validity(
    history: DataFrame, key: str, state: list[str], day: str = DAY, distinct: bool = False, placed: bool = False,
) -> DataFrame:
    """What is known of every key, and from when until before when: key, valid_from, valid_to, days, states.

    `states` are the rows of the newest reported day so far, all of them where
    several have that day (without repeated ones if `distinct`). Consecutive
    days that report the same make one interval; `days` keeps their dates. The
    last interval has no `valid_to`. Rows without a day are never known.

    History is shuffled once, by key, or not at all if it is `placed` by key
    already, and sorted once: all steps are windows over the days of a key, so
    a task holds one sorted copy of its rows, which may spill. Rows of one key
    and day are collected, and so are the days of a key.
    """
    reported = history.where(F.col(day).isNotNull()).select(key, day, F.struct(*state).alias("state"))
    reported = reported if placed else reported.repartition(F.col(key))
    by_day = Window.partitionBy(key).orderBy(day)
    same_day = by_day.rangeBetween(Window.currentRow, Window.currentRow)
    all_days = by_day.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    upto = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = F.collect_set("state") if distinct else F.collect_list("state")
    versions = reported.select(
        key, day, F.array_sort(rows.over(same_day)).alias("states"), F.lag(day).over(by_day).alias("day_before")
    ).where(~F.col(day).eqNullSafe(F.col("day_before")))
    marked = versions.select(key, day, "states", (~F.col("states").eqNullSafe(F.lag("states").over(by_day))).alias("starts"))
    known = marked.select(
        key, day, "states", "starts", F.count_if("starts").over(upto).alias("island"), F.collect_list(day).over(all_days).alias("days"),
        F.collect_list(F.when(F.col("starts"), F.col(day))).over(all_days).alias("ends"),
    ).where("starts")
    spans = known.select(key, F.col(day).alias("valid_from"), F.get("ends", F.col("island").cast("int")).alias("valid_to"), "days", "states")
    return spans.withColumn("days", _known_on(F.col("days"), ("valid_from", "valid_to")))


def _known_on(days, *ends: tuple[str, str]):
    """The days inside all of the given intervals."""
    def inside(d):
        test = F.lit(True)
        for start, end in ends:
            test = test & (d >= F.col(start)) & (F.col(end).isNull() | (d < F.col(end)))
        return test

    return F.filter(days, inside)


def _days(dates: tuple[date, ...]):
    return F.array(*[F.lit(d) for d in sorted(set(dates))])


def known_as_of(intervals: DataFrame, key: str, dates: tuple[date, ...], day: str = DAY) -> DataFrame:
    """The rows of `validity` known on each of the dates: as_of, key, the day they were reported, and their state."""
    at = F.explode(_known_on(_days(dates), ("valid_from", "valid_to"))).alias("as_of")
    rows = intervals.select(key, at, "days", "states").withColumn("state", F.explode("states"))
    newest = F.array_max(F.filter("days", lambda d: d <= F.col("as_of"))).alias(day)
    return rows.select("as_of", key, newest, "state.*")


AS_OFS = "as_ofs"


def per_date(rows: DataFrame) -> DataFrame:
    """Rows of `portfolios` repeated for each of their dates, with the date as `as_of`."""
    return rows.select(*[c for c in rows.columns if c != AS_OFS], F.explode(AS_OFS).alias("as_of"))


def snapshots(
    prod: DataFrame, trend: DataFrame, updates: DataFrame, dates: tuple[date, ...], placed: bool = False,
) -> DataFrame:
    """The portfolios of several dates, each as `as_of_snapshot` has it, from one scan of history and one of the updates."""
    return per_date(portfolios(prod, trend, updates, dates, placed))


def portfolios(
    prod: DataFrame, trend: DataFrame, updates: DataFrame, dates: tuple[date, ...], placed: bool = False,
) -> DataFrame:
    """The rows of `snapshots`, a current row once for all its dates: `as_ofs` lists the dates on which a row is in the portfolio.

    A row in no portfolio has an empty list or none.

    Intervals of balances and of terms are joined where they overlap, by account
    alone, so every table is shuffled once whatever the number of dates, and not
    at all if all are `placed` by account. History of accounts with a current row
    by the first date is needed on none of them, and left out.
    """
    known = prod.where(F.col(DAY) <= F.lit(min(dates))).select("account_key")

    def needed(history: DataFrame) -> DataFrame:
        return history.where(F.col(DAY) <= F.lit(max(dates))).join(known, "account_key", "left_anti")

    balances = validity(needed(trend), "account_key", [c for c in FROM_TREND if c != DAY], placed=placed)
    terms = validity(needed(updates), "account_key", list(FROM_UPDATE), distinct=True, placed=placed).select(
        "account_key", F.col("valid_from").alias("terms_from"), F.col("valid_to").alias("terms_to"), F.col("states").alias("terms")
    )
    first_report = F.min(DAY).over(Window.partitionBy("account_key")).alias("current_from")
    owner = prod.select("account_key", *FROM_CURRENT, first_report)
    rows = balances.join(terms, "account_key").join(owner, "account_key", "left")
    hanging = F.filter(
        _known_on(_days(dates), ("valid_from", "valid_to"), ("terms_from", "terms_to")),
        lambda d: F.col("current_from").isNull() | (d < F.col("current_from")),
    )
    past = rows.withColumn("as_of", F.explode(hanging)).withColumn("balance", F.explode("states")).withColumn("term", F.explode("terms"))
    newest = F.array_max(F.filter("days", lambda d: d <= F.col("as_of"))).alias(DAY)
    past = past.select(
        "account_key", newest, *[F.col(f"balance.{c}") for c in FROM_TREND if c != DAY], *[F.col(f"term.{c}") for c in FROM_UPDATE],
        *FROM_CURRENT, F.lit("T").alias("data_ind"), F.array("as_of").alias(AS_OFS),
    )
    current = prod.select(
        "account_key", *FROM_TREND, *FROM_UPDATE, *FROM_CURRENT, F.lit("P").alias("data_ind"),
        F.filter(_days(dates), lambda d: d >= F.col(DAY)).alias(AS_OFS),
    )
    return current.unionByName(past)
