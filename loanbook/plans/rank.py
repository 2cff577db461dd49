"""Ranks inside groups of any size, by counting what comes before instead of sorting whole groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PART = 1 << 16  # range of the first tie-breaker that is sorted in one task
BINS = 64  # bins of an octave


def value_bin(value: Column) -> Column:
    """A bin that rises with the value: 64 to an octave, apart by sign."""
    size = F.greatest(F.abs(value).cast("double"), F.lit(0.001))
    return (F.signum(value.cast("double")) * F.floor((F.log2(size) + 10) * BINS)).cast("int")


def descending_rank(rows: DataFrame, keys: list[str], order: list[str], value: str, ties: list[str], name: str) -> DataFrame:
    """Rank `name` of each row among those of its `keys` with a known `value`; null where the value is null.

    Newest first by the columns `order` (null last), then by `value` from the
    largest, then by `ties` upwards. The first of `ties` must be a number.

    Rows are counted in cells of equal order and value and a range of the first
    tie-breaker. Three running sums over these counts (over the days of the
    keys, over the bins of a day, over the values of a bin) give how many rows
    come before a cell, and only the rows of one cell are sorted: the rows of a
    key spread over many tasks also where they share all days, or the value.
    """
    marked = rows.withColumns({"_value": F.col(value), "_part": F.floor(F.col(ties[0]) / PART)})
    cell = [*keys, *order, "_value", "_part"]
    counted = marked.where("_value is not null").groupBy(*cell).agg(F.count(F.lit(1)).alias("n")).withColumn("bin", value_bin(F.col("_value")))
    days, upwards = [F.col(c).desc_nulls_last() for c in order], Window.unboundedPreceding
    in_bin = Window.partitionBy(*keys, *order, "bin").orderBy(F.col("_value").desc(), "_part").rowsBetween(upwards, -1)
    cells = counted.withColumn("above_in_bin", F.coalesce(F.sum("n").over(in_bin), F.lit(0)))
    bins = counted.groupBy(*keys, *order, "bin").agg(F.sum("n").alias("n"))
    in_day = Window.partitionBy(*keys, *order).orderBy(F.col("bin").desc()).rowsBetween(upwards, -1)
    in_key = Window.partitionBy(*keys).orderBy(*days).rowsBetween(upwards, -1)
    day_counts = bins.groupBy(*keys, *order).agg(F.sum("n").alias("n")).withColumn("before_day", F.coalesce(F.sum("n").over(in_key), F.lit(0)))
    bins = bins.withColumn("above_bin", F.coalesce(F.sum("n").over(in_day), F.lit(0))).drop("n")
    placed = _null_safe(_null_safe(cells.drop("n"), bins, [*keys, *order, "bin"]), day_counts.drop("n"), [*keys, *order])
    before = placed.select(*cell, (F.col("above_in_bin") + F.col("above_bin") + F.col("before_day")).alias("before"))
    local = F.row_number().over(Window.partitionBy(*cell).orderBy(*ties))
    joined = _null_safe(marked.withColumn("local", local), before, cell, "left")
    return joined.select(*rows.columns, F.when(F.col(value).isNotNull(), F.col("before") + F.col("local")).cast("int").alias(name))


def descending_ranks(rows: DataFrame, keys: list[str], order: list[str], values: dict[str, str], ties: list[str],
                     keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """`descending_rank` for several values (value -> name of its rank): rows of most keys are moved once, for all ranks together.

    Only keys with more than PART rows, which are at most one in PART of the
    rows, are ranked cell by cell. `keep` keeps what is read more than once: the
    `rows` and the list of these keys.
    """
    rows = keep(rows)
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    hot = F.broadcast(keep(counts.where(F.col("n") > PART).select(*keys).repartition(1)))
    days = [F.col(c).desc_nulls_last() for c in order]
    usual, large = _null_safe(rows, hot, keys, "left_anti"), _null_safe(rows, hot, keys, "left_semi")
    for value, name in values.items():
        first = Window.partitionBy(*keys).orderBy(F.col(value).isNull(), *days, F.col(value).desc(), *ties)
        usual = usual.withColumn(name, F.when(F.col(value).isNotNull(), F.row_number().over(first)))
        large = descending_rank(large, keys, order, value, ties, name)
    return usual.unionByName(large)


def _null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on keys that may be null."""
    renamed = right.select(*[F.col(c).alias(f"_{n}") for n, c in enumerate(keys)], *[c for c in right.columns if c not in keys])
    on = None
    for n, c in enumerate(keys):
        test = F.col(c).eqNullSafe(F.col(f"_{n}"))
        on = test if on is None else on & test
    return left.join(renamed, on, how).drop(*[f"_{n}" for n in range(len(keys))])
