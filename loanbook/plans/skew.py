"""Plan helpers that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

# A key is hot when it holds more than 1/HOT_KEY_LIMIT of the rows, so there
# can never be HOT_KEY_LIMIT hot keys: the broadcast below has a proven bound.
HOT_KEY_LIMIT = 200
SALTS = 32


def pick_last(df: DataFrame, keys: list[str], order: list[Column], columns: list[str] | None = None) -> DataFrame:
    """One row per key: the greatest by `order` (NULL lowest).

    An aggregate instead of a ranked window, so rows of one key are reduced on
    every map task before the shuffle. `order` must end in a unique column.
    """
    return _pick(df, keys, order, columns, F.max_by)


def pick_first(df: DataFrame, keys: list[str], order: list[Column], columns: list[str] | None = None) -> DataFrame:
    """One row per key: the smallest by `order` (NULL lowest)."""
    return _pick(df, keys, order, columns, F.min_by)


def _pick(df, keys, order, columns, pick) -> DataFrame:
    kept = [c for c in (columns or df.columns) if c not in keys]
    best = pick(F.struct(*kept), F.struct(*order)).alias("best")
    return df.groupBy(*keys).agg(best).select(*keys, "best.*")


def hot_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys holding more than 1/HOT_KEY_LIMIT of the rows of `df`."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_of_key"))
    total = df.select(F.count(F.lit(1)).alias("n")).scalar()
    return counts.where(F.col("rows_of_key") * HOT_KEY_LIMIT > total).select(*keys)


def hot_among(counts: DataFrame, keys: list[str], count: str) -> DataFrame:
    """Hot keys of rows that were counted per key already."""
    total = counts.select(F.sum(count)).scalar()
    return counts.where(F.col(count) * HOT_KEY_LIMIT > total).select(*keys)


def skew_join(
    rows: DataFrame, lookup: DataFrame, keys: list[str], how: str, spread: str, keys_like: DataFrame | None = None,
    hot: DataFrame | None = None, known: list | None = None,
) -> DataFrame:
    """Join many `rows` to a `lookup` with few rows per key.

    Rows of hot keys are salted by a hash of `spread`, and the lookup rows of
    those keys are copied once per salt. The hot keys are the values `known` of
    the last of `keys`, as stored beside a table; or the frame `hot`; or those
    of `keys_like`, a frame with the same key distribution that is cheap to
    read. Without any of them, or with none that is hot, the join is left to
    adaptive execution, which splits oversized partitions of the rows at run
    time.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"cannot salt a {how} join")
    if known is not None:
        if not known:
            return rows.join(lookup, keys, how)
        is_hot = F.col(keys[-1]).isin(*known)
        marked, marked_lookup = rows.withColumn("is_hot", is_hot), lookup.withColumn("is_hot", is_hot)
    elif keys_like is None and hot is None:
        return rows.join(lookup, keys, how)
    else:
        found = hot_keys(keys_like.select(*keys), keys) if hot is None else hot
        hot = F.broadcast(found.withColumn("is_hot", F.lit(True)))
        marked, marked_lookup = rows.join(hot, keys, "left"), lookup.join(hot, keys, "left")
    salted_rows = marked.withColumn(
        "salt", F.when(F.col("is_hot"), F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int")).otherwise(F.lit(0))
    )
    copies = F.when(F.col("is_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    salted_lookup = marked_lookup.withColumn("salt", F.explode(copies)).drop("is_hot")
    joined = salted_rows.drop("is_hot").join(salted_lookup, [*keys, "salt"], how)
    return joined.drop("salt")


SLICES = 4096


def stacked(df: DataFrame, keys: list[str], values: dict[str, Column]) -> DataFrame:
    """Rows (keys, measure, v, bin) of the values that are not null; a bin is a 64th of an octave."""
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), value.alias("v")) for m, value in values.items()]))
    rows = df.select(*keys, pairs.alias("x")).select(*keys, "x.measure", "x.v").where("v is not null")
    return rows.withColumn(
        "bin", F.expr("cast(signum(v) * floor((log2(greatest(cast(abs(v) as double), 0.01D)) + 7) * 64) as int)")
    )


def histogram(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of each bin, with their smallest and largest value; histograms of parts can be merged."""
    return rows.groupBy(*keys, "bin").agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")
    )


def merged_histogram(parts: DataFrame, keys: list[str]) -> DataFrame:
    return parts.groupBy(*keys, "bin").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))


def bin_of_rank(counts: DataFrame, keys: list[str], rank: str) -> DataFrame:
    """The bin of each key that holds the row of the given rank, its value range and the rank inside it.

    `rank` is SQL over the number of rows of the key (`total`) or a column of the keys.
    """
    upward = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cumulative = counts.select(
        "*", F.sum("n").over(upward).alias("upto"), F.sum("n").over(Window.partitionBy(*keys)).alias("total")
    ).withColumn("wanted", F.expr(rank))
    return cumulative.where("upto >= wanted and upto - n < wanted").selectExpr(
        *[k for k in keys if k != "rank_in_bin"], "bin", "low", "high", "wanted - upto + n as rank_in_bin"
    )


def percent_rank(percent: int) -> str:
    return f"floor((total * {percent} + 99) / 100)"


def exact_in_bin(rows: DataFrame, coarse: DataFrame, keys: list[str]) -> DataFrame:
    """The value of the wanted rank of each key: keys, v. Only rows of the wanted bins are looked at.

    A bin is cut into equal slices and counted again; only the distinct values
    of one slice are ranked. Bins and slices, one of each key, are the side that
    is broadcast: the planner knows no sizes behind an explode or a stored table
    and would choose the rows.
    """
    position = f"floor(cast(v - low as double) / cast(high - low as double) * {SLICES - 1})"
    inside = rows.join(F.broadcast(coarse), [*keys, "bin"]).select(
        *keys, "rank_in_bin", "v", F.expr(f"if(high = low, 0, cast({position} as int))").alias("bin")
    )
    with_rank = [*keys, "rank_in_bin"]
    fine = bin_of_rank(histogram(inside, with_rank), with_rank, "rank_in_bin").selectExpr(
        *keys, "bin", "rank_in_bin as rank_in_slice"
    )
    # the inner rank replaces the outer one, so the slice joins by key and bin alone
    distinct = inside.drop("rank_in_bin").join(F.broadcast(fine), [*keys, "bin"]).groupBy(*keys, "rank_in_slice", "v").agg(
        F.count(F.lit(1)).alias("n")
    )
    by_value = Window.partitionBy(*keys).orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = distinct.withColumn("upto", F.sum("n").over(by_value)).where("upto >= rank_in_slice")
    return ranked.groupBy(*keys).agg(F.min("v").alias("v"))


def in_columns(found: DataFrame, keys: list[str], values: dict[str, str]) -> DataFrame:
    """One row per key with a column per measure."""
    return found.groupBy(*keys).agg(
        *[F.min(F.when(F.col("measure") == m, F.col("v"))).alias(name) for m, name in values.items()]
    )


def percentile_exact(df: DataFrame, group: str, values: dict[str, str], percent: int) -> DataFrame:
    """Smallest value of each group at or above `percent` of its rows, exactly, per measure.

    Counting passes replace a per-group sort: a histogram over bins (a few
    thousand per group) finds the bin holding the wanted rank, and the value is
    found inside that bin. All measures are counted together.
    """
    keys = [group, "measure"]
    rows = stacked(df, [group], {m: F.col(m) for m in values})
    coarse = bin_of_rank(histogram(rows, keys), keys, percent_rank(percent))
    return in_columns(exact_in_bin(rows, coarse, keys), [group], values)
