"""Exact distinct counts that can be added up: members of groups as bits.

Every member has a number. A group keeps its members as words of 64 bits, a row
per word that has any, so groups are merged by OR and counted by their bits,
and a member of several groups counts once in their union.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD_BITS = 64


def numbered(rows: DataFrame, key: str, path: str) -> DataFrame:
    """Write a number for every distinct key to `path`: key, number. Numbers of a written file are consecutive."""
    keys = rows.where(F.col(key).isNotNull()).select(key).distinct()
    keys.withColumn("number", F.monotonically_increasing_id()).write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.parquet(path)


def members(rows: DataFrame, by: list[str], kinds: Mapping[str, tuple[str, DataFrame]]) -> DataFrame:
    """Members of the groups `by`: by, kind, word, bits.

    `kinds` names, for each kind of member, its key in `rows` and the numbers
    of `numbered`. Null keys are no members; a group without members has no row.
    """
    found = []
    for kind, (key, numbers) in kinds.items():
        held = rows.select(*by, key).join(numbers, key).select(
            *by, F.lit(kind).alias("kind"), F.expr("shiftright(number, 6)").alias("word"),
            F.expr(f"shiftleft(1L, cast(number & {WORD_BITS - 1} as int))").alias("bits"),
        )
        found.append(held)
    return merged(reduce(DataFrame.unionByName, found), by)


def merged(parts: DataFrame, by: list[str]) -> DataFrame:
    """Members of the coarser groups `by`, of rows that `members` made, whatever finer groups or periods they are from."""
    return parts.groupBy(*by, "kind", "word").agg(F.bit_or("bits").alias("bits"))


def counted(parts: DataFrame, by: list[str], kinds: list[str]) -> DataFrame:
    """Number of distinct members of the groups `by`, a column per kind."""
    sizes = merged(parts, by).withColumn("n", F.bit_count("bits"))
    return sizes.groupBy(*by).agg(*[
        F.sum(F.when(F.col("kind") == kind, F.col("n")).otherwise(0)).cast("long").alias(kind) for kind in kinds
    ])
