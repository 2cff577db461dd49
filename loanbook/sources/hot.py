"""Lists of very frequent keys, written beside a stored table when it is loaded."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanbook.plans.skew import HOT_KEY_LIMIT, hot_among
from loanbook.sources import files


class HotKeys(NamedTuple):
    """Keys that hold more than 1/HOT_KEY_LIMIT of the rows each; None where nobody has counted."""

    consumers: list | None = None
    clusters: list | None = None


UNKNOWN = HotKeys()


def store(counts: DataFrame, key: str, count: str, table: str) -> list:
    """Write the hot keys of a table whose rows were counted per key, and return them: fewer than HOT_KEY_LIMIT."""
    found = hot_among(counts, [key], count).where(F.col(key).isNotNull())
    found.coalesce(1).write.mode("overwrite").parquet(_place(table, key))
    return load(counts.sparkSession, table, key)


def load(spark: SparkSession, table: str, key: str) -> list | None:
    """The stored list of a table, or None if it has none."""
    if not files.exists(spark, _place(table, key)):
        return None
    return sorted(row[0] for row in spark.read.parquet(_place(table, key)).limit(HOT_KEY_LIMIT).collect())


def _place(table: str, key: str) -> str:
    return f"{table}.hot-{key}"
