"""Builders for wide conditional aggregates and two-step distinct counts."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sum_if(test: Column, value: Column, name: str) -> Column:
    """Sum of `value` where `test` holds, counting 0 for all other rows."""
    return F.sum(F.when(test, value).otherwise(F.lit(0))).alias(name)


def cents(value: Column) -> Column:
    """A two-digit amount as a whole number of cents.

    Sums of long decimals run on objects; sums of cents run on plain longs and
    stay exact. For groups whose totals stay far below 2^63 cents, such as the
    loans of one borrower; beyond that the sum fails instead of going wrong.
    """
    return (value * 100).cast("bigint")


def from_cents(name: str) -> Column:
    return (F.col(name).cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast("decimal(28,2)").alias(name)


def count_if(test: Column, name: str) -> Column:
    return F.count(F.when(test, F.lit(1))).alias(name)


def flag(test: Column) -> Column:
    """1 where the test holds, else 0 (NULL counts as false)."""
    return F.when(test, F.lit(1)).otherwise(F.lit(0))


def any_if(test: Column, name: str) -> Column:
    return F.max(flag(test)).alias(name)


def distinct_rollup(
    df: DataFrame,
    keys: list[str],
    entity: str,
    flags: dict[str, Column],
    sums: dict[str, Column] | None = None,
    total: str | None = None,
) -> DataFrame:
    """Conditional distinct counts of one entity together with plain sums.

    Rows are reduced to (keys, entity) holding the greatest flag first; the
    counts are then sums of flags. This replaces one count(distinct when ..)
    per metric, which would multiply every row by the number of metrics.
    """
    sums = sums or {}
    per_entity = df.groupBy(*keys, entity).agg(
        *[any_if(test, name) for name, test in flags.items()],
        *[F.sum(value).alias(name) for name, value in sums.items()],
    )
    counted = [F.sum(name).cast("bigint").alias(name) for name in flags]
    if total is not None:
        counted.insert(0, F.count(entity).alias(total))
    return per_entity.groupBy(*keys).agg(*counted, *[F.sum(name).alias(name) for name in sums])
