"""What a run keeps, and what it publishes."""

import gc
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from loanbook.plans.scope import Scope, publish


def kept(spark) -> int:
    return spark.sparkContext._jsc.getPersistentRDDs().size()


def test_a_scope_lets_go_of_what_it_shared(spark):
    before = kept(spark)
    with Scope() as scope:
        shared = scope.share(spark.range(10))
        assert shared.count() == 10 and kept(spark) == before + 1
    assert kept(spark) == before
    scope = Scope()
    result = scope.close_with(scope.share(spark.range(11)).groupBy((F.col("id") % 2).alias("k")).count())
    assert result.count() == 2 and kept(spark) == before + 1
    del result
    gc.collect()
    assert kept(spark) == before


@pytest.mark.parametrize("name", ("account_dashboard", "report_outliers", "mfi_step2", "fact_report_outliers", "geo_report_1"))
def test_nothing_stays_after_a_query(spark, small, name):
    spark.catalog.clearCache()
    rows = contract.queries()[name](spark, small)
    rows.collect()
    del rows
    gc.collect()
    assert kept(spark) == 0


def _csv(df):
    return lambda path: df.write.csv(path)


def test_outputs_are_published_together_or_not_at_all(spark, tmp_path):
    one, two = str(tmp_path / "one"), str(tmp_path / "deep" / "two")
    publish(spark, {one: _csv(spark.range(3)), two: _csv(spark.range(4))})
    assert spark.read.csv(one).count() == 3 and spark.read.csv(two).count() == 4
    bad = spark.range(5).select(F.raise_error(F.lit("no such luck")).alias("x"))
    with pytest.raises(ExceptionGroup) as failure:
        publish(spark, {one: _csv(spark.range(30)), two: _csv(bad.select(F.col("x").cast("string")))})
    assert len(failure.value.exceptions) == 1 and "two" in "".join(failure.value.exceptions[0].__notes__)
    assert spark.read.csv(one).count() == 3 and spark.read.csv(two).count() == 4
    publish(spark, {one: _csv(spark.range(7))})
    assert spark.read.csv(one).count() == 7
    assert sorted(os.listdir(tmp_path)) == ["deep", "one"] and os.listdir(tmp_path / "deep") == ["two"]


def test_a_failing_move_puts_the_old_outputs_back(spark, tmp_path):
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    publish(spark, {one: _csv(spark.range(3))})
    with pytest.raises(ExceptionGroup):
        publish(spark, {one: _csv(spark.range(9)), two: lambda path: None})  # the second writes nothing that could be moved
    assert spark.read.csv(one).count() == 3 and os.listdir(tmp_path) == ["one"]
