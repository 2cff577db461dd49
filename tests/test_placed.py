"""Tables that lie by account, hot keys stored beside them, and ranks of large groups."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from loanbook.operators import facts, intervals
from loanbook.params import DEFAULT_PARAMS as p
from loanbook.plans import rank
from loanbook.plans.catalog import QUERIES, as_of_snapshot
from loanbook.plans.skew import skew_join
from loanbook.sources import hot
from loanbook.sources.bucketed import BucketedBook


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def skewed_folder(spark, small, tmp_path_factory):
    """The smallest tables, with a customer who has a third of the orders."""
    folder = tmp_path_factory.mktemp("skewed")
    for name in ("customer", "lineitem", "nation", "region", "orders"):
        rows = spark.read.parquet(f"{small}/{name}.parquet")
        if name == "orders":
            rows = rows.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(7).cast("long")).otherwise(F.col("o_custkey")))
        rows.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def book(spark, skewed_folder):
    made = BucketedBook(spark, skewed_folder, buckets=8)
    yield made
    made.drop()


def test_history_is_not_moved(book):
    together = intervals.snapshots(book.account(), book.account_trend(), book.account_update(), (p.as_of,), placed=True)
    assert "Exchange hashpartitioning" not in plan_of(together)
    full = plan_of(QUERIES["prod_plus_trend"](book, p))
    history = next(line for line in full.splitlines() if "account_history" in line)
    above = full.splitlines()[: full.splitlines().index(history)]
    depth = history.index("FileScan")
    chain = []
    for line in reversed(above):  # the operators that the scan's rows go through
        at = len(line) - len(line.lstrip(" :+-*(0123456789)"))
        if at < depth:
            chain.append(line)
            depth = at
    joined = [n for n, line in enumerate(chain) if "Join" in line]
    assert joined and not any("Exchange" in line for line in chain[: joined[0]])


def test_placed_and_plain_give_the_same(spark, book):
    for run in (as_of_snapshot, QUERIES["mfi_step1"]):
        from loanbook.sources.views import Book

        a, b = run(book, p), run(Book(spark, book.folder), p)
        names = sorted(a.columns)
        assert sorted(map(str, a.select(names).collect())) == sorted(map(str, b.select(names).collect()))


def test_hot_keys_lie_beside_the_table(spark, book):
    assert 7 in book.hot.consumers and len(book.hot.consumers) < 200
    assert hot.load(spark, f"{book.path}/current", "consumer_key") == book.hot.consumers
    assert book.hot.clusters and hot.load(spark, f"{book.path}/current", "no_such_key") is None


def _largest_share(spark, df) -> float:
    sizes = [r["n"] for r in df.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()]
    return max(sizes) / sum(sizes)


def test_a_hot_consumer_spreads_over_tasks(spark, book):
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "32"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = QUERIES["as_of_snapshot"](book, p)
        with_list = facts.mfi_step1(rows, book.clusters(), book.account_party(), book.hot)
        without = facts.mfi_step1(rows, book.clusters(), book.account_party())
        assert _largest_share(spark, without) > 0.3 and _largest_share(spark, with_list) < 0.15
        assert with_list.count() == without.count()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_known_keys_join_like_a_join(spark):
    rows = spark.range(3000).selectExpr("id", "if(id % 3 = 0, 1, id % 100) as k", "id % 4 as d")
    lookup = spark.range(50).selectExpr("id % 25 as k", "id % 4 as d", "id as v").distinct()
    for known in (None, [], [1], [1, 2, 99]):
        for how in ("inner", "left", "left_semi", "left_anti"):
            got, want = skew_join(rows, lookup, ["d", "k"], how, "id", known=known), rows.join(lookup, ["d", "k"], how)
            assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("part", (1 << 16, 8))
def test_rank_equals_a_plain_window(spark, monkeypatch, part):
    monkeypatch.setattr(rank, "PART", part)
    pick = random.Random(5)
    rows = [(pick.choice([1, 1, 1, 2, None]), pick.choice([None, 1, 2]), pick.choice([None, 0, -50, 70, 70, 1000, 999, 12345]), i, pick.randint(0, 2))
            for i in range(900)]
    rows += [(3, 1, 500, i, 0) for i in range(700)]  # one key, one day, one value
    frame = spark.createDataFrame(rows, "k long, d int, v long, a long, c long").withColumn("v", F.col("v").cast("decimal(18,2)"))
    order = Window.partitionBy("k").orderBy(F.col("d").desc_nulls_last(), F.col("v").desc(), "a", "c")
    known = frame.where("v is not null").withColumn("want", F.row_number().over(order))
    got = rank.descending_rank(frame, ["k"], ["d"], "v", ["a", "c"], "r")
    assert got.columns == [*frame.columns, "r"] and got.count() == len(rows)
    want = {(r.k, r.a): r.want for r in known.collect()}
    assert {(r.k, r.a): r.r for r in got.collect() if r.r is not None} == want
    assert got.where("v is null and r is not null").count() == 0


def test_no_group_is_sorted_whole(spark, monkeypatch):
    """A key with a third of all rows on one day: what is sorted together is small, whether its values differ or not."""
    monkeypatch.setattr(rank, "PART", 256)
    n = 30_000
    for value in ("cast(hash(id) % 1000000 as decimal(18,2))", "cast(100 as decimal(18,2))"):
        rows = spark.range(n).selectExpr("if(id % 3 = 0, 1, id) as k", "1 as d", f"{value} as v", "id as a", "0 as c")
        plan = plan_of(rank.descending_rank(rows, ["k"], ["d"], "v", ["a", "c"], "r"))
        windows = [line for line in plan.splitlines() if "row_number()" in line and "Window" in line]
        assert windows and all("_part" in line and ("_value" in line or "100" in value) for line in windows)
        sorted_together = rows.withColumn("part", F.floor(F.col("a") / 256)).groupBy("k", "d", "v", "part").count().agg(F.max("count")).first()[0]
        in_bin = rows.groupBy("k", "d", rank.value_bin(F.col("v")).alias("b"), "v", F.floor(F.col("a") / 256)).count().groupBy("k", "d", "b").count().agg(F.max("count")).first()[0]
        assert sorted_together <= 100 and in_bin < n / 3 / 10
