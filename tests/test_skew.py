"""Balanced plans give the plain answers, also with one key holding a third of the rows."""

import random

from pyspark.sql import functions as F

from loanbook.functions import metrics as M
from loanbook.operators import caps
from loanbook.plans.skew import SALTS, hot_keys, percentile_exact, pick_first, pick_last, skew_join
from loanbook.sources import io
from loanbook.sources.periods import PeriodTable
from loanbook.sources.views import Book


def skewed(spark, n=6000):
    rng = random.Random(7)
    rows = [(i, 1 if i % 3 == 0 else rng.randrange(2, 2000), rng.randrange(0, 50), rng.randrange(1, 10**6) / 100)
            for i in range(n)]
    return spark.createDataFrame(rows, "id long, k long, g long, v double").withColumn(
        "v", F.col("v").cast("decimal(18,2)")
    )


def test_hot_keys_are_bounded(spark):
    assert [r.k for r in hot_keys(skewed(spark), ["k"]).collect()] == [1]


def test_skew_join_equals_join(spark):
    rows = skewed(spark)
    lookup = rows.where("k % 2 = 1").select("k").distinct().withColumn("name", F.concat(F.lit("n"), "k"))
    for how in ("inner", "left", "left_semi", "left_anti"):
        salted = skew_join(rows, lookup, ["k"], how, "id", keys_like=rows)
        plain = rows.join(lookup, ["k"], how)
        assert salted.columns == plain.columns
        assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0


def test_skew_join_spreads_the_hot_key(spark):
    rows = skewed(spark)
    salted = rows.where("k = 1").select(F.pmod(F.xxhash64("id"), F.lit(SALTS)).alias("s")).groupBy("s").count()
    assert salted.count() == SALTS
    assert salted.agg(F.max("count")).first()[0] < 2000 / SALTS * 2


def test_pick_matches_row_number(spark):
    rows = skewed(spark)
    order = "v desc, id desc"
    ranked = rows.withColumn("rn", F.expr(f"row_number() over (partition by k order by {order})")).where("rn = 1")
    picked = pick_last(rows, ["k"], [F.col("v"), F.col("id")])
    assert sorted(picked.select("k", "id").collect()) == sorted(ranked.select("k", "id").collect())
    first = pick_first(rows, ["k"], [F.col("v"), F.col("id")])
    assert first.where("k = 1").first().id == min(
        rows.where("k = 1").collect(), key=lambda r: (r.v, r.id)
    ).id


def test_percentile_exact_against_sorting(spark):
    rows = skewed(spark)
    got = {r.k: r.cap for r in percentile_exact(rows.where("k < 40"), "k", {"v": "cap"}, 99).collect()}
    values = {}
    for r in rows.where("k < 40").collect():
        values.setdefault(r.k, []).append(r.v)
    want = {k: sorted(vs)[(99 * len(vs) + 99) // 100 - 1] for k, vs in values.items()}
    assert got == want


def test_percentile_exact_with_one_value_everywhere(spark):
    df = spark.range(500).selectExpr("1 as k", "cast(if(id < 400, 5, id) as decimal(18,2)) as v")
    assert float(percentile_exact(df, "k", {"v": "cap"}, 50).first().cap) == 5.0


def test_distinct_rollup_equals_count_distinct(spark):
    rows = skewed(spark).withColumn("e", F.col("id") % 100)
    test = F.col("v") > 5000
    two_step = M.distinct_rollup(rows, ["g"], "e", {"big": test}, {"total": F.col("v")}, total="n")
    plain = rows.groupBy("g").agg(
        F.count_distinct("e").alias("n"), F.count_distinct(F.when(test, F.col("e"))).alias("big"),
        F.sum("v").alias("total"),
    )
    assert sorted(two_step.select("g", "n", "big", "total").collect()) == sorted(
        plain.select("g", "n", "big", "total").collect()
    )


def test_cents_round_trip(spark):
    rows = skewed(spark)
    got = rows.groupBy("g").agg(F.sum(M.cents(F.col("v"))).alias("s")).select("g", M.from_cents("s"))
    want = rows.groupBy("g").agg(F.sum("v").alias("s"))
    assert sorted(got.collect()) == sorted(want.select("g", "s").collect())


def test_rows_are_never_the_broadcast_side_of_their_caps(spark, small):
    """Stored histograms have no known size, so the planner would take the exploded rows for the smaller side."""
    book = Book(spark, small)
    rows = caps.amounts(book.account(), F.lit(200001))
    counts = PeriodTable(spark, f"histogram_{io.unique()}", io.new_table_path(spark, "histogram"), "mon_yr")
    try:
        counts.replace_found(caps.month_histograms(rows))
        plan = caps.caps_at(rows, counts.read(), (200001,))._jdf.queryExecution().executedPlan().toString()
        sides = [line for line in plan.splitlines() if "BroadcastHashJoin" in line]
        assert sides and all("BuildRight" in line for line in sides)
    finally:
        counts.drop()
