"""Rows that the master tables do not know."""

from pyspark.sql import functions as F

from loanbook.operators import entity


def test_consumers_without_a_cluster_stand_for_themselves(spark):
    rows = spark.createDataFrame([(1, 10), (2, 11), (3, 12)], "account_key long, consumer_key long")
    clusters = spark.createDataFrame([(10, 7), (12, 9)], "candidate_id long, clst_id long")
    for hot in (None, rows):
        got = entity.attach_cluster(rows, clusters, keys_like=hot)
        assert {r.consumer_key: r.clst_id for r in got.collect()} == {10: 7, 11: 11, 12: 9}
    assert entity.attach_inner(rows, clusters).where(F.col("consumer_key") == 11).count() == 0
