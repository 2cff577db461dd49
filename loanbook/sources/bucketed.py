"""The account tables of a book as named tables that lie by account, so that joins by account move no history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanbook.operators.entity import attach_cluster
from loanbook.sources import files, hot, io
from loanbook.sources.views import Book

BUCKETS = 64
KEY = "account_key"


class BucketedBook(Book):
    """A book whose current rows, history, restatements and parties are stored once, cut and sorted by account.

    All four have the same buckets, so a join or an aggregate by account reads
    them where they lie. Rows are moved to their bucket before they are written,
    so a bucket is one file, whatever the number of tasks. Consumers and clusters with very many accounts are
    listed beside the current rows, and the joins by them spread these without
    counting again. `drop` forgets the tables and deletes their files.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int = BUCKETS) -> None:
        super().__init__(spark, folder)
        self.path = io.new_table_path(spark, "bucketed")
        plain = {"current": super().account, "history": super().account_trend, "update": super().account_update, "party": super().account_party}
        self.names = {kind: f"account_{kind}_{io.unique()}" for kind in plain}
        for kind, rows in plain.items():
            rows().repartition(buckets, KEY).write.bucketBy(buckets, KEY).sortBy(KEY).option("path", f"{self.path}/{kind}").saveAsTable(self.names[kind])

        counts = self.account().groupBy("consumer_key").agg(F.count(F.lit(1)).alias("n"))
        by_cluster = attach_cluster(counts, self.clusters()).groupBy("clst_id").agg(F.sum("n").alias("n"))
        current = f"{self.path}/current"
        self.hot = hot.HotKeys(hot.store(counts, "consumer_key", "n", current), hot.store(by_cluster, "clst_id", "n", current))

    def account(self) -> DataFrame:
        return self.spark.table(self.names["current"])

    def account_trend(self) -> DataFrame:
        return self.spark.table(self.names["history"])

    def account_update(self) -> DataFrame:
        return self.spark.table(self.names["update"])

    def account_party(self) -> DataFrame:
        return self.spark.table(self.names["party"])

    def drop(self) -> None:
        for name in self.names.values():
            self.spark.sql(f"drop table if exists {name}")
        files.delete(self.spark, self.path)
