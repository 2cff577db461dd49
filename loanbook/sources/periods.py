"""Named tables kept by period: a run replaces its own period and reads others without touching the rest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loanbook.sources import files, io

MOST_PERIODS = 20_000  # folders a table may have; what is known about them may be broadcast


class PeriodTable:
    """A table in the catalog with a folder per period at `path`.

    Periods are whole numbers, such as 200006, in the column `period`. They can
    be replaced one by one, also by nothing. Several sessions may use the same
    path: the table is found by its files, whoever wrote them.
    """

    def __init__(self, spark: SparkSession, name: str, path: str, period: str) -> None:
        self.spark, self.name, self.path, self.period = spark, name, path, period

    def _create(self, schema: StructType) -> None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        self.spark.sql(
            f"create table if not exists {self.name} ({columns}) using parquet partitioned by (`{self.period}`) location '{self.path}'"
        )

    def replace(self, rows: DataFrame, period: int) -> None:
        """Exactly the given rows are the period's from now on; `rows` may be empty. Other periods stay as they are."""
        self._create(rows.schema)
        columns = ", ".join(f"`{c}`" for c in rows.columns if c != self.period)
        held = rows.hint("rebalance").where(F.col(self.period) == F.lit(int(period)))
        self.spark.sql(
            f"insert overwrite table {self.name} partition (`{self.period}` = {int(period)}) ({columns}) select {columns} from {{held}}", held=held
        )
        self.spark.catalog.refreshTable(self.name)

    def replace_found(self, rows: DataFrame, wanted: tuple[int, ...] = (), dealt: bool = False) -> None:
        """The rows of every period in `rows` are that period's from now on, all in one job; other periods stay as they are.

        Periods in `wanted` that have no rows any more are emptied. For `dealt` see `write_period`.
        """
        again = set(wanted) & set(self.periods())
        if not again:
            self._insert(rows, dealt)
            return
        work = f"{self.path}.new-{io.unique()}"
        try:
            rows.write.parquet(work)
            new = self.spark.read.schema(rows.schema).parquet(work)
            found = {row[0] for row in new.where(F.col(self.period).isin(*again)).select(self.period).distinct().collect()}
            self._insert(new, dealt)
            for period in again - found:
                self.replace(new, period)
        finally:
            files.delete(self.spark, work)

    def _insert(self, rows: DataFrame, dealt: bool) -> None:
        self._create(rows.schema)
        io.write_period(rows, self.path, [self.period], dealt)
        self._recover()

    def _recover(self) -> None:
        """Let the catalog, which keeps a list of folders of its own, know those at the path."""
        self.spark.catalog.recoverPartitions(self.name)
        self.spark.catalog.refreshTable(self.name)

    def periods(self) -> list[int]:
        """The periods that have been written, empty ones not among them; no data is read."""
        if not files.exists(self.spark, self.path):
            return []
        found = (name.rsplit("=", 1)[-1] for name in files.children(self.spark, self.path) if f"{self.period}=" in name)
        return sorted(int(value) for value in found if value.lstrip("-").isdigit())

    def read(self, *wanted: int) -> DataFrame:
        """Rows of the wanted periods (of all without any); the scan opens no other folder."""
        if not self.spark.catalog.tableExists(self.name):  # written by another session
            self._create(self.spark.read.parquet(self.path).schema)
            self._recover()
        rows = self.spark.table(self.name)
        return rows.where(F.col(self.period).isin(*wanted)) if wanted else rows

    def drop(self) -> None:
        """Forget the table and delete its files."""
        self.spark.sql(f"drop table if exists {self.name}")
        files.delete(self.spark, self.path)


def upsert_periods(base: DataFrame, delta: DataFrame, path: str, period: str, key: str) -> None:
    """Delta rows replace stored rows of the same period and key, and join the others of their period.

    `base` is the table at `path`, with a folder per value of `period`. The delta
    is written down once; it may be read from the base itself. See
    `touched_periods` for what is read of the base; only that is written.
    """
    spark = base.sparkSession
    work = f"{path}.delta-{io.unique()}"
    try:
        delta.select(*base.columns).write.parquet(work)
        new = spark.read.schema(base.schema).parquet(work)
        io.write_period(touched_periods(base, new, period, key), path, [period])
    finally:
        files.delete(spark, work)


def touched_periods(base: DataFrame, new: DataFrame, period: str, key: str) -> DataFrame:
    """The new content of the periods that the written rows `new` touch; these win by key and must be unique by it.

    The periods of `new` prune the base before it is read: by their range when
    the query is planned, and one by one when it runs. Folders outside are
    neither read nor shuffled. Rows without a period are a period of their own.
    """
    reach = new.agg(
        F.min(period).alias("low"), F.max(period).alias("high"), F.count_distinct(period).alias("n"),
        F.coalesce(F.bool_or(F.col(period).isNull()), F.lit(False)).alias("unknown"),
    ).first()
    if reach["n"] > MOST_PERIODS:
        raise ValueError(f"{reach['n']} periods in one delta; a table may have {MOST_PERIODS}")
    within = F.col(period).between(F.lit(reach["low"]), F.lit(reach["high"]))
    touched = F.broadcast(new.where(within).select(period).distinct())  # at most MOST_PERIODS rows
    kept = base.where(within).join(touched, period, "left_semi").join(new.select(period, key), [period, key], "left_anti")
    rows = kept.select(*base.columns).unionByName(new)
    if not reach["unknown"]:
        return rows
    nameless = F.col(period).isNull()
    return rows.unionByName(base.where(nameless).join(new.where(nameless).select(key), key, "left_anti").select(*base.columns))
