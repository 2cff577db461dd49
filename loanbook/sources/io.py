"""Readers and writers: split reads, staged tables, period replacement and named exports."""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass, field
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanbook.plans.scope import publish
from loanbook.sources import files

CHECKPOINT_DIR = "spark.checkpoint.dir"
FETCH_ROWS = 10000


@dataclass(frozen=True)
class FileSource:
    """Tables as files below one folder, `<folder>/<name><suffix>`."""

    folder: str
    format: str = "parquet"
    suffix: str = ".parquet"


@dataclass(frozen=True)
class CatalogSource:
    """Tables of a metastore database, addressed db.name."""

    database: str


@dataclass(frozen=True)
class JdbcSource:
    """A database; login and driver come from the caller's configuration."""

    url: str
    properties: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Split:
    """How a database read is cut: a numeric SQL expression and its range."""

    expression: str
    lower: int
    upper: int
    parts: int

    @staticmethod
    def by_key(key: str, parts: int = 10) -> Split:
        return Split(f"mod({key}, {parts})", 0, parts, parts)

    @staticmethod
    def by_month(column: str) -> Split:
        return Split(f"extract(month from {column})", 1, 13, 12)

    @staticmethod
    def by_year(column: str, first: int, last: int) -> Split:
        return Split(f"extract(year from {column})", first, last + 1, last - first + 1)


SPLIT_COLUMN = "split_part"


def jdbc_options(source: JdbcSource, name: str, split: Split | None, where: str | None) -> dict[str, str]:
    """Options of a database read: remote filter, and one query per split when a split is given."""
    filtered = f" where {where}" if where else ""
    if split is None:
        return {"url": source.url, "dbtable": f"(select t.* from {name} t{filtered}) q",
                "fetchsize": str(FETCH_ROWS), **source.properties}
    return {
        "url": source.url,
        "dbtable": f"(select t.*, {split.expression} as {SPLIT_COLUMN} from {name} t{filtered}) q",
        "partitionColumn": SPLIT_COLUMN, "lowerBound": str(split.lower), "upperBound": str(split.upper),
        "numPartitions": str(split.parts), "fetchsize": str(FETCH_ROWS), **source.properties,
    }


def read_table(spark: SparkSession, source, name: str, where: str | None = None) -> DataFrame:
    """One whole table; `where` is pushed to the source."""
    return read_split(spark, source, name, None, where)


def read_split(spark: SparkSession, source, name: str, split: Split | None, where: str | None = None) -> DataFrame:
    """One table, read in parallel, with a partition per part of `split`.

    A database runs a query per part. Files are read as they lie; with a split
    their rows are then dealt out by it, in one shuffle, so that a caller finds
    the same partitions. Without a split nothing is moved.
    """
    if isinstance(source, JdbcSource):
        rows = spark.read.format("jdbc").options(**jdbc_options(source, name, split, where)).load()
        return rows.drop(SPLIT_COLUMN)
    if isinstance(source, CatalogSource):
        rows = spark.table(f"{source.database}.{name}")
    else:
        rows = spark.read.format(source.format).load(f"{source.folder}/{name}{source.suffix}")
    rows = rows.where(where) if where else rows
    if split is None:
        return rows
    return rows.repartitionById(split.parts, _part(split))


def _part(split: Split) -> Column:
    """Number of the part that holds a row, as a database read has it: what lies outside the range goes to its ends, NULL to the first part."""
    width = (split.upper - split.lower) / split.parts
    at = F.coalesce(F.floor((F.expr(split.expression) - split.lower) / width), F.lit(0))
    return F.greatest(F.lit(0), F.least(F.lit(split.parts - 1), at)).cast("int")


def load_dims(spark: SparkSession, source, names: list[str], target: str) -> dict[str, DataFrame]:
    """Refresh dimension tables of a source below `target`, together or not at all, and return them."""
    return publish_tables(spark, {name: read_table(spark, source, name) for name in names}, target)


def publish_tables(spark: SparkSession, frames: dict[str, DataFrame], target: str) -> dict[str, DataFrame]:
    """Write tables below `target` at the same time, put them in place together, and return the written ones."""
    publish(spark, {f"{target}/{name}": df.write.parquet for name, df in frames.items()})
    return {name: spark.read.schema(df.schema).parquet(f"{target}/{name}") for name, df in frames.items()}


def load_by_period(df: DataFrame, path: str, period: Column, name: str = "year") -> None:
    """Append rows under one folder per period, all periods in one job.

    Rows are rebalanced by period: adaptive execution splits a large period
    over as many tasks as its size asks for and merges small ones.
    """
    rows = df.withColumn(name, period)
    rows.hint("rebalance", F.col(name)).write.mode("append").partitionBy(name).parquet(path)


def save_table(df: DataFrame, name: str, path: str, mode: str = "overwrite") -> None:
    """Write a named table with its files at `path`; mode `overwrite` replaces its rows, `append` adds to them."""
    df.write.mode(mode).option("path", path).saveAsTable(name)


def insert_by_name(df: DataFrame, name: str) -> None:
    """Add rows to a named table, matching columns by name whatever their order; others of `df` are left out."""
    df.select(*df.sparkSession.table(name).columns).write.insertInto(name)


def write_period(df: DataFrame, path: str, columns: list[str], dealt: bool = False) -> None:
    """Replace exactly the partitions that `df` holds and leave all others.

    Rows that are `dealt` out evenly already are written by the tasks that hold them, and not moved.
    """
    rows = df if dealt else df.hint("rebalance", *[F.col(c) for c in columns])
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path)


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="loanbook-")


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's checkpoint folder.

    Only a local session of one process without one gets a temporary folder.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if folder:
        return folder
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by the cluster")
    return _local_folder()


def unique() -> str:
    return uuid.uuid4().hex


def new_table_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{unique()}"


def export_single_csv(df: DataFrame, folder: str, name: str, order: list[str], sep: str = "|") -> str:
    """One sorted CSV file with header under the given name.

    Rows are range-partitioned by `order` and sorted and written by as many
    tasks as their size asks for. The parts are then joined in that order, by
    the file system and without being held in memory, and the finished file
    replaces an older one of that name. Rows equal in `order` come in any order.
    """
    spark = df.sparkSession
    target = f"{folder}/{name}"
    write_single_csv(df, f"{target}.new-{unique()}", order, sep, target)
    return target


def write_single_csv(df: DataFrame, file: str, order: list[str], sep: str = "|", target: str | None = None) -> None:
    """The same, written to `file` and then moved to `target`, if one is given."""
    spark = df.sparkSession
    work = f"{file}.parts"
    try:
        df.orderBy(*[F.col(f"`{c}`") for c in order]).write.option("header", False).option("sep", sep).csv(work)
        header = sep.join(_quoted(c, sep) for c in df.columns) + "\n"
        files.join_parts(spark, header.encode(), files.parts(spark, work), file)
    finally:
        files.delete(spark, work)
    if target is not None:
        files.delete(spark, target)
        files.move(spark, file, target)


def _quoted(name: str, sep: str) -> str:
    if sep not in name and '"' not in name and "\n" not in name:
        return name
    return '"' + name.replace("\\", "\\\\").replace('"', '\\"') + '"'
