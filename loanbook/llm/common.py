"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

CHECKPOINT_DIR = "spark.checkpoint.dir"
JUDGED_ROWS = 2000  # rows of an Arrow batch judged at a time


@cache
def _test_folder() -> str:
    return tempfile.mkdtemp(prefix="corpus-")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: `spark.checkpoint.dir` of the session.

    Only a one-process local session (as in tests) without that setting gets a
    temporary folder; on a cluster the setting is required.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if folder:
        return folder
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by the cluster")
    return _test_folder()


def delete_tables(spark: SparkSession, names: list[str]) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for name in names:
        path(name).getFileSystem(conf).delete(path(name), True)


_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch_dropped(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end of the block, the tables that `staged` wrote in it; for work whose result is written by then.

    A block owns what its own thread stages in it, and an inner block what is
    staged inside that; threads never see each other's tables.
    """
    names: list[str] = []
    outer = _scratch.set(names)
    try:
        yield
    finally:
        _scratch.reset(outer)
        delete_tables(spark, names)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once to the shared folder and return the written table.

    Later steps start from files that outlive any executor. Inside
    `scratch_dropped` the table goes with the block; otherwise it stays in the
    shared folder, since the caller's lazy result reads it, and goes with that.
    """
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    owner = _scratch.get()
    if owner is not None:
        owner.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rows_exist(df: DataFrame) -> bool:
    return not df.isEmpty()


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def judged(docs: DataFrame, text_col: str, columns: list[str], judge: Callable[[pa.Array], list[pa.Array]], found: str) -> DataFrame:
    """Struct `row` of the given columns beside the columns `found` that `judge` makes of the texts of a batch."""
    chosen = columns if text_col in columns else [*columns, text_col]
    rows = docs.select(F.struct(*[F.col(c) for c in chosen]).alias("row"))
    kept = StructType(rows.schema["row"].dataType.fields[: len(columns)])
    added = StructType.fromDDL(found)
    place = chosen.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, JUDGED_ROWS):
                row = whole.slice(at, JUDGED_ROWS).column("row")
                parts = row.flatten()
                same = pa.StructArray.from_arrays(parts[: len(columns)], fields=list(row.type)[: len(columns)])
                yield pa.RecordBatch.from_arrays([same, *judge(parts[place])], names=["row", *added.names])

    return rows.mapInArrow(run, StructType([StructField("row", kept), *added.fields]))


def runs_by_size(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Cut positions into consecutive (start, end) runs of at most `limit` in total; a larger item stands alone."""
    start = total = 0
    for at, size in enumerate(sizes):
        if at > start and total + size > limit:
            yield start, at
            start, total = at, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)
