"""File system operations on the folders of written tables, through Hadoop's file system of each folder."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, name: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, name: str) -> bool:
    path, fs = _at(spark, name)
    return fs.exists(path)


def delete(spark: SparkSession, name: str) -> None:
    path, fs = _at(spark, name)
    fs.delete(path, True)


def move(spark: SparkSession, name: str, target: str) -> None:
    """Move a file or folder within a file system; the target must not exist, its parent is made."""
    path, fs = _at(spark, name)
    to, _ = _at(spark, target)
    fs.mkdirs(to.getParent())
    if fs.exists(to) or not fs.rename(path, to):
        raise OSError(f"could not move {name} to {target}")


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder."""
    path, fs = _at(spark, folder)
    return sorted(str(status.getPath().getName()) for status in fs.listStatus(path))


def parts(spark: SparkSession, folder: str) -> list[str]:
    """The part files of a written folder, in the order of their partitions."""
    path, fs = _at(spark, f"{folder}/part-*")
    found = fs.globStatus(path) or []
    return sorted(str(status.getPath().toString()) for status in found if status.getLen())


def join_parts(spark: SparkSession, head: bytes, names: list[str], target: str) -> None:
    """One file of `head` and the given files in order; bytes are copied a buffer at a time, never held whole."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    to, fs = _at(spark, target)
    out = fs.create(to, True)
    try:
        out.write(bytearray(head))
        for name in names:
            path, source = _at(spark, name)
            opened = source.open(path)
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(opened, out, conf, False)
            finally:
                opened.close()
    finally:
        out.close()
