"""Readers and writers."""

import os

import pytest
from pyspark.sql import functions as F

from loanbook.sources import io


def test_jdbc_split_options():
    source = io.JdbcSource("jdbc:none:test", {"user": "u"})
    plain = io.jdbc_options(source, "acct", None, "active = 1")
    assert plain["dbtable"] == "(select t.* from acct t where active = 1) q" and plain["user"] == "u"
    cut = io.jdbc_options(source, "acct", io.Split.by_key("account_key"), None)
    assert cut["dbtable"] == "(select t.*, mod(account_key, 10) as split_part from acct t) q"
    assert (cut["lowerBound"], cut["upperBound"], cut["numPartitions"]) == ("0", "10", "10")
    assert io.Split.by_month("d").parts == 12
    assert io.Split.by_year("d", 2015, 2019) == io.Split("extract(year from d)", 2015, 2020, 5)


def test_file_filter_reaches_the_scan(spark, small):
    rows = io.read_table(spark, io.FileSource(small), "orders", "o_orderstatus = 'F'").select("o_orderkey")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderstatus,F)" in plan and "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan


def test_a_split_deals_out_files(spark, small):
    split = io.Split.by_key("o_orderkey", 5)
    rows = io.read_split(spark, io.FileSource(small), "orders", split, "o_orderstatus = 'F'")
    plain = io.read_table(spark, io.FileSource(small), "orders", "o_orderstatus = 'F'")
    assert rows.columns == plain.columns and rows.exceptAll(plain).count() == 0 == plain.exceptAll(rows).count()
    parts = rows.groupBy(F.spark_partition_id().alias("p")).agg(F.count_distinct(F.expr("mod(o_orderkey, 5)")).alias("n")).collect()
    assert len(parts) == 5 and {r.n for r in parts} == {1}
    assert "Exchange" not in plain._jdf.queryExecution().executedPlan().toString()


def test_uneven_parts_of_a_split_stay_apart(spark, tmp_path):
    """Parts are known by the split's range, not by a sample: rare, missing and outlying values find theirs."""
    spark.sql("select cast(if(id < 900, 2, id % 4) as int) as v, id from range(1000) union all select null, -1 union all select 99, -2 "
              "union all select -7, -3").write.parquet(str(tmp_path / "t.parquet"))
    rows = io.read_split(spark, io.FileSource(str(tmp_path)), "t", io.Split("v", 0, 4, 4))
    found = rows.groupBy(F.spark_partition_id().alias("p")).agg(F.collect_set("v").alias("vs"), F.count("*").alias("n")).collect()
    assert {r.p: (set(r.vs), r.n) for r in found} == {0: ({0, -7}, 27), 1: ({1}, 25), 2: ({2}, 925), 3: ({3, 99}, 26)}
    pairs = io.read_split(spark, io.FileSource(str(tmp_path)), "t", io.Split("v", 0, 4, 2))
    assert {r.p: r.n for r in pairs.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()} == {0: 52, 1: 951}


def test_dims_are_loaded_together(spark, small, tmp_path):
    target = str(tmp_path / "dims")
    assert io.load_dims(spark, io.FileSource(small), ["region", "nation"], target)["nation"].count() == 25
    with pytest.raises(Exception):
        io.load_dims(spark, io.FileSource(small), ["region", "no_such_table"], target)
    bad = spark.range(3).select(F.raise_error(F.lit("no")).cast("string").alias("x"))
    with pytest.raises(ExceptionGroup):
        io.publish_tables(spark, {"region": spark.range(1), "nation": bad}, target)
    assert spark.read.parquet(f"{target}/region").count() == 5 and sorted(os.listdir(target)) == ["nation", "region"]


def test_write_period_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    io.write_period(spark.createDataFrame([(1, "a"), (2, "b")], "v int, run string"), path, ["run"])
    io.write_period(spark.createDataFrame([(3, "b")], "v int, run string"), path, ["run"])
    assert sorted((r.v, r.run) for r in spark.read.parquet(path).collect()) == [(1, "a"), (3, "b")]


def test_named_tables_are_replaced_appended_and_inserted_by_name(spark, tmp_path):
    path, name = str(tmp_path / "named"), "named_rows"
    rows = lambda *values: spark.createDataFrame(list(values), "v int, t string")
    io.save_table(rows((9, "x")), name, path)
    io.save_table(rows((1, "a")), name, path)
    io.save_table(rows((2, "b")), name, path, mode="append")
    io.insert_by_name(rows((3, "c")).selectExpr("t", "true as extra", "v"), name)
    found = io.read_table(spark, io.CatalogSource("default"), name, "v > 0")
    assert sorted((r.v, r.t) for r in found.collect()) == [(1, "a"), (2, "b"), (3, "c")]
    assert all("/named/" in f for f in found.inputFiles())
    spark.sql(f"drop table {name}")


def test_load_by_period_appends(spark, tmp_path):
    path = str(tmp_path / "h")
    rows = spark.sql("select id, date_add(date'1999-12-01', cast(id as int) * 10) as d from range(20)")
    io.load_by_period(rows, path, F.year("d"))
    assert sorted(os.listdir(path))[-2:] == ["year=1999", "year=2000"]
    assert spark.read.parquet(path).count() == 20


def test_export_equals_one_task_of_work(spark, tmp_path):
    """Sorted and written in parts, with nulls, quotes and delimiters, the file has the bytes of a single sorted write."""
    df = spark.range(5000).selectExpr(
        "cast(pmod(hash(id), 700) as int) as n", "if(id % 7 = 0, null, concat('a|', id, ' ', char(34), 'q', char(34))) as `t|x`", "id"
    ).repartition(8)
    order = ["n", "t|x", "id"]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = open(io.export_single_csv(df, str(tmp_path), "report.csv", order), "rb").read()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    one = df.repartition(1).sortWithinPartitions(*[F.col(f"`{c}`") for c in order])
    one.write.option("header", True).option("sep", "|").csv(str(tmp_path / "one"))
    (part,) = (tmp_path / "one").glob("part-*")
    assert got == part.read_bytes()
    io.export_single_csv(df.where("false"), str(tmp_path), "report.csv", order)
    assert open(tmp_path / "report.csv").read().count("\n") == 1


def test_export_is_one_sorted_file(spark, tmp_path):
    df = spark.range(1000).selectExpr("1000 - id as n", "concat('x', id) as t").repartition(8)
    path = io.export_single_csv(df, str(tmp_path), "report.csv", ["n"])
    lines = open(path).read().splitlines()
    assert lines[0] == "n|t" and lines[1] == "1|x999" and len(lines) == 1001
    assert [f for f in os.listdir(tmp_path) if not f.endswith(".crc")] == ["report.csv"]


class _Conf(dict):
    """Stands in for a session that names a shared folder, or none on a cluster."""


class _Session:
    def __init__(self, conf, master):
        self.conf = _Conf(conf)
        self.sparkContext = self
        self.master = master

    def getConf(self):
        return self.conf


def test_shared_folder_follows_the_session(spark):
    named = _Session({io.CHECKPOINT_DIR: "/shared/work"}, "yarn")
    assert io.shared_folder(named) == "/shared/work"
    with pytest.raises(ValueError):
        io.shared_folder(_Session({}, "yarn"))
    with pytest.raises(ValueError):
        io.shared_folder(_Session({}, "local-cluster[2,1,1024]"))
    assert os.path.isdir(io.shared_folder(_Session({}, "local[2]")))


def test_catalog_source(spark, small):
    spark.read.parquet(f"{small}/nation.parquet").createOrReplaceTempView("nation_view")
    with pytest.raises(Exception):
        io.read_table(spark, io.CatalogSource("no_such_db"), "nation")
