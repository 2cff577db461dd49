"""Tables kept by period."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from loanbook.params import DEFAULT_PARAMS as p
from loanbook.plans import catalog
from loanbook.sources import io
from loanbook.sources.periods import PeriodTable, touched_periods, upsert_periods
from loanbook.sources.views import Book


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def table(spark, tmp_path):
    made = PeriodTable(spark, f"t_{io.unique()}", str(tmp_path / "t"), "month")
    yield made
    made.drop()


def test_a_period_is_replaced_alone(spark, table, tmp_path):
    rows = spark.sql("select id as a, cast(200001 + id % 3 as int) as month, concat('x', id) as t from range(30)")
    assert table.periods() == []
    for month in (200001, 200002, 200003):
        table.replace(rows, month)
    assert table.periods() == [200001, 200002, 200003] and table.read().count() == 30
    before = {f: os.stat(f).st_mtime_ns for f in (str(x) for x in (tmp_path / "t").rglob("*.parquet")) if "month=200002" not in f}
    table.replace(rows.where("a < 5"), 200002)
    assert sorted(r.a for r in table.read(200002).collect()) == [1, 4]
    assert before == {f: os.stat(f).st_mtime_ns for f in before} and len(before) >= 2
    table.replace(rows.where("false"), 200002)
    assert table.read(200002).count() == 0 and table.read().count() == 20
    plan = plan_of(table.read(200001, 200003))
    assert "PartitionFilters: [isnotnull(month" in plan or "PartitionFilters: [month" in plan
    table.replace_found(spark.sql("select 1L as a, 200004 as month, 'y' as t union all select 2L, 200001, 'y'"), (200001, 200003, 200009))
    assert sorted((r.month, r.a) for r in table.read().collect()) == [(200001, 2), (200004, 1)], "an emptied month is empty"
    other = PeriodTable(spark, f"t_{io.unique()}", table.path, "month")
    assert 200001 in other.periods() and other.read().count() == table.read().count()
    spark.sql(f"drop table {other.name}")


def test_months_of_facts_are_built_once(spark, small, monkeypatch):
    built = []
    plain = catalog.replace_facts
    monkeypatch.setattr(catalog, "replace_facts", lambda book, run, table, dates: (built.extend(dates), plain(book, run, table, dates)))
    book = Book(spark, small)
    report = catalog.QUERIES["fact_month_over_month"](book, p)
    again = catalog.QUERIES["fact_report_outliers"](book, p)
    assert built == [date(2000, 6, 30), date(2000, 5, 31), date(2000, 4, 30), date(2000, 3, 31)]
    for df in (report, again):
        text = plan_of(df)
        assert "load_yyyymm" in text and "PartitionFilters" in text and "lineitem" not in text and "orders.parquet" not in text
    book.facts.drop()


def test_a_rerun_replaces_its_own_month(spark, small):
    book = Book(spark, small)
    table = catalog.stored_facts(book, p, 2)
    files = {m: sorted(f for f in table.read(m).inputFiles()) for m in table.periods()}
    catalog.replace_facts(book, p, table, (p.as_of,))
    again = {m: sorted(f for f in table.read(m).inputFiles()) for m in table.periods()}
    assert set(files) == {200005, 200006} and files[200005] == again[200005] and files[200006] != again[200006]
    plain = catalog.QUERIES["fact_keys"](book, p)
    names = sorted(plain.columns)
    assert sorted(map(str, table.read(200006).select(names).collect())) == sorted(map(str, plain.select(names).collect()))
    table.drop()


def stored(spark, path):
    return spark.read.schema("k long, v string, day date").parquet(path)


@pytest.fixture
def history(spark, tmp_path):
    path = str(tmp_path / "h")
    rows = spark.sql("select id as k, concat('old', id) as v, date_add(date'2000-01-01', cast(id % 20 as int)) as day from range(200)")
    io.write_period(rows, path, ["day"])
    return path


def test_only_touched_folders_are_read_and_written(spark, history):
    delta = spark.sql("select * from values (1L, 'new', date'2000-01-02'), (7L, 'moved', date'2000-01-04') as d(k, v, day)")
    work = f"{history}-delta"
    delta.write.parquet(work)
    rows = touched_periods(stored(spark, history), stored(spark, work), "day", "k")
    rows.count()
    plan = plan_of(rows)
    assert "dynamicpruning" in plan.lower()
    graph = rows._jdf.queryExecution().executedPlan()
    scans = [line for line in graph.toString().splitlines() if "FileScan parquet" in line and "h]" in line.split("Location")[1]]
    assert scans and all("PartitionFilters" in line and "2000-01-02" in line for line in scans)
    before = {f: os.stat(f).st_mtime_ns for f in (os.path.join(d, n) for d, _, ns in os.walk(history) for n in ns if n.endswith(".parquet"))}
    upsert_periods(stored(spark, history), delta, history, "day", "k")
    after = {f: os.stat(f).st_mtime_ns for f in (os.path.join(d, n) for d, _, ns in os.walk(history) for n in ns if n.endswith(".parquet"))}
    same = {f for f in before if after.get(f) == before[f]}
    assert {f.split("day=")[1][:10] for f in before if f not in same} == {"2000-01-02", "2000-01-04"}
    got = {(r.k, r.day): r.v for r in stored(spark, history).collect()}
    assert len(got) == 201 and got[(1, date(2000, 1, 2))] == "new" and got[(7, date(2000, 1, 4))] == "moved"
    assert got[(7, date(2000, 1, 8))] == "old7" and got[(21, date(2000, 1, 2))] == "old21"


def files_read(plan) -> list[int]:
    """Numbers of files that the scans of a plan that ran have opened."""
    kind = plan.getClass().getSimpleName()
    if kind == "FileSourceScanExec":
        return [plan.metrics().apply("numFiles").value()]
    if kind == "AdaptiveSparkPlanExec":
        return files_read(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return files_read(plan.plan())
    below = plan.children()
    return [n for k in range(below.size()) for n in files_read(below.apply(k))]


def test_files_read_by_a_rewrite(spark, history):
    work = f"{history}-delta2"
    spark.sql("select 1L as k, 'n' as v, date'2000-01-02' as day union all select 3L, 'n', date'2000-01-15'").coalesce(1).write.parquet(work)
    rows = touched_periods(stored(spark, history), stored(spark, work), "day", "k")
    assert len(rows.collect()) == 21
    assert sorted(files_read(rows._jdf.queryExecution().executedPlan()))[-1] == 2  # of the 20 folders of the table, one file each
    assert len(stored(spark, history).inputFiles()) == 20


def test_a_delta_may_come_from_the_table_and_may_lack_a_period(spark, history):
    base = stored(spark, history)
    upsert_periods(base, base.where("k = 5").withColumn("v", F.lit("restated")), history, "day", "k")
    assert [r.v for r in stored(spark, history).where("k = 5").collect()] == ["restated"]
    nameless = spark.sql("select 900L as k, 'none' as v, cast(null as date) as day")
    for text in ("none", "again"):
        upsert_periods(stored(spark, history), nameless.withColumn("v", F.lit(text)), history, "day", "k")
    assert [r.v for r in stored(spark, history).where("day is null").collect()] == ["again"]
    assert stored(spark, history).count() == 201
    upsert_periods(stored(spark, history), nameless.where("false"), history, "day", "k")
    assert stored(spark, history).count() == 201
