"""Branches that the books of the given tables reach rarely, and what a plan may do while it is built."""

import dataclasses
from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from loanbook.functions import rules as R
from loanbook.operators import clusters, entity, facts, flow
from loanbook.params import DEFAULT_PARAMS as p
from loanbook.plans.catalog import QUERIES, unique_account_row
from loanbook.sources import dims
from loanbook.sources.views import Book

STAGED_ONCE = (
    "card_base", "threshold_flags", "flow_rate", "mfi_step1", "mfi_step2", "fact_rollup", "geo_report_1", "account_dashboard",
    "income_backfill", "report_outliers", "district_exposure", "golden_address",
)


@pytest.mark.parametrize("name", STAGED_ONCE)
def test_building_a_plan_runs_no_job(spark, small, name):
    book = Book(spark, small)
    QUERIES[name](book, p)  # reads the tables' schemas, and stores the caps and facts of the book
    spark.sparkContext.setJobGroup(f"build {name}", name)
    QUERIES[name](book, p)
    found = spark.sparkContext.statusTracker().getJobIdsForGroup(f"build {name}")
    spark.sparkContext.setJobGroup("tests", "tests")
    assert len(found) == 0


def test_one_book_serves_several_dates(spark, small):
    book = Book(spark, small)
    earlier = dataclasses.replace(p, as_of=date(1999, 6, 30))
    for run in (p, earlier, p):
        got = QUERIES["mfi_step1"](book, run)
        assert [r.as_of for r in got.select("as_of").distinct().collect()] == [run.as_of]
        assert got.count() == QUERIES["mfi_step1"](Book(spark, small), run).count()


def test_missing_caps_flag_one(spark):
    rows = spark.createDataFrame([("A01", D(5), D(7), D(2), D(9), D(9))], "account_type string, current_balance decimal(18,2), "
                                 "high_credit decimal(18,2), min_amount_due decimal(18,2), disbursed_amount decimal(18,2), credit_limit decimal(18,2)")
    per_type = spark.createDataFrame([("A07", D(1), D(1), 1)], "account_type string, balance_cap decimal(18,2), amount_cap decimal(18,2), active int")
    kind = "balance_cap decimal(18,2), amount_cap decimal(18,2), min_due_cap decimal(18,2)"
    flags = ("min_amt_threshold", "threshold_flag_overall", "threshold_acnt_type")
    for caps, want in (((None, None, None), (1, 1, 1)), ((D(9), D(9), D(9)), (1, 1, 1)), ((D(4), D(9), D(1)), (0, 0, 1)), ((D(9), D(6), D(2)), (1, 0, 1))):
        found = clusters.threshold_flags(rows, spark.createDataFrame([caps], kind), per_type).select(*flags).first()
        assert tuple(found) == want


def test_a_group_shares_its_amounts(spark):
    columns = ["account_key", "lender_id", "loan_category", "group_id", *facts.SHARED_MONEY]
    money = [D(90)] * len(facts.SHARED_MONEY)
    rows = spark.createDataFrame(
        [(1, "L", "T", "G", *money), (2, "L", "T", "G", *[D(30)] * len(money)), (3, "L", "U", "G", *money)],
        ", ".join(f"{c} {'long' if c == 'account_key' else 'decimal(18,2)' if c in facts.SHARED_MONEY else 'string'}" for c in columns))
    got = {r.account_key: r[facts.SHARED_MONEY[0]] for r in facts.group_share(rows, "L", "T").collect()}
    assert got == {1: D(45), 2: D(15), 3: D(90)}


def test_the_book_reaches_the_shared_branch(spark, small):
    book = Book(spark, small)
    rows = QUERIES["mfi_step1"](book, p).where((F.col("lender_id") == p.group_lender) & (F.col("loan_category") == p.group_category))
    assert rows.groupBy("group_id").count().where("count > 0").count() > 0


def test_two_reports_in_a_month_are_one_loan(spark, small):
    book = Book(spark, small)

    def run(trend):
        return flow.flow_rate(trend, book.account(), unique_account_row(book, p), book.threshold(),
                              dims.account_type_dim(spark), dims.date_dim(spark, p.calendar), p)

    trend = book.account_trend()
    early = trend.where(F.dayofmonth("act_reported_dt") > 20).withColumn("act_reported_dt", F.date_sub("act_reported_dt", 9)).withColumn(
        "current_balance", F.col("current_balance") / 2)
    both = run(trend.unionByName(early.select(trend.schema.names).withColumn("current_balance", F.col("current_balance").cast("decimal(18,2)"))))
    assert sorted(map(str, both.collect())) == sorted(map(str, run(trend).collect()))


def test_the_calendar_follows_the_run(spark):
    assert dims.date_dim(spark, (date(2010, 1, 1), date(2010, 12, 1))).where("fyq like 'FY2010-Q%'").count() == 9
    assert dims.date_dim(spark, p.calendar).where("yyyymm = 201004 and fyq = 'FY2010-Q1'").count() == 1


def test_entry_years_are_a_parameter(spark):
    rows = spark.createDataFrame([(1, date(2010, 5, 1)), (1, date(2011, 5, 1)), (2, date(1998, 1, 1))], "clst_id long, disbursed_dt date")
    got = {r.clst_id: r.entry_year for r in entity.market_entry(rows, (2010,)).collect()}
    assert got == {1: "2010", 2: "Others"}


def test_the_largest_amount_is_a_parameter(spark):
    one = spark.createDataFrame([(D("50.00"),)], "a decimal(18,2)")
    assert one.select(R.storable(F.col("a"), 40)).first()[0] is False and one.select(R.storable(F.col("a"), 60)).first()[0] is True


def test_a_rollup_by_all_labels_moves_its_rows_once(spark, small):
    """Rows are moved by group before they are copied per kind of member, and counts are those of a plain aggregate."""
    step2 = QUERIES["mfi_step2"](Book(spark, small), p).localCheckpoint()
    odd = step2.withColumn("centre_id", F.when(F.col("account_key") % 3 > 0, F.col("centre_id"))).withColumn(
        "consumer_key", F.when(F.col("account_key") % 5 > 0, F.col("consumer_key")))
    for rows in (step2, odd.withColumn("das", F.lit(None).cast("string")), odd.unionByName(odd)):
        got = facts.fact_rollup(rows, dims.category_dim(spark))
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Expand" not in plan and plan.count("Exchange hashpartitioning") == 1
        plain = facts.fact_rollup(rows, dims.category_dim(spark), facts.ROLLUP_KEYS)
        assert got.dtypes == plain.dtypes and got.exceptAll(plain).count() == 0 == plain.exceptAll(got).count()


def test_only_loans_of_the_group_lender_are_moved_to_share(spark):
    columns = ["account_key", "lender_id", "loan_category", "group_id", *facts.SHARED_MONEY]
    kinds = ", ".join(f"{c} {'long' if c == 'account_key' else 'decimal(18,2)' if c in facts.SHARED_MONEY else 'string'}" for c in columns)
    money = [D(-90)] * len(facts.SHARED_MONEY)
    rows = spark.createDataFrame([(1, "L", "T", None, *money), (2, None, "T", "G", *money), (3, "L", None, "G", *money), (4, "L", "T", "G", *money)], kinds)
    got = facts.group_share(rows, "L", "T")
    assert {r.account_key: r[facts.SHARED_MONEY[0]] for r in got.collect()} == {1: D(0), 2: D(90), 3: D(90), 4: D(90)}
    assert got._jdf.queryExecution().optimizedPlan().toString().startswith("Union")
