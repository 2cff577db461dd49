"""Branches that only uneven lenders, months and groups reach: the rows show that each of them decides something."""

import pytest
from pyspark.sql import functions as F

from loanbook.operators import par, snapshot
from loanbook.params import DEFAULT_PARAMS as p
from loanbook.plans.catalog import QUERIES, report_dedupe
from loanbook.sources.uneven import ABSENT_LENDER, QUIET_LENDER, SMALL_LENDERS, UnevenBook
from loanbook.sources.views import Book

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def uneven(spark):
    return UnevenBook(spark, FOLDER)


@pytest.fixture(scope="module")
def report(uneven):
    return report_dedupe(uneven, p).cache()


def test_the_two_unions_differ(uneven):
    capped = QUERIES["open_closed_union"](uneven, p)
    free = QUERIES["open_closed_union_uncapped"](uneven, p)
    more = free.exceptAll(capped)
    assert capped.exceptAll(free).count() == 0 and more.count() > 0
    assert more.where("closed_dt is null").count() == more.count()
    assert more.where(F.col("act_insert_dt") <= F.lit(p.report_cut)).count() == 0
    closed = uneven.macro_closed()
    assert snapshot.open_closed_union(uneven.macro_open().limit(0), closed, p.as_of, p.report_cut).where("closed_dt is null").count() > 0


def test_small_lenders_hold_no_share(report):
    kept = par.share_filter(report)
    dropped = report.join(kept, par.REPORT_KEYS, "left_anti")
    assert kept.count() > 100 and dropped.count() > 5
    assert set(r.lender_id for r in dropped.select("lender_id").distinct().collect()) >= {SMALL_LENDERS[1]}
    total = report.groupBy("reported_dt", "account_type").agg(F.sum("active_outstanding").alias("t"))
    assert dropped.join(total, ["reported_dt", "account_type"]).where(F.col("active_outstanding") > 0.005 * F.col("t")).count() == 0


def test_quiet_lenders_are_no_outliers(report):
    changes = par.month_over_month(report, p.as_of)
    out = par.report_outliers(changes, par.share_filter(report))
    assert 0 < out.count() < changes.count()
    assert out.where(F.col("lender_id") == QUIET_LENDER).count() == 0 < changes.where(F.col("lender_id") == QUIET_LENDER).count()
    everything = par.report_outliers(changes, report.select(*par.REPORT_KEYS))
    assert everything.exceptAll(out).count() > 0  # lenders that moved, but hold too little


def test_months_of_one_side_are_kept(report):
    changes = par.month_over_month(report, p.as_of)
    ends = changes.where("reported_dt_to is null").count(), changes.where("reported_dt_from is null").count()
    assert min(ends) > 0
    assert changes.where((F.col("lender_id") == ABSENT_LENDER) & F.col("reported_dt_to").isNull()).count() > 0
    gap = changes.where("reported_dt_to is null").first()
    assert gap.total_loans_perc_diff == 0 and gap.total_loans_diff < 0


def test_groups_of_many_are_summed_and_counted(spark):
    rows = QUERIES["fact_rollup_portfolio"](Book(spark, FOLDER), p)
    most = rows.agg(*[F.max(c).alias(c) for c in ("total_accounts", "total_consumers", "total_centres", "total_groups")]).first()
    assert most.total_accounts > most.total_groups > most.total_centres > 10 and most.total_accounts > most.total_consumers > 10
    assert rows.where("total_consumers < total_accounts").count() > 20


def test_flows_and_rolls_have_loans(spark):
    rows = QUERIES["flow_rate_next_month"](Book(spark, FOLDER), p)
    assert rows.agg(F.sum("live_loans")).first()[0] > 20
    assert QUERIES["roll_rate_lags"](Book(spark, FOLDER), p).agg(F.max("active_cards")).first()[0] > 20
