"""Properties that hold for any book."""

import pytest
from pyspark.sql import functions as F

from loanbook.operators import entity, par, snapshot
from loanbook.params import DEFAULT_PARAMS as p
from loanbook.plans.catalog import QUERIES
from loanbook.sources.views import Book


@pytest.fixture(scope="module")
def book(spark, small):
    return Book(spark, small)


def test_snapshot_has_one_row_per_account(book):
    rows = QUERIES["as_of_snapshot"](book, p)
    assert rows.groupBy("account_key").count().where("count > 1").count() == 0
    assert rows.where("act_reported_dt > as_of").count() == 0


def test_hanging_and_current_are_disjoint(book):
    hanging = QUERIES["hanging_accounts"](book, p)
    current = book.account().where(F.col("act_reported_dt") <= F.lit(p.as_of))
    assert hanging.join(current, "account_key", "left_semi").count() == 0


def test_upsert_touches_only_its_periods(book):
    base = book.account_trend().select("account_key", "act_reported_dt", "current_balance")
    dates = base.select("act_reported_dt").distinct().limit(3)
    delta = base.join(dates, "act_reported_dt", "left_semi").select(base.columns).where("account_key % 2 = 0")
    delta = delta.withColumn("current_balance", F.lit(0).cast("decimal(18,2)"))
    touched = delta.select("act_reported_dt").distinct()
    out = snapshot.partition_upsert(base, delta, "act_reported_dt", "account_key")
    assert out.count() == base.join(touched, "act_reported_dt", "left_semi").count()
    assert out.where("current_balance = 0").count() == delta.count()


def test_risk_bands_add_up(book):
    report = QUERIES["par_report"](book, p)
    lar = sum((F.col(f"lar_{b}") for b in par.BANDS), F.lit(0))
    value = sum((F.col(f"par_{b}") for b in par.BANDS), F.lit(0))
    assert report.count() > 0
    assert report.where(lar != F.col("active_loans")).count() == 0
    assert report.where(value != F.col("active_outstanding")).count() == 0


def test_survivorship_is_one_row_per_cluster(book):
    members = book.cluster_member()
    out = entity.survivorship(members)
    assert out.count() == members.select("clst_id").distinct().count()
    assert out.where("monthly_income is null").join(
        members.where("monthly_income is not null"), "clst_id", "left_semi"
    ).count() == 0


def test_cumulative_bands_shrink(spark):
    # enough pairs exist at the larger scale only
    rows = {}
    for r in QUERIES["roll_rate"](Book(spark, "/root/testdata/sf0.01"), p).collect():
        rows.setdefault((r.reported_dt_from, r.peer_group, r.new_dpd_from), {})[r.new_dpd_to] = r.active_cards
    assert rows
    for cells in rows.values():
        counts = [cells.get(b, 0) for b in ("1+", "30+", "60+", "90+")]
        assert counts == sorted(counts, reverse=True)


def test_universe_is_closed_under_clusters(book):
    out = QUERIES["same_cluster_universe"](book, p)
    clusters = book.clusters()
    members = clusters.join(out.select("clst_id").distinct(), "clst_id", "left_semi").select(
        F.col("candidate_id").alias("consumer_key")
    )
    expected = book.account().join(members, "consumer_key", "left_semi").count()
    assert out.count() == expected


def test_every_result_has_rows_somewhere(spark):
    book = Book(spark, "/root/testdata/sf0.01")
    for name in ("flow_rate", "report_outliers", "cc_acquisitions_rank", "cc_top_cities", "active_lender_density",
                 "district_exposure_self", "geo_report_1", "cc_early_delinquency"):
        assert QUERIES[name](book, p).limit(1).count() == 1, name
