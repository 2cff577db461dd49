"""F1 to F5: rows of an account's dates are moved together, so that several months take little more disk than one."""

from collections import Counter
from datetime import date

from pyspark.sql import functions as F

from loanbook.operators import facts, intervals
from loanbook.params import DEFAULT_PARAMS as p
from loanbook.plans import catalog, scope
from loanbook.sources import io
from loanbook.sources.views import Book

DATES = (date(1994, 3, 31), date(1996, 6, 30), date(1996, 5, 31))  # before, between and after the reports of accounts


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df) -> Counter:
    return Counter(tuple(map(str, r)) for r in df.select(*sorted(df.columns)).collect())


def odd_tables(book):
    """Current rows that come twice with another owner or without a day, and restatements that come twice."""
    prod = book.account()
    undated = prod.where("account_key % 7 = 0").withColumn("act_reported_dt", F.lit(None).cast("date"))
    other = prod.where("account_key % 5 = 0").withColumn("consumer_key", F.col("consumer_key") + 1)
    updates = book.account_update()
    return prod.unionByName(undated).unionByName(other), book.account_trend(), updates.unionByName(updates.where("account_key % 3 = 0"))


def test_current_rows_come_once_for_all_their_dates(spark, small):
    tables = odd_tables(Book(spark, small))
    once = intervals.portfolios(*tables, DATES).cache()
    assert once.where("data_ind = 'P'").count() == tables[0].count()
    assert once.where("data_ind = 'P' and size(as_ofs) > 1").count() > 0 < once.where("data_ind = 'T'").count()
    assert rows_of(intervals.per_date(once)) == rows_of(intervals.snapshots(*tables, DATES)) != Counter()
    once.unpersist()


def test_rows_moved_once_for_all_dates_find_the_same_people(spark, small):
    book = Book(spark, small)
    tables = odd_tables(book)
    once, each = intervals.portfolios(*tables, DATES).cache(), intervals.snapshots(*tables, DATES).cache()
    got, want = (facts.mfi_step1(rows, book.clusters(), book.account_party()) for rows in (once, each))
    assert got.columns == want.columns and rows_of(got) == rows_of(want) != Counter()
    plan = plan_of(got)
    assert plan.index("Generate explode(as_ofs") < plan.index("SortMergeJoin" if "SortMergeJoin" in plan else "BroadcastHashJoin")
    once.unpersist()
    each.unpersist()


def test_dates_of_an_account_lie_side_by_side(spark, small):
    book = Book(spark, small)
    with scope.Scope() as own:
        step2 = catalog._step2_of(book, p, DATES, own, facts.ROLLUP_INPUT)
        assert plan_of(step2).split("InMemoryTableScan")[0].count("Exchange hashpartitioning(account_key") == 1
        assert "Exchange hashpartitioning(account_key#" in plan_of(step2) and ", as_of#" not in plan_of(step2).split("Exchange hashpartitioning(account_key")[1].split("\n")[0]
        kept = plan_of(step2).split("InMemoryRelation [")[1].split("]")[0]
        assert not any(name in kept for name in ("account_nbr", "clst_id", "high_credit", "data_ind")) and "account_key" in kept
    frame = spark.createDataFrame(
        [(1, month, "g", n, n, 1, 1, 1, 1, None) for n in range(200) for month in (200004, 200005, 200006)],
        "sdp_key int, load_yyyymm int, group_id string, consumer_key long, account_key long, cur_bal int, disb_amt int, amt_due int, charge_amt int, disb_dt date",
    ).withColumns({c: F.col(c).cast("decimal(18,2)") for c in facts.SUMS} | {"centre_id": F.lit("c"), "sdp_key": F.col("consumer_key") % 50})
    got = facts._counted_in_place(frame, ["sdp_key", "load_yyyymm"])
    assert plan_of(got).count("Exchange hashpartitioning(digest") == plan_of(got).count("Exchange ") == 1
    assert rows_of(got.select("sdp_key", "load_yyyymm", "total_accounts", "total_consumers")) == Counter(
        {(str(month), str(n), "4", "4"): 1 for month in (200004, 200005, 200006) for n in range(50)})


def test_facts_are_written_where_they_were_counted(spark, small, monkeypatch):
    """Counted rows are dealt out by group already; they are not moved once more to be written."""
    dealt = []
    plain = io.write_period
    monkeypatch.setattr(io, "write_period", lambda rows, path, columns, even=False: (dealt.append(even), plain(rows, path, columns, even)))
    book = Book(spark, small)
    table = catalog.stored_facts(book, p, 2)
    try:
        assert dealt == [True] and table.periods() == [200005, 200006]
    finally:
        table.drop()


def test_wanted_columns_do_not_change_the_others(spark, small):
    """What the cleaned grain leaves out on the way is only what is not asked for."""
    book = Book(spark, small)
    with scope.Scope() as own:
        some = catalog._step2_of(book, p, DATES, own, facts.ROLLUP_INPUT)
        rows = intervals.snapshots(book.account(), book.account_trend(), book.account_update(), DATES)
        whole = facts.mfi_step2(
            own.share(facts.mfi_step1(rows, book.clusters(), book.account_party())), catalog.dims.lender_dim(spark), book.purpose_dim(),
            book.occupation_dim(), book.geo_dim(), p,
        )
        assert facts.unread(None) == [] and {"account_nbr", "clst_id", "rpt_dt", "high_credit"} <= set(whole.columns)
        assert rows_of(some) == rows_of(whole.select(*some.columns)) != Counter()
