"""History of accounts that no wanted date needs is left out before it is cut into intervals or ranked."""

from datetime import date

from loanbook.operators import intervals, snapshot
from loanbook.params import DEFAULT_PARAMS as p
from loanbook.sources.views import Book

DATES = (date(2000, 4, 30), date(2000, 6, 30))


def test_known_accounts_are_left_out_of_history(spark, small):
    book = Book(spark, small)
    for rows in (
        snapshot.as_of_snapshot(book.account(), book.account_trend(), book.account_update(), p.as_of),
        intervals.snapshots(book.account(), book.account_trend(), book.account_update(), DATES),
    ):
        assert rows._jdf.queryExecution().executedPlan().toString().count("LeftAnti") == 2


def test_months_equal_single_snapshots_with_repeated_and_undated_current_rows(spark, small):
    book = Book(spark, small)
    prod = book.account()
    undated = prod.where("account_key % 7 = 0").selectExpr(
        *[f"cast(null as date) as {c}" if c == "act_reported_dt" else c for c in prod.columns])
    late = prod.where("account_key % 5 = 0").selectExpr(*[f"add_months({c}, 3) as {c}" if c == "act_reported_dt" else c for c in prod.columns])
    odd = prod.where("account_key % 7 > 0 or account_key % 2 = 0").unionByName(undated).unionByName(late)
    several = intervals.snapshots(odd, book.account_trend(), book.account_update(), DATES)
    for day in DATES:
        one = snapshot.as_of_snapshot(odd, book.account_trend(), book.account_update(), day)
        got = several.where(several.as_of == day).select(one.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, one.collect())) != []
