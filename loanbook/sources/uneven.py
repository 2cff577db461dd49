"""A second book over the same tables, in which lenders and months are uneven.

The plain book spreads accounts evenly, so some branches of the monitor and of
the unions are never reached in it. Here two lenders are very small, one reports
the same loans every month, one misses a month, and some closed accounts have no
closing date.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanbook.sources.views import Book

# fixed values: who is uneven, and how
SMALL_LENDERS = ("SBI010", "FRB011")
SMALL_SHARE = 40  # one account in so many stays with a small lender
LARGE_LENDER = "PRB000"
QUIET_LENDER = "HFC007"
QUIET_DATES = ("2000-03-31", "2000-04-30", "2000-05-31", "2000-06-30")
ABSENT_LENDER, ABSENT_DATE, NEXT_DATE = "ARC008", "2000-05-31", "2000-06-30"
NO_CLOSING_DATE = 9  # closed accounts whose key is a multiple of this


class UnevenBook(Book):
    @cached_property
    def _orders(self) -> DataFrame:
        small = F.col("lender_id").isin(*SMALL_LENDERS) & (F.expr("account_key div 12") % SMALL_SHARE != 0)
        return Book._orders.func(self).withColumn("lender_id", F.when(small, F.lit(LARGE_LENDER)).otherwise(F.col("lender_id")))

    @cached_property
    def _account(self) -> DataFrame:
        """The absent lender's accounts of the missing month are reported a month later."""
        rows = Book._account.func(self)
        late = (F.col("lender_id") == ABSENT_LENDER) & (F.col("reported_dt") == F.lit(ABSENT_DATE).cast("date"))
        days = {c: F.when(late, F.lit(NEXT_DATE).cast("date")).otherwise(F.col(c)) for c in ("act_reported_dt", "reported_dt")}
        return rows.withColumns(days).withColumn("act_insert_dt", F.expr("date_add(reported_dt, cast(account_key % 40 as int))"))

    @cached_property
    def _trend(self) -> DataFrame:
        rows = Book._trend.func(self)
        absent = (F.col("lender_id") == ABSENT_LENDER) & (F.col("act_reported_dt") == F.lit(ABSENT_DATE).cast("date"))
        others = rows.where((F.col("lender_id") != QUIET_LENDER) & ~absent)
        days = F.explode(F.array(*[F.lit(d).cast("date") for d in QUIET_DATES])).alias("act_reported_dt")
        known = (F.col("lender_id") == QUIET_LENDER) & (F.col("disbursed_dt") <= F.lit(QUIET_DATES[0]).cast("date"))
        quiet = self._orders.where(known).select(
            "account_key", "lender_id", "account_type", days, F.col("disbursed_amount").alias("current_balance"),
        ).selectExpr(
            "*", "act_reported_dt as reported_dt", "'40' as days_past_due", "'L01' as asset_class", "'S04' as das", "'S04' as account_status",
            "cast(null as date) as closed_dt", "cast(0 as decimal(18,2)) as amount_overdue_total",
            "cast(null as decimal(18,2)) as chargeoff_amt", "cast(0 as decimal(18,2)) as min_amount_due",
        )
        return others.unionByName(quiet)

    def macro_closed(self) -> DataFrame:
        gone = F.col("account_key") % NO_CLOSING_DATE == 0
        return super().macro_closed().withColumn("closed_dt", F.when(~gone, F.col("closed_dt")))
