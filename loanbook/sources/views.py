"""Loan-book tables derived from the given order, line item and customer tables."""

from __future__ import annotations

from functools import cache, cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanbook.operators.entity import cluster_map
from loanbook.plans.scope import Scope
from loanbook.plans.skew import percentile_exact
from loanbook.sources.dims import ACCOUNT_TYPES, LENDERS
from loanbook.sources.hot import UNKNOWN, HotKeys
from loanbook.sources.periods import PeriodTable

MONEY = "decimal(18,2)"


def choose(index: str, values) -> str:
    """SQL for the value at position `index` of a fixed list."""
    items = ", ".join("null" if v is None else f"'{v}'" for v in values)
    return f"element_at(array({items}), cast({index} as int) + 1)"


def times(amount: str, factor: str) -> str:
    return f"cast({amount} * {factor} as {MONEY})"


def place(text: str, *codes: str) -> str:
    """SQL for where a text lies among the codes, given in ascending order: 2n + 1 at the nth (from 0), even numbers between them."""
    arms = "".join(f" when {text} < '{code}' then {2 * n} when {text} = '{code}' then {2 * n + 1}" for n, code in enumerate(codes))
    return f"case{arms} when {text} > '{codes[-1]}' then {2 * len(codes)} end"


# fixed values: text fields of the test book, by key
INSTAL_FREQS = ("1", "F02", "f03", None, "9", "ZZ", "F04", "F04")
CATEGORIES = ("T01", "T02", "T03", "T04")
CYCLES = ("0", "1", "002", "3", "04", "5", "006", "7", "08", "009", "10", " 12 ", None)
PURPOSES = ("AGRI", "BUSINESS", "SCHOOL", "HOME", "VEHICLE", "LAND", "OTHER", None)
PURPOSE_NAMES = {
    "AGRI": "Income", "BUSINESS": "INCOME", "SCHOOL": "Education", "HOME": "Housing", "VEHICLE": "Automobile",
    "LAND": "Real Estate", "OTHER": "misc",
}
OCCUPATION_NAMES = {
    "AUTOMOBILE": "Employed", "BUILDING": "Self Employed", "FURNITURE": "Agriculture and Allied",
    "HOUSEHOLD": "Contract Employee", "MACHINERY": "Others",
}
CREDIT_TYPES = ("9002", "4000", "0200", "0420", "0310", "7777")
COMMERCIAL_CLASSES = ("L01", "0001", "002", "0003", "005", "0010", "011", "0012", "013", None, None, None, None, None)
ADDRESS_PARTS = (
    "if(c_custkey % 10 <> 0, r_name, null) as state",
    "if(c_custkey % 7 <> 0, n_name, null) as district",
    "if(c_custkey % 6 <> 0, cast(100000 + c_nationkey as string), null) as pin_code",
)


class Book:
    """Named views over the tables of one folder; each is a lazy frame, built once."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.scope = Scope()  # what the steps of a run share
        self.facts: PeriodTable | None = None  # monthly facts, once a run has stored them
        self.hot: HotKeys = UNKNOWN  # very frequent keys, where the book's tables were counted when they were stored
        self.caps: PeriodTable | None = None  # caps by month, the same
        self.table = cache(self.table)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # --- account level ---------------------------------------------------------
    @cached_property
    def _orders(self) -> DataFrame:
        base = self.table("orders").selectExpr(
            "o_orderkey as account_key", "o_custkey as consumer_key", "cast(o_orderdate as date) as disbursed_dt",
            f"cast(o_totalprice as {MONEY}) as disbursed_amount",
            "case when o_orderstatus = 'O' then 'S04' when o_orderstatus = 'P' then 'S05' "
            "when o_orderpriority = '1-URGENT' then 'S06' else 'S07' end as das",
        )
        return base.selectExpr(
            "*",
            f"{choose('account_key % 12', LENDERS)} as lender_id",
            f"{choose('account_key % 7', ACCOUNT_TYPES)} as account_type",
            "concat('AC', cast(account_key as string)) as account_nbr",
            "if(das in ('S06', 'S07'), date_add(disbursed_dt, 400), null) as closed_dt",
            f"{choose('account_key % 8', INSTAL_FREQS)} as instal_freq",
            "cast(account_key % 49 as int) as num_installment",
            "if(account_key % 50 = 0, 'Y', null) as suppress_indicator",
            f"{choose('account_key % 4', CATEGORIES)} as loan_category",
            f"{choose('account_key % 13', CYCLES)} as loan_cycle_id",
            f"{choose('account_key % 8', PURPOSES)} as loan_purpose",
            "concat('C', cast(account_key % 23 as string)) as centre_id",
            "concat('G', cast(account_key % 211 as string)) as group_id",
            "1 as active",
        )

    @cached_property
    def _account(self) -> DataFrame:
        reported = "last_day(date_add(disbursed_dt, 365))"
        share = "element_at(array(0.15, 0.60, -0.35, 1.10), cast(account_key % 4 as int) + 1)"
        return self._orders.selectExpr(
            "*",
            "case account_key % 11 when 0 then null when 1 then '' when 2 then 'XXX' "
            "when 3 then concat('DPD ', cast(account_key % 400 as string)) "
            "else cast(account_key % 400 as string) end as days_past_due",
            f"{choose('account_key % 9', ('L01', 'L02', 'L03', 'L04', 'L05', ' L02 ', None, None, None))} as asset_class",
            "if(account_key % 3 <> 0, disbursed_amount, null) as high_credit",
            "if(account_key % 5 = 0, disbursed_amount, null) as credit_limit",
            f"{times('disbursed_amount', share)} as current_balance",
            f"if(account_key % 6 = 0, {times('disbursed_amount', '0.05')}, cast(0 as {MONEY})) as amount_overdue_total",
            "if(das = 'S06', disbursed_amount, null) as chargeoff_amt",
            f"if(account_key % 8 <> 7, {times('disbursed_amount', '0.05')}, null) as min_amount_due",
            f"{reported} as act_reported_dt", f"{reported} as reported_dt",
            f"date_add({reported}, cast(account_key % 40 as int)) as act_insert_dt",
            "das as account_status",
        )

    def account(self) -> DataFrame:
        """Current state of every account."""
        return self._account

    @cached_property
    def _trend(self) -> DataFrame:
        """Line items reduced to month ends of the order; one shipped before its order counts at the order date.

        They are reduced per shipping month first, so an order with very many
        line items reaches the join as one row per month. Flags are ranked,
        below, at and above the codes asked for: as numbers in the first
        aggregate, which hashes, and as digits in the second, since a greatest
        text has it sort. Its rows come sorted by account from the join and
        leave sorted by account and day, as windows over the days need them.
        """
        per_month = self.table("lineitem").groupBy(
            "l_orderkey", F.last_day(F.col("l_shipdate").cast("date")).alias("shipped")
        ).agg(
            F.expr(f"max(cast(l_extendedprice as {MONEY})) as balance"),
            F.expr("max(cast(l_quantity as int)) as qty"),
            F.expr(f"max({place('l_returnflag', 'A', 'R')}) as rf"), F.expr(f"max({place('l_linestatus', 'F')}) as ls"),
        )
        orders = self._orders.selectExpr(
            "account_key as l_orderkey", "disbursed_dt", "lender_id", "account_type", "closed_dt"
        )
        rows = per_month.join(orders, "l_orderkey").groupBy(
            F.col("l_orderkey").alias("account_key"),
            F.greatest("shipped", F.last_day("disbursed_dt")).alias("act_reported_dt"),
            "lender_id", "account_type", "closed_dt",
        ).agg(F.max("balance").alias("current_balance"), F.max("qty").alias("qty"), F.max(F.col("rf").cast("string")).alias("rf"),
              F.max(F.col("ls").cast("string")).alias("ls"))
        due = times("current_balance", "0.05")
        return rows.selectExpr(
            "account_key", "lender_id", "account_type", "act_reported_dt", "act_reported_dt as reported_dt",
            "current_balance", "cast(qty * 8 as string) as days_past_due",
            "case rf when '1' then 'L01' when '3' then 'L02' end as asset_class",
            "if(ls = '1', 'S05', 'S04') as das", "if(ls = '1', 'S05', 'S04') as account_status", "closed_dt",
            f"if(account_key % 6 = 0, {due}, cast(0 as {MONEY})) as amount_overdue_total",
            "if(account_key % 17 = 0 and ls = '1', current_balance, null) as chargeoff_amt",
            f"{due} as min_amount_due",
        )

    def account_trend(self) -> DataFrame:
        """Month-end history: unique on (account_key, act_reported_dt)."""
        return self._trend

    def account_update(self) -> DataFrame:
        """Restatements of static attributes by month end."""
        rows = self.table("lineitem").groupBy(
            F.col("l_orderkey").alias("account_key"),
            F.last_day(F.col("l_shipdate").cast("date")).alias("act_reported_dt"),
        ).agg(
            F.expr(f"max(cast(l_extendedprice as {MONEY})) as disbursed_amount"),
            F.expr("max(cast(l_quantity as int)) as num_installment"),
        )
        static = self._orders.select(
            "account_key", "account_nbr", "disbursed_dt", "instal_freq", "loan_category", "loan_cycle_id",
            "loan_purpose", "suppress_indicator", "active",
        )
        return rows.join(static, "account_key")

    # --- people --------------------------------------------------------------------
    @cached_property
    def _customers(self) -> DataFrame:
        places = self.table("nation").join(self.table("region"), F.expr("n_regionkey = r_regionkey"))
        return self.table("customer").join(places, F.expr("c_nationkey = n_nationkey"))

    @cached_property
    def _consumer(self) -> DataFrame:
        return self._customers.selectExpr(
            "c_custkey as consumer_key",
            "date_add(date'1996-01-01', cast(c_custkey % 1500 as int)) as insert_dt",
            *ADDRESS_PARTS,
            "if(c_custkey % 8 <> 0, concat(n_name, '_C', cast(c_custkey % 10 as string)), null) as city",
            "if(c_custkey % 9 <> 0, concat('LOC', cast(c_custkey % 20 as string)), null) as locality",
            f"if(c_custkey % 4 <> 0, cast(c_acctbal as {MONEY}), null) as monthly_income",
            f"if(c_custkey % 3 <> 0, cast(cast(c_acctbal as {MONEY}) * 10 as {MONEY}), null) as annual_income",
            "if(c_custkey % 5 <> 0, date_add(date'1950-01-01', cast((c_custkey * 37) % 18000 as int)), null) as birth_dt",
            f"{choose('c_custkey % 3', ('M', 'F', None))} as gender", "c_mktsegment as occupation",
            f"{choose('c_custkey % 5', ('O01', 'O02', 'O04', None, None))} as ownership_ind",
            "c_custkey % 13 = 0 as is_commercial",
            "if(c_custkey % 2 = 0, cast(c_custkey % 50 + 18 as int), null) as age",
            "if(c_custkey % 4 <> 2, date_add(date'1999-01-01', cast(c_custkey % 300 as int)), null) as age_as_on_dt",
        )

    def consumer(self) -> DataFrame:
        return self._consumer

    def geo_fill(self) -> DataFrame:
        """Fallback addresses; those of odd consumers are empty."""
        return self._customers.selectExpr("c_custkey as consumer_key", *[
            f"if(c_custkey % 2 = 0, {value}, null) as {name}"
            for name, value in (("state", "r_name"), ("district", "n_name"), ("pin_code", "cast(100000 + c_nationkey as string)"))
        ])

    @cached_property
    def _party(self) -> DataFrame:
        links = self._orders.selectExpr(
            "account_key", "lender_id",
            "explode(if(account_key % 4 = 0, array(consumer_key, consumer_key + 1), array(consumer_key))) as consumer_key",
        )
        rows = links.join(self._consumer, "consumer_key")
        return rows.withColumn("insert_dt", F.expr("date_add(insert_dt, cast(account_key % 700 as int))"))

    def account_party(self) -> DataFrame:
        """Consumers of each account: its holder and, for every fourth one, a co-borrower."""
        return self._party

    def cluster_pair(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "c_custkey as candidate_id",
            "explode(if(c_custkey % 5 = 1, array(c_custkey - c_custkey % 3, c_custkey - c_custkey % 6), "
            "array(c_custkey - c_custkey % 3))) as clst_id",
        )

    def clusters(self) -> DataFrame:
        """Cluster of each candidate."""
        return cluster_map(self.cluster_pair())

    def cluster_member(self) -> DataFrame:
        """Party rows with their cluster and the dates of their account."""
        found = self.clusters().withColumnRenamed("candidate_id", "consumer_key")
        rows = self._party.join(found, "consumer_key", "left")
        dates = self._account.select("account_key", "disbursed_dt", "reported_dt")
        return rows.withColumn("clst_id", F.coalesce("clst_id", "consumer_key")).join(dates, "account_key")

    # --- macro tables -----------------------------------------------------------------
    MACRO = (
        "account_key", "lender_id", "account_type", "account_nbr", "das", "days_past_due", "asset_class",
        "high_credit", "disbursed_amount", "credit_limit", "current_balance", "amount_overdue_total",
        "chargeoff_amt", "disbursed_dt", "closed_dt", "reported_dt", "act_insert_dt", "instal_freq",
    )
    PARTY = (
        "account_key", "consumer_key", "state", "district", "pin_code", "ownership_ind", "birth_dt", "gender",
        "is_commercial",
    )

    @cached_property
    def _macro(self) -> DataFrame:
        return self._account.select(*self.MACRO).join(self._party.select(*self.PARTY), "account_key")

    def macro_open(self) -> DataFrame:
        """Open accounts flattened with their consumers."""
        return self._macro.where("das in ('S04', 'S05')").withColumn("das_flag", F.lit(1))

    def macro_closed(self) -> DataFrame:
        return self._macro.where("das in ('S06', 'S07')").withColumn("das_flag", F.lit(0))

    def extra_columns(self) -> DataFrame:
        """Suppression, minimum due and income per (account, consumer)."""
        accounts = self._account.select("account_key", "suppress_indicator", "min_amount_due")
        return self._party.select("account_key", "consumer_key", "annual_income", "monthly_income").join(
            accounts, "account_key"
        )

    # --- commercial book --------------------------------------------------------------
    J = "cast(floor(account_key / 5) as int)"

    def _commercial(self, rows: DataFrame, *columns: str) -> DataFrame:
        return rows.selectExpr(
            "account_key", "lender_id as contributor_id",
            f"{choose(f'{self.J} % 14', COMMERCIAL_CLASSES)} as asset_class",
            "das", "current_balance", "amount_overdue_total", "closed_dt",
            "if(account_key % 9 = 0, date_add(closed_dt, 30), null) as loan_expiry_dt", "reported_dt", *columns,
        )

    def _commercial_dpd(self, text: str) -> str:
        return f"case {self.J} % 10 when 0 then 'XXX' when 1 then 'DDD' when 2 then null else {text} end as dpd"

    def commercial_account(self) -> DataFrame:
        return self._commercial(
            self._account,
            "consumer_key as borrower_key",
            "if(account_key % 10 = 0, account_nbr, concat('CM', cast(account_key as string))) as account_number",
            f"{choose(f'{self.J} % 6', CREDIT_TYPES)} as credit_type", "disbursed_dt as sanctioned_dt",
            self._commercial_dpd("cast(account_key % 500 as string)"),
            "disbursed_amount as sanctioned_amount", "high_credit as drawing_power",
        )

    def commercial_trend(self) -> DataFrame:
        return self._commercial(
            self._trend,
            self._commercial_dpd("days_past_due"),
            "if(account_key % 3 <> 0, current_balance, null) as sanctioned_amount",
            "if(account_key % 2 = 0, current_balance, null) as drawing_power",
        )

    # --- data-driven dimensions ----------------------------------------------------------
    def geo_dim(self) -> DataFrame:
        """Distinct (state, district, pin) with a key computed from its parts."""
        rows = self._customers.selectExpr(
            *ADDRESS_PARTS,
            "cast(if(c_custkey % 10 <> 0, (r_regionkey + 1) * 10000, 0) "
            "+ if(c_custkey % 7 <> 0, (n_nationkey + 1) * 100, 0) "
            "+ if(c_custkey % 6 <> 0, n_nationkey + 1, 0) as int) as sdp_key",
        ).distinct()
        return rows.selectExpr("*", "state as rev_state", "district as rev_district", "1 as active")

    def purpose_dim(self) -> DataFrame:
        """Lender's purpose text -> category."""
        names = " ".join(f"when '{code}' then '{name}'" for code, name in PURPOSE_NAMES.items())
        return self._orders.where("loan_purpose is not null").select(
            "lender_id", "loan_purpose"
        ).distinct().selectExpr("*", f"case loan_purpose {names} end as purpose_status")

    def occupation_dim(self) -> DataFrame:
        """Lender's occupation text -> category."""
        return self.spark.createDataFrame(
            [(x, o, c) for x in LENDERS for o, c in OCCUPATION_NAMES.items()],
            "lender_id string, occupation string, occupation_category string",
        )

    def threshold(self) -> DataFrame:
        """Caps per account type: 99th percentile of balance and of amount."""
        rows = self._account.selectExpr(
            "account_type", "abs(current_balance) as balance", "abs(disbursed_amount) as amount"
        )
        caps = percentile_exact(rows, "account_type", {"balance": "balance_cap", "amount": "amount_cap"}, 99)
        return caps.withColumn("active", F.lit(1))

    def overall_threshold(self) -> DataFrame:
        """One row of caps over all accounts."""
        rows = self._account.selectExpr(
            "1 as all_types", "abs(current_balance) as balance", "abs(disbursed_amount) as amount",
            "abs(min_amount_due) as due",
        )
        names = {"balance": "balance_cap", "amount": "amount_cap", "due": "min_due_cap"}
        return percentile_exact(rows, "all_types", names, 99).drop("all_types")


__all__ = ["ACCOUNT_TYPES", "Book"]
