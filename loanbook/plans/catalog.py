"""Every operator as a named query over one folder of tables."""

from __future__ import annotations

import dataclasses
import functools
import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanbook import params as P
from loanbook.functions import buckets as B
from loanbook.functions import rules as R
from loanbook.operators import caps, cards, clusters, dashboard, entity, facts, flow, geo, intervals, members, par, snapshot, vintage
from loanbook.plans import scope
from loanbook.sources import dims, io
from loanbook.sources.bucketed import BucketedBook
from loanbook.sources.periods import PeriodTable, upsert_periods
from loanbook.sources.uneven import UnevenBook
from loanbook.sources.views import Book, choose, times

Query = Callable[[Book, P.RunParams], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def as_output(df: DataFrame) -> DataFrame:
    """Decimals leave as double; everything before stays exact."""
    return df.select(*[
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
        for f in df.schema.fields
    ])


def _c(*names: str) -> list[Column]:
    return [F.col(n) for n in names]


def _rule(source: str, key: str, **columns: Callable[[P.RunParams], Column]) -> Query:
    def run(book: Book, p: P.RunParams) -> DataFrame:
        rows = getattr(book, source)()
        return rows.select(key, *[expr(p).alias(name) for name, expr in columns.items()])

    return run


def _account(**columns) -> Query:
    return _rule("account", "account_key", **columns)


def _consumer(**columns) -> Query:
    return _rule("consumer", "consumer_key", **columns)


def _loan() -> Column:
    return R.loan_amount(*_c("high_credit", "disbursed_amount", "credit_limit"))


def _retail_dpd() -> Column:
    return R.derived_dpd(*_c("days_past_due", "asset_class", "das"))


def _status(p: P.RunParams) -> Column:
    digits = R.clean_digits(F.col("days_past_due")).try_cast("int")
    return R.mfi_status(
        F.col("chargeoff_amt"), F.col("closed_dt"), p.as_of, digits,
        *_c("amount_overdue_total", "disbursed_amount", "account_status"),
    )


def _tenure_all_codes() -> Column:
    """Every frequency code by key, so that all divisors are exercised."""
    code = F.expr(choose("account_key % 7", tuple(R.MONTHS_PER_INSTALMENT)))
    return R.tenure_months(F.col("num_installment"), code)


QUERIES.update(
    raw_dpd=_account(raw_dpd=lambda p: R.raw_dpd(F.col("days_past_due"))),
    derived_dpd=_account(derived_dpd=lambda p: _retail_dpd()),
    derived_dpd_commercial=_rule(
        "commercial_account", "account_key",
        derived_dpd=lambda p: R.derived_dpd_commercial(
            F.col("dpd"), R.norm_asset_class(F.col("asset_class")), F.col("das")
        ),
    ),
    norm_asset_class=_rule(
        "commercial_account", "account_key", asset_class_norm=lambda p: R.norm_asset_class(F.col("asset_class"))
    ),
    norm_instal_freq=_account(freq=lambda p: R.norm_instal_freq(F.col("instal_freq"))),
    freq_or_na=_account(freq=lambda p: R.freq_or_na(F.col("instal_freq"))),
    tenure_months=_account(
        tenure_rounded=lambda p: R.tenure_months(*_c("num_installment", "instal_freq")),
        tenure_floor=lambda p: R.tenure_months(*_c("num_installment", "instal_freq"), "floor"),
        tenure_all_codes=lambda p: _tenure_all_codes(),
    ),
    sdp_rank=_consumer(sdp=lambda p: R.sdp_rank(*_c("state", "district", "pin_code"))),
    sdpcl_rank=_consumer(sdpcl=lambda p: R.sdpcl_rank(*_c("state", "district", "pin_code", "city", "locality"))),
    ownership_flag=_consumer(ownership_ind_flag=lambda p: R.ownership_flag(F.col("ownership_ind"))),
    age_at=_consumer(
        age_years=lambda p: R.age_at(p.as_of, F.col("birth_dt")),
        age_reported=lambda p: F.round(R.age_at_reported(p.as_of, *_c("birth_dt", "age", "age_as_on_dt")), 4),
    ),
    loan_amount=_account(loan_amount=lambda p: _loan()),
    exposure_amount=_account(
        exposure=lambda p: R.exposure_amount(*_c("current_balance", "high_credit", "disbursed_amount", "credit_limit"))
    ),
    not_closed=_account(not_closed_ind=lambda p: R.not_closed(*_c("closed_dt", "act_reported_dt"))),
    is_active=_account(
        active_portfolio=lambda p: R.is_active(*_c("closed_dt", "das"), p.as_of),
        active_book=lambda p: R.is_active(*_c("closed_dt", "das"), p.as_of, P.ACTIVE_BOOK),
        active_strict=lambda p: R.is_active(*_c("closed_dt", "das"), p.as_of, P.ACTIVE_STRICT),
    ),
    closed_ind_noc=_account(closed_dt_ind=lambda p: R.closed_ind_noc(*_c("closed_dt", "das"), p.as_of)),
    overdue_ind=_account(
        overdue_ind=lambda p: R.overdue_ind(R.raw_dpd(F.col("days_past_due")), F.col("amount_overdue_total"), _loan())
    ),
    not_stipulated=_account(
        stipulation=lambda p: R.not_stipulated(
            R.raw_dpd(F.col("days_past_due")), F.col("amount_overdue_total"), _loan()
        )
    ),
    mfi_status=_account(mfi_das=_status),
    active_lender=_account(
        active_lender=lambda p: R.active_lender(_status(p), F.col("closed_dt"), p.as_of, F.col("lender_id"))
    ),
    loan_state=_account(loan_state=lambda p: R.loan_state(F.col("closed_dt"), p.as_of, F.col("das"))),
    months_on_book=_account(
        mob=lambda p: R.months_on_book(*_c("act_reported_dt", "disbursed_dt")),
        vintage_mob=lambda p: R.months_on_book(p.as_of, F.col("disbursed_dt"), plus=1),
    ),
    lender_type=_account(
        lender_type=lambda p: R.lender_type(F.col("lender_id")),
        lender_type_self=lambda p: R.lender_type(F.col("lender_id"), p.self_lender),
        lender_class=lambda p: R.lender_class(F.col("lender_id"), p.self_lender),
    ),
    peer_group=_account(
        peer_group=lambda p: R.peer_group(F.col("lender_id"), p.card_groups, p.card_group_default, p.card_lender)
    ),
    product_class=_account(
        product_profile=lambda p: R.product_class(F.col("account_type")),
        product_dashboard=lambda p: R.product_class(F.col("account_type"), "dashboard"),
    ),
    clean_digits=_account(digits=lambda p: R.clean_digits(F.col("days_past_due"))),
    suppress_code=_account(suppress_code=lambda p: R.suppress_code(F.col("suppress_indicator"))),
    min_due_calc=_account(
        min_due_calc=lambda p: R.min_due_calc(*_c("disbursed_amount", "num_installment")),
        min_due_both=lambda p: R.min_due_both(*_c("min_amount_due", "disbursed_amount", "num_installment")),
    ),
    pct_change=_account(
        pct=lambda p: R.pct_change(*_c("high_credit", "current_balance")),
        diff=lambda p: R.diff(*_c("high_credit", "current_balance")),
    ),
)


@query
def product_category(book: Book, p: P.RunParams) -> DataFrame:
    retail = book.account().select("account_key", R.product_category(F.col("account_type")).alias("category"))
    commercial = book.commercial_account().select(
        "account_key", R.product_category(F.col("credit_type"), "commercial").alias("category")
    )
    return retail.unionByName(commercial)


@query
def purpose_code(book: Book, p: P.RunParams) -> DataFrame:
    return book.purpose_dim().select(
        "lender_id", "loan_purpose", R.purpose_code(F.col("purpose_status")).alias("purpose_code")
    )


@query
def occupation_code(book: Book, p: P.RunParams) -> DataFrame:
    words = {
        "AUTOMOBILE": "Employed", "BUILDING": "self employed", "FURNITURE": "Agriculture and Allied",
        "HOUSEHOLD": None, "MACHINERY": "null",
    }
    text = None
    for segment, word in words.items():
        test = F.col("occupation") == segment
        text = F.when(test, F.lit(word)) if text is None else text.when(test, F.lit(word))
    return book.consumer().select("consumer_key", R.occupation_code(text).alias("occupation_code"))


@query
def debt_ratios(book: Book, p: P.RunParams) -> DataFrame:
    incomes = book.consumer().select("consumer_key", "annual_income")
    rows = book.account().join(incomes, "consumer_key")
    open_loans = F.when(F.col("closed_dt").isNull(), 1).otherwise(0)
    ratios = R.debt_ratios(*_c("min_amount_due", "annual_income"), F.abs("current_balance"), open_loans)
    return rows.select("account_key", "consumer_key", *[expr.alias(name) for name, expr in ratios.items()])


@query
def bucket_dpd(book: Book, p: P.RunParams) -> DataFrame:
    rows = book.account().withColumn("d", _retail_dpd())
    d, das, due, amount = _c("d", "das", "amount_overdue_total", "disbursed_amount")
    return rows.select(
        "account_key",
        B.bucket(d, B.DPD7).alias("dpd7"),
        B.dpd_account(d, das.isin(*P.ACTIVE_PORTFOLIO)).alias("dpd_account"),
        B.dpd14(d, F.abs(due), amount).alias("dpd14"),
        B.dpd_worst(das, d, due, amount).alias("dpd_worst"),
        B.bucket(d, B.DPD_FLOW9).alias("dpd_flow9"),
        B.bucket(d, B.DPD_FLOW5).alias("dpd_flow5"),
    )


@query
def bucket_amount(book: Book, p: P.RunParams) -> DataFrame:
    balance = F.abs("current_balance")
    return book.account().select(
        "account_key",
        B.bucket(balance, B.AMOUNT6).alias("amount6"),
        B.bucket(balance * 100, B.AMOUNT10).alias("amount10"),
        B.bucket(F.col("high_credit"), B.TICKET30).alias("ticket30"),
        B.bucket(F.col("high_credit"), B.EXPOSURE12).alias("exposure12"),
        B.bucket(F.col("min_amount_due"), B.MIN_DUE13).alias("min_due13"),
    )


@query
def bucket_term(book: Book, p: P.RunParams) -> DataFrame:
    quarters = F.broadcast(dims.date_dim(book.spark, p.calendar))
    rows = book.account().withColumn("m", R.months_on_book(p.as_of, F.col("disbursed_dt")))
    rows = rows.withColumn("yyyymm", R.yyyymm(F.col("disbursed_dt"))).join(quarters, "yyyymm", "left")
    m, cycle = F.col("m"), F.trim("loan_cycle_id")
    return rows.select(
        "account_key",
        B.bucket(m, B.VINTAGE9).alias("vintage9"),
        B.bucket(m, B.VINTAGE9_MONTHS).alias("vintage9_months"),
        B.bucket(m, B.MOB13).alias("mob13"),
        B.bucket(F.col("num_installment"), B.INSTAL4).alias("instal4"),
        B.cycle3(cycle).alias("cycle3"),
        B.cycle9(cycle).alias("cycle9"),
        B.disbursed_period(F.col("disbursed_dt"), p.period_cutoff).alias("disbursed_period"),
        B.origination_period(F.col("disbursed_dt"), P.shift_months(p.as_of, -36), F.col("fyq")).alias(
            "origination_period"
        ),
    )


@query
def bucket_people(book: Book, p: P.RunParams) -> DataFrame:
    age = R.age_at_reported(p.as_of, *_c("birth_dt", "age", "age_as_on_dt"))
    return book.consumer().select(
        "consumer_key",
        B.bucket(F.col("monthly_income"), B.INCOME7).alias("income7"),
        B.bucket(age, B.AGE12).alias("age12"),
    )


@query
def bucket_ratio(book: Book, p: P.RunParams) -> DataFrame:
    percent = R.ratio(F.abs("current_balance"), F.col("disbursed_amount"), 100)
    return book.account().select("account_key", percent.alias("p")).select(
        "account_key",
        B.bucket(F.col("p"), B.DTI6).alias("dti6"),
        B.bucket(F.col("p") * 10, B.PTI6).alias("pti6"),
        B.bucket(F.col("p"), B.MIN_DUE_RATIO10).alias("min_due_ratio10"),
    )


@query
def bucket_count(book: Book, p: P.RunParams) -> DataFrame:
    per_lender = book.account().groupBy("consumer_key", "lender_id").agg(F.count(F.lit(1)).alias("n"))
    counts = per_lender.groupBy("consumer_key").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("l"))
    return counts.select(
        "consumer_key",
        B.bucket(F.col("n"), B.LOAN_COUNT6).alias("loan_count6"),
        B.bucket(F.col("l"), B.LENDER_COUNT5).alias("lender_count5"),
        B.bucket(F.col("n"), B.LENDER_COUNT8).alias("lender_count8"),
    )


@query
def bucket_relabel(book: Book, p: P.RunParams) -> DataFrame:
    label = B.bucket(F.col("high_credit"), B.EXPOSURE12)
    return book.account().select("account_key", B.relabel(label, B.EXPOSURE_RELABEL).alias("credit_exposure"))


# --- snapshots -------------------------------------------------------------------
@query
def hanging_accounts(book: Book, p: P.RunParams) -> DataFrame:
    return snapshot.hanging_accounts(book.account_trend(), book.account(), p.as_of)


@query
def latest_update(book: Book, p: P.RunParams) -> DataFrame:
    return snapshot.latest_update(book.account_update(), p.as_of)


@query
def as_of_snapshot(book: Book, p: P.RunParams) -> DataFrame:
    return snapshot.as_of_snapshot(book.account(), book.account_trend(), book.account_update(), p.as_of)


SNAPSHOT_MONTHS = 12


@query
def snapshot_months(book: Book, p: P.RunParams) -> DataFrame:
    """The portfolios of the last twelve month ends from one pass over history."""
    dates = _month_ends(p, SNAPSHOT_MONTHS)
    return intervals.snapshots(book.account(), book.account_trend(), book.account_update(), dates)


@query
def validity_intervals(book: Book, p: P.RunParams) -> DataFrame:
    """From when until before when every account reported the same status."""
    found = intervals.validity(book.account_trend(), "account_key", ["das", "asset_class"])
    return found.select(
        "account_key", "valid_from", "valid_to", F.size("days").alias("reports"), F.col("states")[0]["das"].alias("das"),
        F.col("states")[0]["asset_class"].alias("asset_class"),
    )


@query
def prod_plus_trend(book: Book, p: P.RunParams) -> DataFrame:
    return snapshot.prod_plus_trend(book.account_trend(), book.account(), book.account_party())


@query
def partition_upsert(book: Book, p: P.RunParams) -> DataFrame:
    base = book.account_trend()
    late = (F.col("das") == "S05") & (F.month("act_reported_dt") == 12)
    restated = base.where(late).withColumn("current_balance", F.expr(times("current_balance", "0.90")))
    return snapshot.partition_upsert(base, restated, "act_reported_dt", "account_key")


@query
def partition_rewrite(book: Book, p: P.RunParams) -> DataFrame:
    """The same over a stored history with a folder per month end: only the folders the delta touches are read and written."""
    path = io.new_table_path(book.spark, "history")
    rows = book.account_trend()
    io.write_period(rows, path, ["act_reported_dt"])
    stored = book.spark.read.schema(rows.schema).parquet(path)
    late = (F.col("das") == "S05") & (F.month("act_reported_dt") == 12)
    restated = stored.where(late).withColumn("current_balance", F.expr(times("current_balance", "0.90")))
    upsert_periods(stored, restated, path, "act_reported_dt", "account_key")
    return book.spark.read.schema(rows.schema).parquet(path)


@query
def open_closed_union(book: Book, p: P.RunParams) -> DataFrame:
    return snapshot.open_closed_union(book.macro_open(), book.macro_closed(), p.as_of, p.report_cut)


@query
def open_closed_union_uncapped(book: Book, p: P.RunParams) -> DataFrame:
    return snapshot.open_closed_union(book.macro_open(), book.macro_closed(), p.as_of, p.report_cut, cap_all=False)


# --- borrowers -------------------------------------------------------------------
@query
def cluster_map(book: Book, p: P.RunParams) -> DataFrame:
    return entity.cluster_map(book.cluster_pair())


@query
def attach_cluster(book: Book, p: P.RunParams) -> DataFrame:
    rows = book.account().select("account_key", "consumer_key", "lender_id")
    return entity.attach_cluster(rows, book.clusters(), keys_like=rows)


@query
def same_cluster_universe(book: Book, p: P.RunParams) -> DataFrame:
    accounts = book.account().select("account_key", "consumer_key", "account_type")
    base = accounts.where(F.col("account_type") == P.CONSUMER_LOAN_TYPE)
    return entity.same_cluster_universe(base, book.clusters(), accounts)


@query
def latest_consumer(book: Book, p: P.RunParams) -> DataFrame:
    return entity.latest_consumer(book.account_party())


@query
def unique_account_row(book: Book, p: P.RunParams) -> DataFrame:
    return entity.unique_account_row(book.account_party(), book.geo_fill())


@query
def cross_bureau_flag(book: Book, p: P.RunParams) -> DataFrame:
    retail = book.account().select("account_key", "lender_id", "account_nbr")
    return entity.cross_bureau_flag(retail, book.commercial_account())


@query
def golden_address(book: Book, p: P.RunParams) -> DataFrame:
    return entity.golden_address(book.cluster_member())


@query
def survivorship(book: Book, p: P.RunParams) -> DataFrame:
    return entity.survivorship(book.cluster_member())


@query
def one_view(book: Book, p: P.RunParams) -> DataFrame:
    return entity.one_view(book.cluster_member())


@query
def market_entry(book: Book, p: P.RunParams) -> DataFrame:
    rows = book.cluster_member().select("account_key", "consumer_key", "clst_id", "disbursed_dt")
    return entity.market_entry(rows, p.entry_years)


@query
def cluster_min_disbursal(book: Book, p: P.RunParams) -> DataFrame:
    rows = as_of_snapshot(book, p).select("consumer_key", "disbursed_dt")
    return entity.cluster_min_disbursal(rows, book.clusters())


@query
def income_extra_cols(book: Book, p: P.RunParams) -> DataFrame:
    accounts = book.account()
    untidy = accounts.select("account_key", F.concat(F.lit(" "), F.lower("account_nbr")).alias("account_nbr"))
    people = book.account_party().select(
        "account_key", "consumer_key", "lender_id", "annual_income", "monthly_income"
    ).join(untidy, "account_key")
    return entity.income_extra_cols(people, book.clusters(), accounts, book.hot).drop("account_nbr")


# --- cluster profile and dashboards ------------------------------------------------
def _cluster_base(book: Book, dates, by_cluster: bool = False) -> DataFrame:
    return clusters.cluster_base(
        book.macro_open(), book.macro_closed(), book.clusters(), book.extra_columns(), dates, book.hot, by_cluster
    )


def stored_caps(book: Book) -> DataFrame:
    """Caps of every scope over all accounts, from the book's table of caps by month; built once for a book."""
    if book.caps is None:
        book.caps = store_caps(book, (caps.ALL_MONTHS,))
    return book.caps.read(caps.ALL_MONTHS)


def store_caps(book: Book, months: tuple[int, ...]) -> PeriodTable:
    """Write the histograms of every report month, and from them the caps as known in the given months."""
    spark = book.spark
    rows = caps.amounts(book.account(), R.yyyymm(F.col("act_reported_dt")))
    counts = PeriodTable(spark, f"cap_histogram_{io.unique()}", io.new_table_path(spark, "cap-histogram"), "mon_yr")
    counts.replace_found(caps.month_histograms(rows))
    found = PeriodTable(spark, f"account_cap_{io.unique()}", io.new_table_path(spark, "cap"), "mon_yr")
    found.replace_found(caps.caps_at(rows, counts.read(), months))
    return found


def _flagged(book: Book, dates, by_cluster: bool = False) -> DataFrame:
    found = stored_caps(book)
    return clusters.threshold_flags(_cluster_base(book, dates, by_cluster), caps.overall(found), caps.per_type(found))


def _profile(book: Book, p: P.RunParams, dates) -> DataFrame:
    return clusters.cluster_profile(_flagged(book, dates, by_cluster=True), p.self_lender)


@query
def derive_account_rows(book: Book, p: P.RunParams) -> DataFrame:
    rows = _cluster_base(book, p.dashboard_dates)
    return rows.select(
        "as_of", "clst_id", "account_key", "consumer_key", "das_flag", "instal_freq", "days_past_due", "dpd", "age",
        "sdp", "ownership_ind_flag", "current_balance", "high_credit", "annual_income", "min_amount_due",
    )


@query
def cluster_mix(book: Book, p: P.RunParams) -> DataFrame:
    return clusters.cluster_mix(_cluster_base(book, p.dashboard_dates), p.self_lender)


@query
def threshold_flags(book: Book, p: P.RunParams) -> DataFrame:
    return _flagged(book, p.dashboard_dates).select(
        "as_of", "account_key", "consumer_key", "min_amt_threshold", "threshold_flag_overall", "threshold_acnt_type"
    )


CAP_MONTHS = 3


@query
def caps_by_month(book: Book, p: P.RunParams) -> DataFrame:
    """Caps per account type and over all types as known at three month ends, from histograms merged over the months before."""
    months = tuple(R.yyyymm_of(day) for day in _month_ends(p, CAP_MONTHS))
    return store_caps(book, months).read().select("mon_yr", "scope", *caps.CAPS.values())


@query
def threshold_caps(book: Book, p: P.RunParams) -> DataFrame:
    return book.threshold()


@query
def income_row_rank(book: Book, p: P.RunParams) -> DataFrame:
    rows = _cluster_base(book, p.dashboard_dates).select(
        "as_of", "clst_id", "account_key", "consumer_key", "annual_income", "monthly_income", "reported_dt", "disbursed_dt"
    )
    return clusters.income_row_rank(rows, book.scope.share).drop("reported_dt", "disbursed_dt")


@query
def income_final(book: Book, p: P.RunParams) -> DataFrame:
    return income_row_rank(book, p).select(
        "account_key", "consumer_key", "clst_id",
        R.income_final(*_c("annual_income", "rw", "monthly_income", "rw_month")).alias("income_final"),
    )


@query
def cluster_profile(book: Book, p: P.RunParams) -> DataFrame:
    return _profile(book, p, p.dashboard_dates)


@query
def account_type_cluster_counts(book: Book, p: P.RunParams) -> DataFrame:
    return clusters.account_type_cluster_counts(_cluster_base(book, (p.as_of,)))


@query
def portfolio_dashboard(book: Book, p: P.RunParams) -> DataFrame:
    return dashboard.portfolio_dashboard(cluster_profile(book, p))


@query
def account_count_dashboard(book: Book, p: P.RunParams) -> DataFrame:
    return dashboard.account_count_dashboard(cluster_profile(book, p))


@query
def account_dashboard(book: Book, p: P.RunParams) -> DataFrame:
    flagged = book.scope.share(_flagged(book, p.dashboard_dates))
    return dashboard.account_dashboard(flagged, clusters.cluster_profile(flagged, p.self_lender, top_row=True), p.self_lender, book.hot)


def _backfilled(book: Book, p: P.RunParams, *columns: str) -> DataFrame:
    """Profiles with the back-filled income. What is shared holds all its columns, so those a reader has no use for are left out before."""
    prior = P.shift_months(p.dashboard_dates[0], -2)
    profile = book.scope.share(_profile(book, p, (prior, *p.dashboard_dates)).select(*columns))
    earlier = F.col("as_of") == F.lit(prior)
    return dashboard.income_backfill(profile.where(~earlier), profile.where(earlier))


@query
def income_backfill(book: Book, p: P.RunParams) -> DataFrame:
    return _backfilled(book, p, "*")


@query
def dti_table(book: Book, p: P.RunParams) -> DataFrame:
    return dashboard.dti_table(_backfilled(book, p, *dashboard.DTI_COLUMNS)).select(
        "as_of", "clst_id", "clust_ind", "min_due_all", "annual_income_latest", "outstanding_all", "active_loans_all",
        "debt_income_ratio", "annual_income_new", "min_due_annual", "min_due_ratio", "debt_to_income_final",
        "portfolio_to_income", "debt_to_income_active",
    )


@query
def dti_dashboard(book: Book, p: P.RunParams) -> DataFrame:
    return dashboard.dti_dashboard(dashboard.dti_table(_backfilled(book, p, *dashboard.DTI_DASHBOARD_COLUMNS)))


# --- reports ----------------------------------------------------------------------
def _macro_rows(book: Book, p: P.RunParams) -> DataFrame:
    return snapshot.open_closed_union(book.macro_open(), book.macro_closed(), p.as_of, p.report_cut)


@query
def par_report(book: Book, p: P.RunParams) -> DataFrame:
    return par.par_report(_macro_rows(book, p), dims.lender_dim(book.spark), p.as_of)


@query
def par_report_one_lender(book: Book, p: P.RunParams) -> DataFrame:
    rows = open_closed_union_uncapped(book, p)
    return par.par_report_one_lender(
        rows, dims.lender_dim(book.spark), p.as_of, "PRB001", ("A13", "A07", "A12", "A15", "A06")
    )


def _report_runs(book: Book) -> DataFrame:
    """History rows as one run and current rows as a second, both with the account's amounts."""
    shared = ["account_key", "account_type", "lender_id", "reported_dt", "closed_dt", "das", "current_balance",
              "amount_overdue_total", "chargeoff_amt", "days_past_due", "asset_class"]
    amounts = ["high_credit", "disbursed_amount", "credit_limit"]
    current = book.account()
    past = book.account_trend().select(*shared).join(current.select("account_key", *amounts), "account_key")
    return past.withColumn("run", F.lit(1)).unionByName(
        current.select(*shared, *amounts).withColumn("run", F.lit(2))
    )


@query
def par_report_by_month(book: Book, p: P.RunParams) -> DataFrame:
    return par.par_report_by_month(_report_runs(book), dims.lender_dim(book.spark))


@query
def report_dedupe(book: Book, p: P.RunParams) -> DataFrame:
    return par.report_dedupe(par_report_by_month(book, p), p.as_of)


@query
def month_over_month(book: Book, p: P.RunParams) -> DataFrame:
    return par.month_over_month(report_dedupe(book, p), p.as_of)


@query
def share_filter(book: Book, p: P.RunParams) -> DataFrame:
    return par.share_filter(report_dedupe(book, p))


@query
def report_outliers(book: Book, p: P.RunParams) -> DataFrame:
    report = book.scope.share(report_dedupe(book, p))
    return par.report_outliers(par.month_over_month(report, p.as_of), par.share_filter(report))


@query
def vintage_cube(book: Book, p: P.RunParams) -> DataFrame:
    prod = entity.cross_bureau_flag(book.account(), book.commercial_account())
    return vintage.vintage_cube(book.account_trend(), prod, p)


@query
def vintage_cube_commercial(book: Book, p: P.RunParams) -> DataFrame:
    return vintage.vintage_cube_commercial(book.commercial_trend(), book.commercial_account(), p)


# --- fact table ---------------------------------------------------------------------
def _step1(book: Book, p: P.RunParams) -> DataFrame:
    snapshot_rows = book.scope.share(as_of_snapshot(book, p))
    return facts.mfi_step1(snapshot_rows, book.clusters(), book.account_party(), book.hot)


def _step2(book: Book, p: P.RunParams, columns: tuple[str, ...] | None = None) -> DataFrame:
    step1 = book.scope.share(_step1(book, p))
    return facts.mfi_step2(
        step1, dims.lender_dim(book.spark), book.purpose_dim(), book.occupation_dim(), book.geo_dim(), p, columns
    )


def _fact(book: Book, p: P.RunParams) -> DataFrame:
    return facts.fact_keys(fact_rollup(book, p), dims.bucket_dims(book.spark))


def _shared_step2(book: Book, p: P.RunParams) -> DataFrame:
    return book.scope.share(_step2(book, p, geo.EXPOSURE_INPUT))


def _yyyymm(p: P.RunParams) -> int:
    return R.yyyymm_of(p.as_of)


@query
def mfi_step1(book: Book, p: P.RunParams) -> DataFrame:
    return _step1(book, p)


@query
def group_share(book: Book, p: P.RunParams) -> DataFrame:
    rows = book.scope.share(as_of_snapshot(book, p).select(
        "account_key", "lender_id", "loan_category", "group_id", *facts.SHARED_MONEY
    ))
    return facts.group_share(rows, p.group_lender, p.group_category)


@query
def geo_key_join(book: Book, p: P.RunParams) -> DataFrame:
    untidy = F.concat(F.substring("pin_code", 1, 3), F.lit("-"), F.substring("pin_code", 4, 3))
    people = book.consumer().select("consumer_key", "state", "district", untidy.alias("pin_code"))
    return facts.geo_key_join(people, book.geo_dim()).select("consumer_key", "sdp_key")


@query
def mfi_step2(book: Book, p: P.RunParams) -> DataFrame:
    return _step2(book, p).withColumn("age", F.round("age", 4))


@query
def fact_rollup(book: Book, p: P.RunParams) -> DataFrame:
    return facts.fact_rollup(_step2(book, p, facts.ROLLUP_INPUT), dims.category_dim(book.spark))


PORTFOLIO_LABELS = ["load_yyyymm", "contri_key", "ln_cat", "loan_account_status"]


@query
def fact_rollup_portfolio(book: Book, p: P.RunParams) -> DataFrame:
    """The same sums and distinct counts by lender, category and state: groups of many accounts, centres and consumers."""
    return facts.fact_rollup(_step2(book, p, facts.ROLLUP_INPUT), dims.category_dim(book.spark), PORTFOLIO_LABELS)


@query
def fact_keys(book: Book, p: P.RunParams) -> DataFrame:
    return _fact(book, p)


@query
def par_report_from_fact(book: Book, p: P.RunParams) -> DataFrame:
    return facts.par_report_from_fact(
        _fact(book, p), dims.lender_dim(book.spark), dims.category_dim(book.spark), _yyyymm(p)
    )


def stored_facts(book: Book, p: P.RunParams, months: int) -> PeriodTable:
    """The facts of the run's month and of some before it, kept by month; a month that the book has stored is not built again.

    The table lies in the shared folder. It is there for later runs, and whoever
    no longer wants it calls its `drop`.
    """
    if book.facts is None:
        book.facts = PeriodTable(
            book.spark, f"loan_fact_{io.unique()}", io.new_table_path(book.spark, "fact"), "load_yyyymm"
        )
    known = book.facts.periods()
    missing = tuple(day for day in _month_ends(p, months) if R.yyyymm_of(day) not in known)
    if missing:
        replace_facts(book, p, book.facts, missing)
    return book.facts


def _month_ends(p: P.RunParams, months: int) -> tuple[date, ...]:
    return tuple(P.shift_months(p.as_of, -n) for n in range(months))


def _step2_of(
    book: Book, p: P.RunParams, dates: tuple[date, ...], own: scope.Scope, columns: tuple[str, ...]
) -> DataFrame:
    """The cleaned grain of several dates from one pass over history, which keeps on disk only what `columns` need."""
    rows = intervals.portfolios(book.account(), book.account_trend(), book.account_update(), dates).drop(*facts.unread(columns))
    step1 = own.share(facts.mfi_step1(own.share(rows), book.clusters(), book.account_party(), book.hot).drop(*facts.unread(columns)))
    return facts.mfi_step2(
        step1, dims.lender_dim(book.spark), book.purpose_dim(), book.occupation_dim(), book.geo_dim(), p, columns
    )


def replace_facts(book: Book, p: P.RunParams, table: PeriodTable, dates: tuple[date, ...]) -> None:
    """Build the facts of the given month ends together and put them in place of what the table has of these months."""
    with scope.Scope() as own:
        rollup = facts.fact_rollup(_step2_of(book, p, dates, own, facts.ROLLUP_INPUT), dims.category_dim(book.spark))
        table.replace_found(facts.fact_keys(rollup, dims.bucket_dims(book.spark)), tuple(R.yyyymm_of(day) for day in dates), dealt=True)


@query
def stored_fact_months(book: Book, p: P.RunParams) -> DataFrame:
    """Facts of two months in one named table; the later month is written twice and replaces itself."""
    table = stored_facts(book, p, 2)
    replace_facts(book, p, table, (p.as_of,))
    return table.read().groupBy("load_yyyymm", "contri_key").agg(
        F.count(F.lit(1)).alias("facts"), F.sum("total_accounts").alias("total_accounts"),
        F.sum("total_outstanding_amount").alias("total_outstanding_amount"),
    )


@query
def fact_month_over_month(book: Book, p: P.RunParams) -> DataFrame:
    return par.month_over_month(_fact_reports(book, p), p.as_of.replace(day=1))


@query
def fact_report_outliers(book: Book, p: P.RunParams) -> DataFrame:
    report = book.scope.share(_fact_reports(book, p))
    return par.report_outliers(par.month_over_month(report, p.as_of.replace(day=1)), par.share_filter(report))


MONITOR_MONTHS = 4


def _fact_reports(book: Book, p: P.RunParams) -> DataFrame:
    """The reports from the stored facts of the run's month and of the three before it, dated by the first of the month."""
    table = stored_facts(book, p, MONITOR_MONTHS)
    lenders, categories = dims.lender_dim(book.spark), dims.category_dim(book.spark)
    months = [R.yyyymm_of(day) for day in _month_ends(p, MONITOR_MONTHS)]
    reports = [facts.par_report_from_fact(table.read(month), lenders, categories, month) for month in months]
    runs = functools.reduce(DataFrame.unionByName, reports).withColumn("run", F.lit(1))
    return par.report_dedupe(runs, p.as_of.replace(day=1))


MEMBER_KINDS = {"consumers": "consumer_key", "accounts": "account_key", "clusters": "clst_id"}
MEMBER_MONTHS = 2


def stored_members(book: Book, p: P.RunParams) -> PeriodTable:
    """Who stands behind each (place, lender) of the run's month and the one before it, as bits, kept by month."""
    spark = book.spark
    numbers = {}
    for kind, key in MEMBER_KINDS.items():
        known = book.cluster_member().select(F.coalesce("clst_id", "consumer_key").alias("clst_id")) if key == "clst_id" else book.account()
        numbers[kind] = key, members.numbered(known, key, io.new_table_path(spark, f"numbers-{kind}"))
    table = PeriodTable(spark, f"fact_member_{io.unique()}", io.new_table_path(spark, "member"), "load_yyyymm")
    with scope.Scope() as own:
        rows = own.share(_step2_of(book, p, _month_ends(p, MEMBER_MONTHS), own, ("sdp_key", "contri_key", "consumer_key", "clst_id")).select(
            "sdp_key", "contri_key", R.yyyymm(F.col("as_of")).alias("load_yyyymm"), *MEMBER_KINDS.values()
        ))
        table.replace_found(members.members(rows, ["sdp_key", "contri_key", "load_yyyymm"], numbers))
    return table


@query
def members_by_place(book: Book, p: P.RunParams) -> DataFrame:
    """Distinct consumers, accounts and clusters by state and district over two months, added up from stored members.

    A consumer with loans at several lenders, places of a district or months counts once.
    """
    stored = stored_members(book, p).read()
    places = book.geo_dim().select("sdp_key", "rev_state", "rev_district")
    return members.counted(stored.join(places, "sdp_key"), ["rev_state", "rev_district"], list(MEMBER_KINDS))


# --- geography ----------------------------------------------------------------------
@query
def district_active_base(book: Book, p: P.RunParams) -> DataFrame:
    return geo.district_active_base(_step2(book, p, geo.EXPOSURE_INPUT), book.geo_dim()).select(
        "account_key", "clst_id", "sdp_key", "rev_state", "rev_district", "mfi_das", "cur_bal"
    )


@query
def district_cluster_profile(book: Book, p: P.RunParams) -> DataFrame:
    return geo.district_cluster_profile(_step2(book, p, geo.EXPOSURE_INPUT), book.geo_dim())


@query
def district_exposure(book: Book, p: P.RunParams) -> DataFrame:
    return geo.district_exposure(_shared_step2(book, p), book.geo_dim(), p.period_cutoff, book.hot)


@query
def district_exposure_self(book: Book, p: P.RunParams) -> DataFrame:
    return geo.district_exposure_self(_shared_step2(book, p), book.geo_dim(), p.period_cutoff, p.self_lender, book.hot)


@query
def exposure_file(book: Book, p: P.RunParams) -> DataFrame:
    return geo.exposure_file(district_exposure(book, p), str(_yyyymm(p)))


@query
def exposure_file_self(book: Book, p: P.RunParams) -> DataFrame:
    return geo.exposure_file(district_exposure_self(book, p), str(_yyyymm(p)))


@query
def active_lender_density(book: Book, p: P.RunParams) -> DataFrame:
    return geo.active_lender_density(_fact(book, p), book.geo_dim(), _yyyymm(p))


def _geo_cube(book: Book, p: P.RunParams, variant: str) -> DataFrame:
    spark = book.spark
    return geo.geo_product_cube(
        stored_facts(book, p, 1).read(_yyyymm(p)), book.geo_dim(), dims.lender_dim(spark),
        dims.date_dim(spark, p.calendar), dims.category_dim(spark), p,
        _yyyymm(p), variant,
    )


@query
def geo_product_cube_1(book: Book, p: P.RunParams) -> DataFrame:
    return _geo_cube(book, p, "RPT1")


@query
def geo_product_cube_2(book: Book, p: P.RunParams) -> DataFrame:
    return _geo_cube(book, p, "RPT2")


@query
def geo_report_1(book: Book, p: P.RunParams) -> DataFrame:
    return geo.geo_report(geo_product_cube_1(book, p))


@query
def geo_report_2(book: Book, p: P.RunParams) -> DataFrame:
    return geo.geo_report(geo_product_cube_2(book, p))


# --- cards and flows ----------------------------------------------------------------
def _cards(book: Book, p: P.RunParams) -> DataFrame:
    return cards.card_base(
        book.account_trend(), book.account(), unique_account_row(book, p), book.clusters(), caps.per_type(stored_caps(book)), p,
        book.hot,
    )


def _spine(book: Book, p: P.RunParams) -> DataFrame:
    return cards.quarter_spine_agg(_cards(book, p), p.quarter_ends, p.low_balance)


@query
def card_base(book: Book, p: P.RunParams) -> DataFrame:
    return _cards(book, p)


@query
def quarter_spine_agg(book: Book, p: P.RunParams) -> DataFrame:
    return _spine(book, p)


@query
def cc_acquisitions_rank(book: Book, p: P.RunParams) -> DataFrame:
    return cards.cc_acquisitions_rank(_cards(book, p), p)


@query
def cc_early_delinquency(book: Book, p: P.RunParams) -> DataFrame:
    return cards.cc_early_delinquency(_spine(book, p), dims.date_dim(book.spark, p.calendar), p)


@query
def cc_top_cities(book: Book, p: P.RunParams) -> DataFrame:
    return cards.cc_top_cities(_spine(book, p), p)


@query
def cc_portfolio(book: Book, p: P.RunParams) -> DataFrame:
    return cards.cc_portfolio(_spine(book, p), p)


@query
def cc_self_rank(book: Book, p: P.RunParams) -> DataFrame:
    return cards.cc_self_rank(_spine(book, p), p)


@query
def cc_low_utilisation(book: Book, p: P.RunParams) -> DataFrame:
    return cards.cc_low_utilisation(_spine(book, p), p)


@query
def cc_delinquency_pct(book: Book, p: P.RunParams) -> DataFrame:
    return cards.cc_delinquency_pct(_spine(book, p), p)


def roll_params(p: P.RunParams) -> P.RunParams:
    """All products and months: pairs twelve months apart are rare in the small tables."""
    return dataclasses.replace(p, card_types=dims.ACCOUNT_TYPES, roll_months=tuple(range(1, 13)))


@query
def roll_rate(book: Book, p: P.RunParams) -> DataFrame:
    return cards.roll_rate(_cards(book, p), p)


@query
def roll_rate_all_products(book: Book, p: P.RunParams) -> DataFrame:
    wide = roll_params(p)
    return cards.roll_rate(_cards(book, wide), wide)


ROLL_LAGS = (1, 3, 6, 12)


@query
def roll_rate_lags(book: Book, p: P.RunParams) -> DataFrame:
    """Roll rates of all products over one, three, six and twelve months, from one scan of the accounts."""
    wide = roll_params(p)
    return cards.roll_rates(_cards(book, wide), wide, ROLL_LAGS)


@query
def share_of_wallet(book: Book, p: P.RunParams) -> DataFrame:
    return cards.share_of_wallet(_cards(book, p), p)


def _all_products(book: Book, p: P.RunParams) -> DataFrame:
    held = book.cluster_member().select("account_key", "clst_id")
    return cards.all_product_base(book.account_trend(), book.account(), held, _cards(book, p), p)


@query
def all_product_base(book: Book, p: P.RunParams) -> DataFrame:
    return _all_products(book, p)


@query
def new_vs_known(book: Book, p: P.RunParams) -> DataFrame:
    return cards.new_vs_known(_all_products(book, p), p)


def _flows(book: Book, p: P.RunParams, lapses: tuple[int, ...]) -> DataFrame:
    return flow.flow_rate(
        book.account_trend(), book.account(), unique_account_row(book, p), caps.per_type(stored_caps(book)),
        dims.account_type_dim(book.spark), dims.date_dim(book.spark, p.calendar), p, lapses,
    )


@query
def flow_rate(book: Book, p: P.RunParams) -> DataFrame:
    return _flows(book, p, (p.time_lapse_months,))


@query
def flow_rate_months(book: Book, p: P.RunParams) -> DataFrame:
    """Flow rates of several lags from one scan of history, without writing them."""
    return _flows(book, p, p.flow_lapses)


@query
def flow_rate_next_month(book: Book, p: P.RunParams) -> DataFrame:
    """Flow rates to the next month, where most loans of the small tables are seen again."""
    return _flows(book, p, (1,))


@query
def flow_runs(book: Book, p: P.RunParams) -> DataFrame:
    """Flow rates of several lags, from one pass, in one table with a partition per run; a run done again replaces its own."""
    path = io.new_table_path(book.spark, "flow")
    for lapses in (p.flow_lapses, p.flow_lapses[:1]):
        io.write_period(_flows(book, p, lapses), path, ["batch_run"])
    return book.spark.read.parquet(path)


# --- the uneven book ------------------------------------------------------------------
UNEVEN = (
    "open_closed_union", "open_closed_union_uncapped", "month_over_month", "share_filter", "report_outliers",
    "fact_report_outliers",
)


def _on_uneven(name: str) -> Query:
    def run(book: Book, p: P.RunParams) -> DataFrame:
        other = UnevenBook(book.spark, book.folder)
        other.scope = book.scope
        return QUERIES[name](other, p)

    return run


QUERIES.update({f"uneven_{name}": _on_uneven(name) for name in UNEVEN})


# --- tables that lie by account ---------------------------------------------------------
def _on_bucketed(run: Query) -> Query:
    def bucketed(book: Book, p: P.RunParams) -> DataFrame:
        other = BucketedBook(book.spark, book.folder)
        other.scope = book.scope
        return run(other, p)

    return bucketed


def _placed_snapshots(book: Book, p: P.RunParams) -> DataFrame:
    return intervals.snapshots(
        book.account(), book.account_trend(), book.account_update(), _month_ends(p, SNAPSHOT_MONTHS), placed=True
    )


QUERIES.update(
    bucketed_prod_plus_trend=_on_bucketed(prod_plus_trend), bucketed_snapshot_months=_on_bucketed(_placed_snapshots),
    bucketed_card_base=_on_bucketed(card_base), bucketed_mfi_step1=_on_bucketed(mfi_step1),
)


# --- input and output ------------------------------------------------------------------
def _source(book: Book) -> io.FileSource:
    return io.FileSource(book.folder)


@query
def read_table(book: Book, p: P.RunParams) -> DataFrame:
    return io.read_table(book.spark, _source(book), "orders", "o_orderstatus = 'F'").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("o_orderdate")
    )


@query
def read_split(book: Book, p: P.RunParams) -> DataFrame:
    rows = io.read_split(book.spark, _source(book), "lineitem", io.Split.by_key("l_orderkey"))
    return rows.groupBy("l_linestatus", "l_returnflag").agg(
        F.count(F.lit(1)).alias("line_items"), F.sum(F.col("l_quantity").cast("int")).alias("quantity")
    )


@query
def load_dims(book: Book, p: P.RunParams) -> DataFrame:
    """Dimensions refreshed into the shared folder, as one list of names."""
    target = io.new_table_path(book.spark, "dims")
    loaded = io.load_dims(book.spark, _source(book), ["region", "nation", "supplier", "part"], target)
    names = {"region": "r_name", "nation": "n_name", "supplier": "s_name", "part": "p_name"}
    frames = [loaded[d].select(F.lit(d).alias("dim"), F.col(c).alias("name")) for d, c in names.items()]
    return functools.reduce(DataFrame.unionByName, frames)


@query
def load_domain_dims(book: Book, p: P.RunParams) -> DataFrame:
    """The dimensions of the loan book, written from their source, then refreshed together from there."""
    spark = book.spark
    frames = {
        "geo": book.geo_dim(), "purpose": book.purpose_dim(), "occupation": book.occupation_dim(), "lender": dims.lender_dim(spark),
        "account_type": dims.account_type_dim(spark), "category": dims.category_dim(spark), "date": dims.date_dim(spark, p.calendar),
    }
    stored = io.new_table_path(spark, "dim-source")
    io.publish_tables(spark, frames, stored)
    source = io.FileSource(stored, suffix="")
    loaded = io.load_dims(spark, source, list(frames), io.new_table_path(spark, "dims"))
    counts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("dim"), "rows") for name, df in loaded.items()]
    return functools.reduce(DataFrame.unionByName, counts)


@query
def load_by_period(book: Book, p: P.RunParams) -> DataFrame:
    """History written under one folder per year, read back for the years up to the as-of date."""
    path = io.new_table_path(book.spark, "history")
    rows = book.account_trend().select("account_key", "act_reported_dt", "das", "current_balance")
    io.load_by_period(rows, path, F.year("act_reported_dt"))
    return book.spark.read.parquet(path).where(F.col("year") <= p.as_of.year)


@query
def write_period(book: Book, p: P.RunParams) -> DataFrame:
    """A partitioned table in which the periods of one restatement are replaced."""
    path = io.new_table_path(book.spark, "periods")
    rows = book.account_trend().select(
        "account_key", "das", "current_balance", R.yyyymm(F.col("act_reported_dt")).alias("period")
    )
    io.write_period(rows, path, ["period"])
    late = rows.where((F.col("das") == "S05") & (F.col("period") % 100 == 12))
    io.write_period(late, path, ["period"])
    return book.spark.read.parquet(path)


@query
def named_table(book: Book, p: P.RunParams) -> DataFrame:
    """Accounts in a named table: written, replaced, appended to and inserted into by name, then read by name."""
    name = f"account_status_{uuid.uuid4().hex}"
    rows = book.account().select("account_key", "das", "current_balance")
    live, closed = F.col("das").isin(*P.ACTIVE_STRICT), F.col("das") == "S06"
    path = io.new_table_path(book.spark, "named")
    io.save_table(rows, name, path)
    io.save_table(rows.where(live), name, path)
    io.save_table(rows.where(closed), name, path, mode="append")
    io.insert_by_name(rows.where(~live & ~closed).select("current_balance", "das", "account_key"), name)
    return io.read_table(book.spark, io.CatalogSource("default"), name)


@query
def export_single_csv(book: Book, p: P.RunParams) -> DataFrame:
    """The risk report as one named file, read back."""
    return _published(book, as_output(par_report(book, p)), f"par_{p.as_of:%Y%m}.csv", ["lender_id", "account_type"])


def _published(book: Book, report: DataFrame, name: str, order: list[str]) -> DataFrame:
    """A finished report as one sorted file under its name, read back."""
    return _read_csv(book, io.export_single_csv(report, io.new_table_path(book.spark, "export"), name, order), report.schema)


def _read_csv(book: Book, path: str, schema: T.StructType) -> DataFrame:
    return book.spark.read.schema(schema).option("header", True).option("sep", "|").csv(path)


@query
def export_exposure_file(book: Book, p: P.RunParams) -> DataFrame:
    report = as_output(exposure_file(book, p))
    return _published(book, report, f"exposure_{_yyyymm(p)}.csv", report.columns[:4])


@query
def export_geo_report_1(book: Book, p: P.RunParams) -> DataFrame:
    report = as_output(geo_report_1(book, p))
    return _published(book, report, f"geo_1_{_yyyymm(p)}.csv", report.columns[:4])


@query
def export_monitor(book: Book, p: P.RunParams) -> DataFrame:
    """The monitor's three files, written together and published together, read back as one list.

    The report, its change over the month before and the outliers read one
    shared report; each file is sorted by lender and loans.
    """
    folder = io.new_table_path(book.spark, "monitor")
    month = p.as_of.replace(day=1)
    with scope.Scope() as own:
        report = own.share(_fact_reports(book, p))
        change = own.share(par.month_over_month(report, month))
        frames = {"report": report, "change": change, "outliers": par.report_outliers(change, par.share_filter(report))}
        ready = {name: as_output(df) for name, df in frames.items()}
        scope.publish(book.spark, {
            f"{folder}/{name}_{_yyyymm(p)}.csv": functools.partial(_monitor_file, df) for name, df in ready.items()
        })
    found = [
        _read_csv(book, f"{folder}/{name}_{_yyyymm(p)}.csv", df.schema).select(F.lit(name).alias("file"), "lender_id", "account_type")
        for name, df in ready.items()
    ]
    return functools.reduce(DataFrame.unionByName, found).groupBy("file", "lender_id", "account_type").agg(
        F.count(F.lit(1)).alias("lines")
    )


def _monitor_file(report: DataFrame, file: str) -> None:
    loans = [c for c in report.columns if c.startswith("total_loans")][:1]
    io.write_single_csv(report, file, ["lender_id", *loans, "account_type"])
