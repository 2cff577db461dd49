"""Steps that move, sort or copy their rows no more often than needed."""

import random
from collections import Counter
from datetime import date, timedelta
from decimal import Decimal
from pathlib import Path

from pyspark.sql import functions as F

from loanbook.operators import caps, clusters, facts, intervals, snapshot
from loanbook.params import DEFAULT_PARAMS
from loanbook.plans import catalog, rank
from loanbook.plans.skew import percentile_exact
from loanbook.sources.bucketed import BucketedBook
from loanbook.sources.views import Book


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df) -> Counter:
    return Counter(tuple(map(str, r)) for r in df.select(*sorted(df.columns)).collect())


def test_intervals_sort_history_once(spark):
    """one sort by key and day, and no aggregate that holds a second copy."""
    history = spark.createDataFrame([(1, None, "a")], "k long, act_reported_dt date, s string")
    plan = plan_of(intervals.validity(history, "k", ["s"]))
    assert plan.count("+- Sort [") == 1 and "Aggregate" not in plan


def test_a_state_that_returns_is_a_new_interval(spark):
    rows = [(1, f"2000-0{n}-01", s) for n, s in enumerate("aabba", 1)] + [(1, "2000-05-01", "c"), (2, "2000-01-01", None)]
    history = spark.createDataFrame(rows, "k long, d string, s string").withColumn("d", F.col("d").cast("date"))
    got = intervals.validity(history, "k", ["s"], day="d").orderBy("k", "valid_from").collect()
    assert [(r.k, str(r.valid_from)[5:7], r.valid_to and str(r.valid_to)[5:7], len(r.days), [x.s for x in r.states]) for r in got] == [
        (1, "01", "03", 2, ["a"]), (1, "03", "05", 2, ["b"]), (1, "05", None, 1, ["a", "c"]), (2, "01", None, 1, [None]),
    ]


def test_counting_in_place_copies_and_hashes_nothing(spark):
    """no row is copied per kind of member, and no table of groups is held."""
    pick = random.Random(3)
    some = lambda n: pick.choice([None, *range(n)])
    rows = [(pick.choice([None, "x", "y"]), some(4), str(some(3)), some(3) and "g", some(5), n, 10 * n, 1, None, n, None) for n in range(400)]
    rows += [("alone", 1, None, "g", 7, 1, 1, 1, None, 1, None)]
    frame = spark.createDataFrame(
        rows, "a string, b int, centre_id string, group_id string, consumer_key long, account_key long, cur_bal int, disb_amt int, "
        "amt_due int, charge_amt int, disb_dt date",
    ).withColumns({c: F.col(c).cast("decimal(18,2)") for c in facts.SUMS})
    got = facts._counted_in_place(frame, ["a", "b"])
    plan = plan_of(got)
    assert "Generate" not in plan and "Aggregate" not in plan and plan.count("Exchange hashpartitioning") == 1
    want = frame.groupBy("a", "b").agg(
        F.count_distinct("centre_id").alias("total_centres"), F.count_distinct("group_id").alias("total_groups"),
        F.count("account_key").alias("total_accounts"), F.count_distinct("consumer_key").alias("total_consumers"),
        *[F.expr(f"coalesce(sum({c}), 0) as {name}") for c, name in facts.SUMS.items()], F.min("disb_dt").alias("oldest_loan"),
    )
    assert got.columns == want.columns and [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
    assert rows_of(got) == rows_of(want)


def test_a_bucket_is_one_file(spark, small):
    """however many tasks write, a bucket of a stored table is one file."""
    made = BucketedBook(spark, small, buckets=5)
    try:
        for kind in made.names:
            assert 0 < len(list(Path(made.path.removeprefix("file:"), kind).glob("*.parquet"))) <= 5
    finally:
        made.drop()


def test_history_beside_current_rows_is_not_moved_again(spark, small):
    """neither history nor current rows of a placed book are moved to be joined to their people."""
    made = BucketedBook(spark, small, buckets=5)
    try:
        full = snapshot.prod_plus_trend(made.account_trend(), made.account(), made.account_party())
        before = plan_of(full).split("Exchange hashpartitioning(account_key")
        assert all("Union" not in part for part in before[1:])
    finally:
        made.drop()


def test_ranks_of_two_values_move_usual_keys_once(spark, monkeypatch):
    """only keys with very many rows are ranked by cells, with the same ranks."""
    monkeypatch.setattr(rank, "PART", 50)
    pick = random.Random(6)
    value = lambda: pick.choice([None, 1, 5, 5, 9])
    rows = [(pick.choice([None, 1, 1, *range(2, 30)]), pick.choice([None, 1, 2]), value(), value(), n) for n in range(900)]
    frame = spark.createDataFrame(rows, "k long, d int, v int, w int, a long")
    assert frame.groupBy("k").count().where("count > 50").count() > 0
    kept = []
    got = rank.descending_ranks(frame, ["k"], ["d"], {"v": "rv", "w": "rw"}, ["a"], lambda df: kept.append(df) or df)
    assert len(kept) == 2
    want = rank.descending_rank(rank.descending_rank(frame, ["k"], ["d"], "v", ["a"], "rv"), ["k"], ["d"], "w", ["a"], "rw")
    assert got.columns == want.columns and rows_of(got) == rows_of(want)


DATES = (date(2000, 6, 30), date(2000, 3, 31), date(2000, 5, 31))  # in no order


def small_book(spark):
    """Open and closed accounts, clusters and incomes with nulls, dates around `DATES` and keys that repeat."""
    pick = random.Random(25)
    some = lambda *values: pick.choice([None, *values])
    day = lambda: some(*[date(2000, 1, 1) + timedelta(n) for n in range(0, 260, 7)])
    macro = ("account_key long, consumer_key long, lender_id string, account_type string, das string, days_past_due string, "
             "asset_class string, high_credit decimal(18,2), disbursed_amount decimal(18,2), credit_limit decimal(18,2), "
             "current_balance decimal(18,2), amount_overdue_total decimal(18,2), chargeoff_amt decimal(18,2), "
             "disbursed_dt date, closed_dt date, reported_dt date, act_insert_dt date, instal_freq string, state string, "
             "district string, pin_code string, ownership_ind string, birth_dt date, das_flag int")

    def accounts(das: tuple, flag: int):
        rows = []
        for n in range(150):
            key = n % 120 + 1000 * flag
            money = [some(*[round(pick.uniform(-900, 900), 2) for _ in range(4)]) for _ in range(6)]
            rows.append((key, some(*range(40)), f"NBF00{key % 3 + 3}", f"A0{key % 7}", some(*das), some("", "DPD 31", "95"), some("L01", "L03"),
                         *money, day(), day() if flag == 0 else some(date(2000, 8, 1)), day(), day(), some("1", "F02"),
                         some("s"), some("d"), some("p"), some("O01"), some(date(1970, 6, 15), date(1980, 4, 30)), flag))
        return spark.createDataFrame([tuple(map(_decimal, r)) for r in rows], macro)

    opened, closed = accounts(("S04", "S05"), 1), accounts(("S06", "S07"), 0)
    found = spark.createDataFrame([(n, some(n // 6, 3)) for n in range(34)], "candidate_id long, clst_id long")
    keys = sorted({(r.account_key, r.consumer_key) for r in opened.unionByName(closed).collect() if r.consumer_key is not None})
    extra = spark.createDataFrame(
        [tuple(map(_decimal, (*pick.choice(keys), some("Y"), some(5.0, 9.5), some(100.0, 250.0), some(10.0)))) for _ in range(200)],
        "account_key long, consumer_key long, suppress_indicator string, min_amount_due decimal(18,2), "
        "annual_income decimal(18,2), monthly_income decimal(18,2)",
    )
    return opened, closed, found, extra


def _decimal(value):
    return Decimal(f"{value:.2f}") if isinstance(value, float) else value


def test_dates_joined_once_give_the_rows_of_each_date(spark):
    """joining before rows are repeated per date changes no row."""
    opened, closed, found, extra = small_book(spark)
    want = Counter()
    for day in DATES:
        at = snapshot.open_closed_union(opened.where(F.col("disbursed_dt") <= F.lit(day)), closed, day, day + timedelta(39))
        rows = snapshot.derive_account_rows(at, day).join(found.withColumnRenamed("candidate_id", "consumer_key"), "consumer_key")
        want += rows_of(rows.join(extra, ["account_key", "consumer_key"], "left").withColumn("as_of", F.lit(day)))
    assert len(want) > 150
    plain = clusters.cluster_base(opened, closed, found, extra, DATES)
    moved = clusters.cluster_base(opened, closed, found, extra, DATES, by_cluster=True)
    assert rows_of(plain) == want == rows_of(moved.drop(clusters.PART))
    ages = {(r.account_key, r.as_of): r.age for r in plain.where("birth_dt = date'1980-04-30'").collect()}
    assert {19, 20} <= set(ages.values()), "age is that of each date"


def test_profiles_of_several_dates_move_no_row_per_date(spark, small):
    """rows are moved by cluster before they are repeated per date; above that only parts of clusters are moved."""
    opened, closed, found, extra = small_book(spark)
    flags = {c: F.lit(1) for c in ("min_amt_threshold", "threshold_flag_overall", "threshold_acnt_type")}
    profiles = [
        clusters.cluster_profile(clusters.cluster_base(opened, closed, found, extra, DATES, by_cluster=moved).withColumns(flags), "NBF004", top_row=True)
        for moved in (False, True)
    ]
    # repeated (account, consumer) rows of equal rank may be told apart by due and lender alone, so the newest row is the same
    assert rows_of(profiles[0]) == rows_of(profiles[1]) and profiles[0].columns == profiles[1].columns
    book = Book(spark, small)
    try:
        plan = plan_of(catalog._profile(book, DEFAULT_PARAMS, DATES))
        assert plan.split("Generate explode(")[0].count("Exchange hashpartitioning") == 1
    finally:
        book.caps.drop()


def test_ratios_keep_only_the_columns_they_read(spark, small):
    """what is kept on disk between the steps holds no metric that the query does not read."""
    for name in ("dti_table", "dti_dashboard"):
        book = Book(spark, small)
        with book.scope:
            kept = plan_of(catalog.QUERIES[name](book, DEFAULT_PARAMS)).split("InMemoryRelation [")[1].split("]")[0]
            assert "min_disb_all" not in kept and "outstanding_all" in kept
        book.caps.drop()


def test_amounts_are_counted_once_for_their_type(spark, small):
    """amounts of all types are merged from the counts by type; only those in a wanted bin are repeated per scope."""
    pick = random.Random(4)
    some = lambda: pick.choice([None, *[round(pick.uniform(-5000, 5000), 2) for _ in range(9)]])
    rows = [tuple(map(_decimal, (pick.choice([None, "A", "B"]), pick.choice([None, 200001, 200003, 200005]), some(), some(), some()))) for _ in range(3000)]
    accounts = spark.createDataFrame(
        rows, "account_type string, m int, current_balance decimal(18,2), disbursed_amount decimal(18,2), min_amount_due decimal(18,2)"
    )
    amounts = caps.amounts(accounts, F.col("m"))
    assert amounts.count() == sum(v is not None for r in rows for v in r[2:])
    counts = caps.month_histograms(amounts)
    keys = ["mon_yr", *caps.KEYS, "bin"]
    assert counts.groupBy(*keys).count().where("count > 1").count() == 0
    n = {r.scope: r.n for r in counts.groupBy("scope").agg(F.sum("n").alias("n")).collect()}
    assert n[caps.ALL_TYPES] == amounts.count() == sum(v for k, v in n.items() if k != caps.ALL_TYPES)
    months = (200002, 200004, caps.ALL_MONTHS)
    got = caps.caps_at(amounts, counts, months)
    seen = {(r.mon_yr, r.scope): r for r in got.where("scope is not null").collect()}
    assert len(seen) == 9
    for month in months:
        known = accounts.where(F.coalesce("m", F.lit(0)) <= month).select(
            "account_type", F.abs("current_balance").alias("balance"), F.abs("disbursed_amount").alias("amount"), F.abs("min_amount_due").alias("due")
        )
        for group in (known.where("account_type is not null"), known.withColumn("account_type", F.lit(caps.ALL_TYPES))):
            for r in percentile_exact(group, "account_type", caps.CAPS, 99).collect():
                mine = seen[month, r.account_type]
                assert (mine.balance_cap, mine.amount_cap, mine.min_due_cap) == (
                    r.balance_cap, r.amount_cap, r.min_due_cap)
