"""Validity intervals, several lags in one pass and members as bits, against loops."""

import dataclasses
import random
from collections import Counter, defaultdict
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from loanbook.functions import buckets as B
from loanbook.operators import cards, flow, intervals, members, snapshot
from loanbook.params import DEFAULT_PARAMS as p
from loanbook.params import shift_months
from loanbook.plans.catalog import QUERIES
from loanbook.sources.views import Book

DATES = tuple(shift_months(p.as_of, -n) for n in range(12))


def scans(df, table: str) -> int:
    return sum(f"{table}.parquet" in line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line)


def rows_of(df) -> Counter:
    names = sorted(df.columns)
    return Counter(tuple(map(str, r)) for r in df.select(*names).collect())


def test_intervals_equal_loops(spark):
    pick = random.Random(4)
    days = [date(2000, 1, 31) + timedelta(days=31 * n) for n in range(9)]
    rows = [(k, pick.choice(days), pick.choice("ab"), pick.choice([None, 1])) for k in range(40) for _ in range(pick.randint(0, 8))]
    rows += [(99, days[0], "a", None), (99, days[0], "a", None), (99, None, "b", 1), (None, days[0], "a", 1)]
    frame = spark.createDataFrame(rows, "k long, act_reported_dt date, s string, n int")
    for distinct in (False, True):
        known = intervals.known_as_of(intervals.validity(frame, "k", ["s", "n"], distinct=distinct), "k", tuple(days))
        got = Counter(tuple(r) for r in known.select("as_of", "k", "act_reported_dt", "s", "n").collect())
        want = Counter()
        for day in days:
            newest = {k: max(d for x, d, _, _ in rows if x == k and d and d <= day) for k in {r[0] for r in rows if r[1] and r[1] <= day}}
            found = Counter((day, k, d, s, n) for k, d, s, n in rows if d and newest.get(k) == d)
            want += Counter(set(found)) if distinct else found
        assert got == want
    spans = intervals.validity(frame, "k", ["s", "n"]).collect()
    held = defaultdict(list)
    for r in sorted(spans, key=lambda r: (str(r.k), r.valid_from)):
        held[r.k].append(r)
    for of_key in held.values():
        assert all(a.valid_to == b.valid_from and a.states != b.states for a, b in zip(of_key, of_key[1:], strict=False))
        assert of_key[-1].valid_to is None


def test_snapshots_of_twelve_dates_equal_one_by_one(spark, small):
    """Also with several updates on one day, repeated rows and accounts whose current row comes late."""
    book = Book(spark, small)
    prod = book.account()
    moved = F.when(F.col("account_key") % 5 == 0, F.date_add("act_reported_dt", 900)).otherwise(F.col("act_reported_dt"))
    prod = prod.withColumn("act_reported_dt", moved)
    updates = book.account_update()
    tied = updates.where("account_key % 3 = 0").withColumn("num_installment", F.lit(77))
    updates = updates.unionByName(tied).unionByName(tied)
    together = intervals.snapshots(prod, book.account_trend(), updates, DATES)
    once = intervals.snapshots(prod, book.account_trend(), book.account_update(), DATES)
    assert scans(once, "lineitem") == 2  # history and restatements, once each
    parts = Counter()
    for day in DATES:
        parts += rows_of(snapshot.as_of_snapshot(prod, book.account_trend(), updates, day))
    assert rows_of(together) == parts
    assert sum(n > 0 for row, n in parts.items() if "T" in row) > 50


def test_lags_of_flows_come_from_one_scan(spark, small):
    book = Book(spark, small)
    together = QUERIES["flow_rate_months"](book, p)
    apart = [QUERIES["flow_rate"](book, dataclasses.replace(p, time_lapse_months=n)) for n in p.flow_lapses]
    assert scans(together, "lineitem") == scans(apart[0], "lineitem") == 1
    assert rows_of(together) == rows_of(apart[0]) + rows_of(apart[1])


def _card_rows(spark, months):
    """400 cards with a random band each month: hundreds of pairs a lag, and months without a row."""
    pick = random.Random(8)
    rows = []
    for card in range(400):
        for n in months:
            if pick.random() < 0.8:
                rows.append((card, shift_months(p.as_of, -n), pick.choice(["PRB000", "FRB011", "NBF004"]), pick.choice([0, 20, 45, 80, 150, 200]),
                             pick.choice(["S04", "S05", "S06"]), float(pick.randint(1, 9))))
    frame = spark.createDataFrame(rows, "account_key long, act_reported_dt date, lender_id string, derived_dpd int, das string, balance double")
    return rows, frame.select(
        "*", F.col("balance").cast("decimal(18,2)").alias("current_balance"), F.lit("T").alias("ind"), F.lit("Y").alias("not_closed_ind"))


@pytest.mark.parametrize("lags", ((12,), (1, 6, 12)))
def test_rolls_equal_loops(spark, lags):
    rows, frame = _card_rows(spark, range(0, 30))
    run = dataclasses.replace(p, roll_months=(3, 6, 9, 12))
    got = Counter()
    for r in cards.roll_pairs(frame, run, lags).collect():
        got[(r.lag, r.reported_dt_from, r.lender_id, r.dpd_from, r.dpd_to, float(r.balance_from), float(r.balance_to))] += 1
    band = {r.d: r.b for r in spark.createDataFrame([(d,) for d in (0, 20, 45, 80, 150)], "d int").select(
        "d", B.bucket(F.col("d"), B.DPD_FLOW5).alias("b")).collect()}
    live = {(c, day): (lender, dpd, bal) for c, day, lender, dpd, das, bal in rows if das in ("S04", "S05") and dpd <= 180}
    want = Counter()
    for (card, day), (lender, dpd, balance) in live.items():
        for lag in lags:
            later = live.get((card, shift_months(day, lag)))
            if later and day.month in run.roll_months:
                want[(lag, day, lender, band[dpd], band[later[1]], balance, later[2])] += 1
    assert got == want and sum(want.values()) > 300
    cells = cards.roll_rates(frame, run, lags).collect()
    assert max(c.active_cards for c in cells) > 20
    of_day = defaultdict(int)
    for c in cells:
        if c.new_dpd_from == "No Due":
            of_day[(c.lag, c.reported_dt_from, c.peer_group)] = max(of_day[(c.lag, c.reported_dt_from, c.peer_group)], c.total_dpd)
    assert len(of_day) > 6


def test_rolls_meet_without_a_join(spark):
    _, frame = _card_rows(spark, range(0, 14))
    plan = cards.roll_pairs(frame, p, (3, 6, 12))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") <= 1


def test_flows_of_hundreds_of_loans_equal_loops(spark):
    pick = random.Random(6)
    lapses = (1, 6, 12)
    ends = [p.as_of, *[shift_months(p.as_of, n) for n in lapses]]
    rows = [
        (loan, end, "A01", "PRB000", pick.choice(["X", None]), date(1999, 1, 31), 17, 100.0, pick.choice([0, 20, 45, 80, 150, 400]),
         pick.choice(["S04", "S05", "S06", "S13"]), float(pick.randint(1, 9)), pick.choice([None, 5.0]), pick.choice("YYYN"))
        for loan in range(900) for end in ends if pick.random() < 0.8
    ]
    base = spark.createDataFrame(rows, "account_key long, act_reported_dt date, account_type string, lender_id string, state string, disbursed_dt date, "
                                 "mob int, sanctioned_amount double, derived_dpd int, das string, current_balance double, chargeoff_amt double, not_closed_ind string")
    got = {(r.account_key, r.lapse): (r.time_lapsed, r.dpd_lbop, r.dpd_tl, r.balance_tl, r.chargeoff_tl) for r in flow.transitions(base.repartition(5), p, lapses).collect()}
    band = {r.d: r.b for r in spark.createDataFrame([(d,) for d in (0, 20, 45, 80, 150, 400)], "d int").select("d", B.bucket(F.col("d"), B.DPD_FLOW9).alias("b")).collect()}
    state = {(r[0], r[1]): (band[r[8]] if r[12] == "Y" and r[9] in ("S04", "S05") else None, r[9], r[10], r[11]) for r in rows}
    want = {}
    for (loan, end), (seen, *_) in state.items():
        for lapse in lapses:
            then = state.get((loan, shift_months(p.as_of, lapse)))
            if end == p.as_of and then:
                late = then[0] or ("Written Off" if then[1] in ("S06", "S13") else None)
                want[(loan, lapse)] = (shift_months(p.as_of, lapse), seen, late, then[2], then[3])
    assert got == want and len(want) > 1500


def test_members_add_up(spark, tmp_path):
    pick = random.Random(2)
    rows = [(pick.choice("xyz"), pick.randint(1, 3), pick.choice([None, *range(300)]), f"c{pick.randint(0, 90)}") for _ in range(3000)]
    frame = spark.createDataFrame(rows, "place string, month int, consumer long, card string").repartition(5)
    numbers = {
        "consumers": ("consumer", members.numbered(frame, "consumer", str(tmp_path / "consumer"))),
        "cards": ("card", members.numbered(frame, "card", str(tmp_path / "card"))),
    }
    parts = [members.members(frame.where(F.col("month") == m), ["place", "month"], numbers) for m in (1, 2, 3)]
    stored = parts[0].unionByName(parts[1]).unionByName(parts[2])
    for by in (["place"], ["month"], ["place", "month"]):
        got = {tuple(r[c] for c in by): (r.consumers, r.cards) for r in members.counted(stored, by, ["consumers", "cards"]).collect()}
        sets = defaultdict(lambda: (set(), set()))
        for place, month, consumer, card in rows:
            key = tuple({"place": place, "month": month}[c] for c in by)
            sets[key][0].add(consumer), sets[key][1].add(card)
        assert got == {k: (len(a - {None}), len(b)) for k, (a, b) in sets.items()}
    assert members.counted(stored, [], ["consumers"]).first().consumers == len({r[2] for r in rows} - {None})
    assert members.counted(stored.where("false"), ["place"], ["cards"]).collect() == []


def test_members_count_a_consumer_of_many_groups_once(spark, small):
    book = Book(spark, small)
    facts = QUERIES["members_by_place"](book, p)
    step2 = QUERIES["mfi_step2"](book, p).join(book.geo_dim().select("sdp_key", "rev_state", "rev_district"), "sdp_key")
    earlier = QUERIES["mfi_step2"](book, dataclasses.replace(p, as_of=date(2000, 5, 31))).join(
        book.geo_dim().select("sdp_key", "rev_state", "rev_district"), "sdp_key")
    want = step2.unionByName(earlier).groupBy("rev_state", "rev_district").agg(
        F.count_distinct("consumer_key").alias("consumers"), F.count_distinct("account_key").alias("accounts"),
        F.count_distinct("clst_id").alias("clusters"))
    assert rows_of(facts) == rows_of(want)
    per_lender = step2.groupBy("rev_state", "rev_district", "contri_key").agg(F.count_distinct("consumer_key").alias("n"))
    assert per_lender.agg(F.sum("n")).first()[0] > facts.agg(F.sum("consumers")).first()[0]
