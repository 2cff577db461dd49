"""Row rules, one row per arm."""

from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from loanbook import params as P
from loanbook.functions import rules as R


def value(spark, build, schema, *row):
    df = spark.createDataFrame([row], schema)
    return df.select(build(*[F.col(c) for c in df.columns]).alias("x")).first().x


@pytest.mark.parametrize("text, cls, das, expected", [
    ("45", None, "S04", 45), ("DPD 7x9", None, "S04", 7), ("", None, "S05", 0), ("XXX", None, "S05", 0),
    (None, "L01", "S05", 0), (None, "L02", "S04", 91), (None, " L03 ", "S04", 361), (None, "L04", "S04", 361),
    (None, "L05", "S04", 1), (None, "L99", "S04", None), ("100", "L02", "S04", 100), ("10", "L02", "S04", 91),
    ("10", "L99", "S04", 10), ("", "L05", "S04", 1), (None, None, "S04", 0), (None, None, "S05", 1),
    (None, None, "S07", 0), ("99999999999999", None, "S04", 0),
])
def test_derived_dpd(spark, text, cls, das, expected):
    assert value(spark, R.derived_dpd, "t string, c string, d string", text, cls, das) == expected


@pytest.mark.parametrize("dpd, cls, das, expected", [
    ("XXX", None, "S04", 0), ("DDD", "002", "S04", 91), ("200", "002", "S04", 200), ("30", "005", "S04", 31),
    ("0", "010", "S04", 361), ("0", "011", "S04", 361), ("5", "013", "S04", 13), (None, "012", "S04", 91),
    (None, "013", "S04", None), (None, None, "S05", 1), (None, None, "S04", 0), ("12", None, "S04", 12),
])
def test_derived_dpd_commercial(spark, dpd, cls, das, expected):
    assert value(spark, R.derived_dpd_commercial, "t string, c string, d string", dpd, cls, das) == expected


@pytest.mark.parametrize("code, expected", [
    ("L01", "001"), ("0001", "001"), ("001", "001"), (" 0010 ", "010"), ("0012", "012"), ("0013", "0013"),
    ("X", "X"), (None, None),
])
def test_norm_asset_class(spark, code, expected):
    assert value(spark, R.norm_asset_class, "c string", code) == expected


@pytest.mark.parametrize("freq, expected", [
    ("1", "F01"), ("08", "F08"), ("FO3", "F03"), ("9", "F10"), ("F09", "F10"), ("10", "F10"), (None, "BLANK"),
    ("f03", "NA"), ("ZZ", "NA"), ("F07", "F07"),
])
def test_norm_instal_freq(spark, freq, expected):
    assert value(spark, R.norm_instal_freq, "c string", freq) == expected


@pytest.mark.parametrize("n, freq, rounded, floored", [
    (2, "F01", 1, 0), (7, "F02", 4, 3), (5, "F03", 5, 5), (5, "F04", 10, 10), (3, "F05", 12, 12), (1, "F06", 7, 6),
    (3, "F07", 38, 37), (3, "F08", None, None), (None, "F01", None, None),
])
def test_tenure_months(spark, n, freq, rounded, floored):
    schema = "n int, f string"
    assert value(spark, R.tenure_months, schema, n, freq) == rounded
    assert value(spark, lambda a, b: R.tenure_months(a, b, "floor"), schema, n, freq) == floored


@pytest.mark.parametrize("code, expected", [("O04", "4"), ("OAB", "B"), ("O", ""), (None, "9")])
def test_ownership_flag(spark, code, expected):
    assert value(spark, R.ownership_flag, "c string", code) == expected


@pytest.mark.parametrize("start, months, expected", [
    (date(2019, 1, 31), 1, date(2019, 2, 28)), (date(2019, 2, 28), 12, date(2020, 2, 29)),
    (date(2020, 2, 29), 3, date(2020, 5, 31)), (date(2019, 4, 30), 3, date(2019, 7, 31)),
    (date(2019, 4, 15), 1, date(2019, 5, 15)), (date(2019, 1, 30), 1, date(2019, 2, 28)),
])
def test_shift_month_keeps_month_ends(spark, start, months, expected):
    assert value(spark, lambda d: R.shift_month(d, months), "d date", start) == expected
    assert P.shift_months(start, months) == expected


def test_sdpcl_rank(spark):
    full = ["s", "d", "p", "c", "l"]
    schema = "s string, d string, p string, c string, l string"
    assert value(spark, R.sdpcl_rank, schema, *full) == 1
    for gap, rank in ((4, 2), (3, 3), (2, 4), (1, 5), (0, 6)):
        row = [None if i == gap else v for i, v in enumerate(full)]
        assert value(spark, R.sdpcl_rank, schema, *row) == rank
    assert value(spark, R.sdpcl_rank, schema, None, None, "p", "c", "l") == 7


@pytest.mark.parametrize("lender, expected", [("NBF004", "SELF"), ("PRB000", "A"), ("SBI010", "B"), ("ZZZ", "REST")])
def test_peer_group_first_match_wins(spark, lender, expected):
    groups = (("A", ("PRB000", "NBF004")), ("B", ("PRB000", "SBI010")))
    assert value(spark, lambda c: R.peer_group(c, groups, "REST", "NBF004"), "l string", lender) == expected


def test_closed_flag_binds_status_to_later_closings(spark):
    end = date(2000, 6, 30)
    rule = lambda c, d: R.closed_ind_noc(c, d, end)
    assert value(spark, rule, "c date, d string", None, "S07") == "N"
    assert value(spark, rule, "c date, d string", date(2001, 1, 1), "S04") == "N"
    assert value(spark, rule, "c date, d string", date(2001, 1, 1), "S07") == "Y"
    assert value(spark, rule, "c date, d string", date(2000, 6, 30), "S04") == "Y"


def test_ratios_survive_zero_and_missing(spark):
    schema = "a decimal(18,2), b decimal(18,2)"
    assert value(spark, R.ratio, schema, D("1.00"), D("0.00")) is None
    assert value(spark, R.ratio, schema, D("1.00"), None) is None
    assert value(spark, R.pct_change, schema, None, D("5.00")) == 0
    assert value(spark, R.pct_change, schema, D("0.00"), D("5.00")) is None
    assert value(spark, R.pct_change, schema, D("80.00"), D("100.00")) == 25.0
    calc = lambda a: R.min_due_calc(a, F.lit(0))
    assert value(spark, calc, "a decimal(18,2)", D("-7.50")) == D("7.50")


def test_income_of_less_than_a_year_of_dues_is_monthly(spark):
    schema = "due decimal(18,2), income decimal(18,2), balance decimal(18,2), n int"
    ratios = lambda name: lambda *c: R.debt_ratios(*c)[name]
    row = (D("100.00"), D("600.00"), D("3600.00"), 1)
    assert value(spark, ratios("debt_income_ratio"), schema, *row) == 2.0
    assert value(spark, ratios("annual_income_new"), schema, *row) == D("7200.00")
    assert value(spark, ratios("portfolio_to_income"), schema, *row) == 50.0
    idle = row[:3] + (0,)
    assert value(spark, ratios("debt_to_income_final"), schema, *idle) == 0.0


def test_storable_limit(spark):
    assert value(spark, R.storable, "a decimal(18,2)", D("99999999999.99")) is True
    assert value(spark, R.storable, "a decimal(18,2)", D("100000000000.00")) is False
    assert value(spark, R.storable, "a decimal(18,2)", None) is True
