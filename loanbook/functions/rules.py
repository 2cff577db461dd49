"""Row rules: Column -> Column expressions, all JVM-side."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from loanbook import params as P
from loanbook.functions.buckets import ONE_PERCENT

DateLike = Column | date


def _col(value: DateLike | str | int | None) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def map_codes(col: Column, mapping: dict[str, str]) -> Column:
    """Value of `mapping` for the code in `col`, NULL where it has none."""
    arms = None
    for code, value in mapping.items():
        arms = F.when(col == code, F.lit(value)) if arms is None else arms.when(col == code, F.lit(value))
    return arms


# --- dates ---------------------------------------------------------------------
def shift_month(d: Column, n: int) -> Column:
    """Month shift in which a month end stays a month end."""
    moved = F.add_months(d, n)
    return F.when(d == F.last_day(d), F.last_day(moved)).otherwise(moved)


def yyyymm(d: Column) -> Column:
    return (F.year(d) * 100 + F.month(d)).cast("int")


def yyyymm_of(d: date) -> int:
    return d.year * 100 + d.month


def months_on_book(later: DateLike, earlier: DateLike, plus: int = 0) -> Column:
    """Whole months between two month ends; `plus=1` is the vintage variant."""
    a, b = F.last_day(_col(later)), F.last_day(_col(earlier))
    return ((F.year(a) - F.year(b)) * 12 + F.month(a) - F.month(b) + F.lit(plus)).cast("int")


def age_at(as_of: DateLike, birth: Column) -> Column:
    """Completed years at `as_of`."""
    return F.floor(F.months_between(_col(as_of), birth) / 12).cast("int")


def age_at_reported(as_of: DateLike, birth: Column, age: Column, age_as_on: Column) -> Column:
    """Fractional age: from the birth date, else from a stated age and its date."""
    day = _col(as_of)
    return F.coalesce(F.months_between(day, birth) / 12, F.months_between(day, age_as_on) / 12 + age)


# --- delinquency -----------------------------------------------------------------
def raw_dpd(text: Column) -> Column:
    """First run of digits as int; NULL where there is none."""
    return F.regexp_extract(text, "[0-9]+", 0).try_cast("int")


def clean_digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


# fixed values: retail asset class -> days past due
RETAIL_CLASS_DPD = {"L01": 0, "L02": 91, "L03": 361, "L04": 361, "L05": 1}
# fixed values: commercial asset class -> days past due
COMMERCIAL_CLASS_DPD = {
    "001": 0, "005": 31, "006": 31, "007": 31, "008": 31, "002": 91, "012": 91,
    "003": 361, "004": 361, "009": 361, "010": 361, "011": 361,
}


def _status_dpd(das: Column) -> Column:
    return F.when(das == "S05", F.lit(1)).otherwise(F.lit(0))


def _four_arms(text: Column, asset_class: Column, digits: Column, lone: Column, paired: Column, das: Column) -> Column:
    """Shared shape of the DPD rules over {text given?} x {class given?}."""
    has_text, has_class = text.isNotNull(), asset_class.isNotNull()
    return (
        F.when(has_text & ~has_class, digits)
        .when(has_text & has_class, F.greatest(digits, F.coalesce(paired, F.lit(0))))
        .when(has_class, lone)
        .otherwise(_status_dpd(das))
        .cast("int")
    )


def derived_dpd(days_past_due: Column, asset_class: Column, das: Column) -> Column:
    """Days past due of a retail account from its text field, class and status.

    Text without digits counts as given with value 0; an unknown class alone
    gives NULL.
    """
    cls = F.trim(asset_class)
    mapped = map_codes(cls, RETAIL_CLASS_DPD)
    return _four_arms(days_past_due, cls, F.coalesce(raw_dpd(days_past_due), F.lit(0)), mapped, mapped, das)


def derived_dpd_commercial(dpd: Column, asset_class: Column, das: Column) -> Column:
    """Days past due of a commercial account; classes are normalised first.

    Corrected: classes 010 and 011 mean 361 days (they were missed because the
    test ran on codes that normalising had already rewritten).
    """
    cls, text = F.trim(asset_class), F.trim(dpd)
    mapped = map_codes(cls, COMMERCIAL_CLASS_DPD)
    digits = F.when(text.isin("XXX", "DDD"), F.lit(0)).otherwise(F.coalesce(text.try_cast("int"), F.lit(0)))
    return _four_arms(text, cls, digits, mapped, F.coalesce(mapped, cls.try_cast("int")), das)


def norm_asset_class(asset_class: Column) -> Column:
    """Three-digit commercial class: L01 and 000n spellings fold to 00n."""
    cls = F.trim(asset_class)
    return F.when(cls == "L01", F.lit("001")).when(
        cls.rlike("^00(0[1-9]|1[0-2])$"), F.substring(cls, 2, 3)
    ).otherwise(cls)


# --- repayment frequency ------------------------------------------------------
KNOWN_FREQS = ("F01", "F02", "F03", "F04", "F05", "F06", "F07", "F08", "F10")


def norm_instal_freq(freq: Column) -> Column:
    """Fold the spellings 1, 01 and FO1 (letter O) into F01, and so on."""
    arms = F.when(freq.isNull(), F.lit("BLANK"))
    for n in range(1, 9):
        arms = arms.when(freq.isin(str(n), f"0{n}", f"FO{n}"), F.lit(f"F0{n}"))
    return (
        arms.when(freq.isin("9", "F09", "10"), F.lit("F10"))
        .when(~freq.isin(*KNOWN_FREQS), F.lit("NA"))
        .otherwise(F.upper(freq))
    )


def freq_or_na(freq: Column) -> Column:
    up = F.upper(freq)
    return F.when(~up.isin(*KNOWN_FREQS), F.lit("NA")).otherwise(up)


# fixed values: instalments per month of each frequency, as (times, over)
MONTHS_PER_INSTALMENT = {
    "F01": (1, 4), "F02": (1, 2), "F03": (1, 1), "F04": (2, 1), "F05": (4, 1), "F06": (20, 3), "F07": (25, 2),
}


def tenure_months(instalments: Column, freq: Column, mode: str = "round") -> Column:
    """Loan length in months from its number of instalments."""
    arms = None
    for code, (times, over) in MONTHS_PER_INSTALMENT.items():
        scaled = instalments.cast("int") * times
        # integer arithmetic keeps halves exact: round(a/b) = floor((2a+b)/2b)
        value = F.floor((scaled * 2 + over) / (2 * over)) if mode == "round" else F.floor(scaled / over)
        test = freq == code
        arms = F.when(test, value) if arms is None else arms.when(test, value)
    return arms.cast("int")


# --- addresses ---------------------------------------------------------------
def sdp_rank(state: Column, district: Column, pin: Column) -> Column:
    """Address completeness 1 (all three parts) to 5."""
    s, d, p = state.isNotNull(), district.isNotNull(), pin.isNotNull()
    return (
        F.when(s & d & p, 1).when(s & d, 2).when(s & p, 3).when(d & p, 4).otherwise(5)
    )


def sdpcl_rank(state: Column, district: Column, pin: Column, city: Column, locality: Column) -> Column:
    """Completeness over five parts: 1 for all, 2..6 for one named gap, else 7."""
    parts = [locality, city, pin, district, state]
    arms = F.when(F.greatest(*[c.isNull() for c in parts]) == F.lit(False), F.lit(1))
    for rank, gap in enumerate(parts, start=2):
        others = [c.isNotNull() for c in parts if c is not gap]
        arms = arms.when(gap.isNull() & F.least(*others), F.lit(rank))
    return arms.otherwise(F.lit(7))


def ownership_flag(ownership: Column) -> Column:
    return F.coalesce(F.substring(ownership, 3, 1), F.lit("9"))


# --- amounts -------------------------------------------------------------------
def loan_amount(high_credit: Column, disbursed: Column, limit: Column) -> Column:
    return F.abs(F.coalesce(high_credit, disbursed, limit))


def exposure_amount(balance: Column, *amounts: Column) -> Column:
    """Loan amount, never below the outstanding balance."""
    return F.greatest(F.abs(F.coalesce(*amounts, balance)), F.abs(balance))


def zero_if_null(col: Column) -> Column:
    return F.coalesce(col, F.lit(0))


def _over_one_percent(overdue: Column, amount: Column) -> Column:
    return zero_if_null(overdue) > F.lit(ONE_PERCENT) * zero_if_null(amount)


def storable(amount: Column, largest: int = P.LARGEST_AMOUNT) -> Column:
    """False for magnitudes no ledger field can hold, a rule of the fact report; NULL passes."""
    return F.coalesce(F.abs(amount) < F.lit(largest), F.lit(True))


# --- status ---------------------------------------------------------------------
def open_at(closed: Column, day: DateLike) -> Column:
    return closed.isNull() | (closed > _col(day))


def not_closed(closed: Column, day: DateLike) -> Column:
    return F.when(open_at(closed, day), F.lit("Y")).otherwise(F.lit("N"))


def is_active(closed: Column, das: Column, day: DateLike, statuses=P.ACTIVE_PORTFOLIO) -> Column:
    return F.coalesce(open_at(closed, day) & das.isin(*statuses), F.lit(False))


def closed_ind_noc(closed: Column, das: Column, end: DateLike) -> Column:
    """N for open loans; a later closing date counts only under an active status."""
    still_open = closed.isNull() | ((closed > _col(end)) & das.isin(*P.ACTIVE_BOOK))
    return F.when(still_open, F.lit("N")).otherwise(F.lit("Y"))


def overdue_ind(dpd: Column, overdue: Column, amount: Column) -> Column:
    over = _over_one_percent(F.abs(overdue), amount)
    return F.when((dpd > 0) | over, F.lit(1)).when((zero_if_null(dpd) == 0) & ~over, F.lit(0))


def not_stipulated(dpd: Column, overdue: Column, amount: Column) -> Column:
    """NS = no days past due yet more than one percent overdue, else current."""
    zero = zero_if_null(dpd) == 0
    over = _over_one_percent(F.abs(overdue), amount)
    return F.when(zero & over, F.lit("NS")).when(zero & ~over, F.lit("current"))


def mfi_status(
    chargeoff: Column, closed: Column, as_of: DateLike, dpd: Column, overdue: Column, amount: Column, status: Column
) -> Column:
    return (
        F.when(zero_if_null(chargeoff) > 0, F.lit("S06"))
        .when(closed <= _col(as_of), F.lit("S07"))
        .when(dpd > 0, F.lit("S05"))
        .when(_over_one_percent(overdue, amount), F.lit("S05"))
        .otherwise(status)
    )


def active_lender(status: Column, closed: Column, as_of: DateLike, lender: Column) -> Column:
    return F.when(status.isin(*P.ACTIVE_STRICT) & open_at(closed, as_of), lender)


def loan_state(closed: Column, as_of: DateLike, das: Column) -> Column:
    day = _col(as_of)
    half_year_ago = shift_month(day, -6)
    return (
        F.when(closed.between(half_year_ago, day), F.lit("CLOSED WITHIN 6 MONTHS"))
        .when(closed < half_year_ago, F.lit("CLOSED BEFORE 6 MONTHS"))
        .when(open_at(closed, day) & das.isin(*P.ACTIVE_STRICT), F.lit("ACTIVE"))
        .when(das.isin("S06", "S07"), F.lit("CLOSED"))
        .otherwise(F.lit("NA"))
    )


# fixed values: loan state labels in key order
LOAN_STATES = ("ACTIVE", "CLOSED WITHIN 6 MONTHS", "CLOSED BEFORE 6 MONTHS", "CLOSED", "NA")


# --- lenders and products ---------------------------------------------------------
def _prefix_in(lender: Column, prefixes) -> Column:
    return F.substring(lender, 1, 3).isin(*prefixes)


def lender_type(lender: Column, self_lender: str | None = None) -> Column:
    kind = F.when(_prefix_in(lender, P.NON_BANK_PREFIXES), F.lit("Non Banks")).otherwise(F.lit("Banks"))
    return kind if self_lender is None else F.when(lender == self_lender, F.lit("Self")).otherwise(kind)


def lender_class(lender: Column, self_lender: str) -> Column:
    return (
        F.when(lender == self_lender, F.lit("Self"))
        .when(_prefix_in(lender, P.PSU_PREFIXES), F.lit("PSUs"))
        .when(_prefix_in(lender, P.NBFC_PREFIXES), F.lit("NBFCs"))
        .when(_prefix_in(lender, P.PRIVATE_PREFIXES), F.lit("PVT"))
        .otherwise(F.lit("Others"))
    )


def peer_group(lender: Column, groups: P.GroupList, default: str, self_lender: str | None = None) -> Column:
    """First group of the ordered list that names the lender."""
    arms = None if self_lender is None else F.when(lender == self_lender, F.lit("SELF"))
    for name, members in groups:
        test = lender.isin(*members)
        arms = F.when(test, F.lit(name)) if arms is None else arms.when(test, F.lit(name))
    return F.lit(default) if arms is None else arms.otherwise(F.lit(default))


def product_class(account_type: Column, variant: str = "profile") -> Column:
    secured, unsecured = {
        "profile": (P.SECURED_PROFILE, P.UNSECURED_PROFILE),
        "dashboard": (P.SECURED_DASHBOARD, P.UNSECURED_DASHBOARD),
    }[variant]
    return (
        F.when(account_type.isin(*secured), F.lit("Secured"))
        .when(account_type.isin(*unsecured), F.lit("Unsecured"))
        .otherwise(F.lit("Others"))
    )


# fixed values: product categories
RETAIL_CATEGORIES = {
    "HL": ("A06",), "PL": ("A12",), "AL": ("A01",), "LAP": ("A07",), "CV": ("A04", "A33"),
    "BL": ("A14", "A22", "A23", "A27", "A31", "A42"),
}
COMMERCIAL_CATEGORIES = {
    "LAP": ("9002",), "CV": ("4000",), "WC": ("0200", "0310"), "TL": ("0420", "0410", "5100", "5000"),
}


def product_category(code: Column, book: str = "retail") -> Column:
    """Retail codes outside the list keep their own name; commercial ones are OTHERS."""
    table, default = (
        (RETAIL_CATEGORIES, code) if book == "retail" else (COMMERCIAL_CATEGORIES, F.lit("OTHERS"))
    )
    arms = None
    for name, codes in table.items():
        test = code.isin(*codes)
        arms = F.when(test, F.lit(name)) if arms is None else arms.when(test, F.lit(name))
    return arms.otherwise(default)


# fixed values: text codes
PURPOSE_CODES = {
    "OTHERS": "OTHERS", "INCOME": "INCOME", "EDUCATION": "EDU", "HOUSING": "HOUSE", "AUTOMOBILE": "AUTOMOBILE",
    "REAL ESTATE": "REALESTATE", "NA": "NA",
}
OCCUPATION_CODES = {
    "OTHERS": "OTHERS", "AGRICULTURE AND ALLIED": "AGRI", "CONTRACT EMPLOYEE": "CONTRACT_EMP",
    "SELF EMPLOYED": "SELF_EMP", "EMPLOYED": "EMP", "NULL": "BLANK",
}
SUPPRESS_CODES = {"Y": "1", "N": "0"}


def purpose_code(text: Column) -> Column:
    return F.coalesce(map_codes(F.upper(text), PURPOSE_CODES), F.lit("INVALID"))


def occupation_code(text: Column) -> Column:
    return F.coalesce(map_codes(F.upper(text), OCCUPATION_CODES), F.lit("NA"))


def suppress_code(text: Column) -> Column:
    return F.when(text.isNull(), F.lit("BLANK")).otherwise(
        F.coalesce(map_codes(F.upper(text), SUPPRESS_CODES), F.lit("NA"))
    )


# --- income and ratios ----------------------------------------------------------
def income_final(annual: Column, annual_rank: Column, monthly: Column, monthly_rank: Column) -> Column:
    """Annual income of the cluster's top row, else twelve times its monthly one."""
    return F.coalesce(F.when(annual_rank == 1, annual), F.when(monthly_rank == 1, monthly * 12))


def ratio(a: Column, b: Column, times: int = 1, places: int = 2) -> Column:
    """round(a / b * times, places); NULL on a zero denominator."""
    quotient = F.try_divide(a.cast("double"), b.cast("double")) * times
    return F.round(quotient.cast("decimal(38,8)"), places).cast("double")


def _one_if_zero(col: Column) -> Column:
    return F.when(col == 0, F.lit(1)).otherwise(col)


def debt_ratios(min_due: Column, income: Column, balance: Column, active_loans: Column) -> dict[str, Column]:
    """Yearly minimum due and balance against income.

    An income smaller than a year of minimum dues is taken as monthly.
    """
    first = ratio(min_due * 12, _one_if_zero(income))
    income_new = F.when(first > 1, income * 12).otherwise(income)
    live = active_loans > 0
    base = _one_if_zero(F.when(live, income_new).otherwise(F.lit(0)))
    due = F.when(live, min_due * 12).otherwise(F.lit(0))
    return {
        "debt_income_ratio": first,
        "annual_income_new": income_new,
        "min_due_annual": min_due * 12,
        "min_due_ratio": ratio(min_due, _one_if_zero(income)),
        "debt_to_income_final": ratio(due, base, 100),
        "portfolio_to_income": ratio(balance, base, 100),
        "debt_to_income_active": ratio(due, base, 100),
    }


def min_due_calc(amount: Column, instalments: Column) -> Column:
    """Amount per instalment, with none or zero instalments taken as one."""
    count = F.when(zero_if_null(instalments) == 0, F.lit(1)).otherwise(instalments)
    return F.round((F.abs(amount).cast("double") / count).cast("decimal(38,8)"), 2).cast("decimal(18,2)")


def min_due_both(min_due: Column, amount: Column, instalments: Column) -> Column:
    return F.coalesce(min_due, min_due_calc(amount, instalments))


def pct_change(before: Column, after: Column) -> Column:
    """Percent change; 0 where a side is missing, NULL where it starts at zero."""
    return F.when(before.isNull() | after.isNull(), F.lit(0.0)).otherwise(ratio(after - before, before, 100))


def diff(before: Column, after: Column) -> Column:
    return zero_if_null(after) - zero_if_null(before)
