"""Run parameters and the fixed code lists of the loan-book domain."""

from __future__ import annotations

import calendar
from dataclasses import dataclass, field
from datetime import date

# --- fixed values: account status codes -------------------------------------
ACTIVE_PORTFOLIO = ("S04", "S05", "S20", "S25", "S18")
ACTIVE_BOOK = ("S04", "S05", "S11", "S12", "S16", "S18", "S20")
ACTIVE_STRICT = ("S04", "S05")
WRITTEN_OFF = ("S06", "S13")
NOT_REPORTED = ("S01", "S02", "S03")

# --- fixed values: product lists ---------------------------------------------
CARD_TYPE = "A15"
CONSUMER_LOAN_TYPE = "A13"
VINTAGE_TYPES = ("A06", "A12", "A01", "A07", "A04", "A33", "A14", "A22", "A23", "A27", "A31", "A42")
SECURED_PROFILE = (
    "A01", "A04", "A09", "A08", "A07", "A06", "A20", "A31", "A67", "A03", "A41", "A10", "A61", "A05", "A42", "A11",
)
UNSECURED_PROFILE = (
    "A62", "A19", "A24", "A25", "A28", "A12", "A22", "A26", "A14", "A15", "A13", "A63", "A29", "A27", "A40", "A37",
)
SECURED_DASHBOARD = (
    "A01", "A04", "A09", "A08", "A07", "A24", "A06", "A25", "A20", "A13", "A31", "A67", "A03", "A41", "A61", "A05",
    "A42", "A11",
)
UNSECURED_DASHBOARD = ("A15", "A62", "A19", "A28", "A12", "A22", "A63", "A29", "A27")

# --- fixed values: lender id prefixes ----------------------------------------
NON_BANK_PREFIXES = ("ARC", "CCC", "NBF", "HFC")
PSU_PREFIXES = ("SBI", "NAB")
NBFC_PREFIXES = ("HFC", "NBF")
PRIVATE_PREFIXES = ("PRB",)

GroupList = tuple[tuple[str, tuple[str, ...]], ...]


def month_end(d: date) -> date:
    return d.replace(day=calendar.monthrange(d.year, d.month)[1])


def shift_months(d: date, n: int) -> date:
    """Month shift in which a month end stays a month end."""
    total = d.year * 12 + d.month - 1 + n
    year, month = divmod(total, 12)
    last = calendar.monthrange(year, month + 1)[1]
    day = last if d == month_end(d) else min(d.day, last)
    return date(year, month + 1, day)


# Amounts from this magnitude on are not reported: no ledger field holds them.
LARGEST_AMOUNT = 10**11


@dataclass(frozen=True)
class RunParams:
    """Dates and lender choices of one run; defaults fit the test tables."""

    as_of: date = date(2000, 6, 30)
    report_cut: date = date(2000, 8, 8)
    self_lender: str = "NBF004"
    group_lender: str = "PRB003"
    group_category: str = "T04"
    vintage_disbursed_from: date = date(1996, 4, 1)
    vintage_reported_from: date = date(1998, 4, 1)
    look_back_months: int = 24
    time_lapse_months: int = 12
    flow_lapses: tuple[int, ...] = (6, 12)
    flow_account_types: tuple[str, ...] = ("A01", "A06", "A07", "A12", "A13", "A15", "A22")
    card_types: tuple[str, ...] = (CARD_TYPE,)
    roll_back_months: int = 60
    roll_months: tuple[int, ...] = (3, 6, 9, 12)
    low_balance: int = 1000
    calendar: tuple[date, date] = (date(1990, 1, 1), date(2039, 12, 1))
    entry_years: tuple[int, ...] = (1998, 1999, 2000)
    largest_amount: int = LARGEST_AMOUNT
    top_cities: int = 50
    period_cutoff: date = date(1998, 4, 30)
    old_disbursal_yyyymm: int = 199603
    old_disbursal_label: str = "UPTO FY 1995-1996"
    excluded_lender_keys: tuple[int, ...] = (9,)
    dashboard_dates: tuple[date, ...] = (date(2000, 5, 31), date(2000, 6, 30))
    card_lender: str = "PRB000"
    card_groups: GroupList = (
        ("FRBs", ("CCC009", "FRB011")),
        ("PRBs", ("PRB000", "PRB001", "PRB002", "PRB003")),
    )
    card_group_default: str = "PSBs+OTH"
    ranked_lenders: tuple[str, ...] = ("CCC009", "FRB011", "PRB000", "PRB001", "PRB002", "PRB003")
    vintage_group_1: GroupList = (("P1 GROUP", ("PRB000", "PRB001", "NBF005", "FRB011")),)
    vintage_group_2: GroupList = (("P2 GROUP", ("PRB001", "PRB002", "PRB003", "HFC007", "NBF006")),)
    geo_groups_1: GroupList = (
        ("SELF", ("NBF004",)),
        ("Peer Group 1", ("PRB000", "NBF005")),
        ("Peer Group 2", ("PRB001", "HFC007")),
        ("Peer Group 3", ("PRB002", "SBI010")),
        ("Peer Group 4", ("NBF004", "FRB011")),
    )
    geo_groups_2: GroupList = (
        ("SELF", ("NBF004",)),
        ("SFBs", ("NBF005", "PRB000")),
        ("NBFC MFI", ("NBF006", "HFC007", "PRB000")),
    )
    wallet_lenders: tuple[str, ...] = field(
        default=("CCC009", "FRB011", "PRB000", "PRB001", "PRB002", "PRB003", "NBF004", "SBI010"),
    )

    @property
    def look_back_start(self) -> date:
        return shift_months(self.as_of, -self.look_back_months)

    @property
    def quarter_ends(self) -> tuple[date, ...]:
        """Every third month end from the start of the look-back to as_of."""
        steps = range(0, self.look_back_months + 1, 3)
        return tuple(shift_months(self.look_back_start, n) for n in steps)


DEFAULT_PARAMS = RunParams()
