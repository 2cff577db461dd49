"""Oracle SQL of the row rules, each over all accounts or all consumers."""

from __future__ import annotations

from oracle.base import AS_OF, BOOK, PORTFOLIO, SELF, mob, months_between, ratio, shift

_CLS = "trim(asset_class)"
_RAW = "TRY_CAST(regexp_extract(days_past_due, '[0-9]+') AS INTEGER)"
_CLASS_DPD = f"CASE {_CLS} WHEN 'L01' THEN 0 WHEN 'L02' THEN 91 WHEN 'L03' THEN 361 WHEN 'L04' THEN 361 WHEN 'L05' THEN 1 END"
# Both sources known or not, the worse counts; without either only the status speaks.
DERIVED_DPD = f"""CAST(CASE
  WHEN days_past_due IS NOT NULL THEN greatest(coalesce({_RAW}, 0), coalesce({_CLASS_DPD}, 0))
  WHEN {_CLS} IS NOT NULL THEN {_CLASS_DPD}
  WHEN das = 'S05' THEN 1 ELSE 0 END AS INTEGER)"""
# fixed values: spellings of a commercial class
CLASS_SPELLINGS = (
    ("001", ("L01", "001", "0001")),
    ("002", ("002", "0002")),
    ("003", ("003", "0003")),
    ("004", ("004", "0004")),
    ("005", ("005", "0005")),
    ("006", ("006", "0006")),
    ("007", ("007", "0007")),
    ("008", ("008", "0008")),
    ("009", ("009", "0009")),
    ("010", ("010", "0010")),
    ("011", ("011", "0011")),
    ("012", ("012", "0012")),
)
NORM_CLASS = "CASE " + " ".join(
    f"WHEN trim(asset_class) IN ({', '.join(repr(x) for x in spelled)}) THEN '{code}'" for code, spelled in CLASS_SPELLINGS
) + " ELSE trim(asset_class) END"


def commercial_dpd(dpd: str, cls: str) -> str:
    mapped = (
        f"CASE WHEN {cls} = '001' THEN 0 WHEN {cls} IN ('005','006','007','008') THEN 31"
        f" WHEN {cls} IN ('002','012') THEN 91 WHEN {cls} IN ('003','004','009','010','011') THEN 361"
    )
    digits = f"coalesce(TRY_CAST(CASE WHEN trim({dpd}) IN ('XXX','DDD') THEN '0' ELSE trim({dpd}) END AS INTEGER), 0)"
    return f"""CAST(CASE WHEN {dpd} IS NOT NULL AND {cls} IS NULL THEN {digits}
  WHEN {dpd} IS NULL AND {cls} IS NOT NULL THEN {mapped} END
  WHEN {dpd} IS NOT NULL THEN greatest(coalesce({mapped} ELSE TRY_CAST({cls} AS INTEGER) END, 0), {digits})
  ELSE CASE WHEN das = 'S05' THEN 1 ELSE 0 END END AS INTEGER)"""


NORM_FREQ = "CASE " + " ".join(
    f"WHEN instal_freq IN ('{n}','0{n}','FO{n}') THEN 'F0{n}'" for n in range(1, 9)
) + """ WHEN instal_freq IN ('9','F09','10') THEN 'F10' WHEN instal_freq IS NULL THEN 'BLANK'
  WHEN instal_freq NOT IN ('F01','F02','F03','F04','F05','F06','F07','F08','F10') THEN 'NA' ELSE upper(instal_freq) END"""
FREQ_NA = """CASE WHEN upper(instal_freq) NOT IN ('F01','F02','F03','F04','F05','F06','F07','F08','F10') THEN 'NA'
  ELSE upper(instal_freq) END"""


def tenure(fn: str, freq: str = "instal_freq") -> str:
    return "CAST(CASE " + " ".join(
        f"WHEN {freq} = '{code}' THEN {fn}(num_installment / {div})"
        for code, div in (("F01", 4), ("F02", 2), ("F03", 1), ("F04", 0.5), ("F05", 0.25), ("F06", 0.15), ("F07", 0.08))
    ) + " END AS INTEGER)"


LOAN = "abs(coalesce(high_credit, disbursed_amount, credit_limit))"
EXPOSURE = "greatest(abs(coalesce(high_credit, disbursed_amount, credit_limit, current_balance)), abs(current_balance))"
DIGITS = "regexp_replace(days_past_due, '[^0-9]', '', 'g')"
DIGIT_DPD = f"TRY_CAST({DIGITS} AS INTEGER)"


def mfi_status(dpd: str, overdue: str, amount: str, as_of: str = AS_OF, status: str = "account_status",
               charge: str = "chargeoff_amt") -> str:
    late = f"{dpd} > 0 OR coalesce({overdue}, 0) > 0.01 * coalesce({amount}, 0)"
    return (f"CASE WHEN {charge} > 0 THEN 'S06' WHEN closed_dt <= {as_of} THEN 'S07' WHEN {late} THEN 'S05'"
            f" ELSE {status} END")


MFI_STATUS = mfi_status(DIGIT_DPD, "amount_overdue_total", "disbursed_amount")


def overdue(dpd: str, due: str, amount: str) -> str:
    owed = f"coalesce(abs({due}), 0) > 0.01 * coalesce({amount}, 0)"
    return f"CASE WHEN coalesce({dpd}, 0) > 0 OR {owed} THEN 1 WHEN coalesce({dpd}, 0) = 0 THEN 0 END"


def lender_class(lender: str, self_id: str = SELF) -> str:
    return f"""CASE WHEN {lender} = {self_id} THEN 'Self' WHEN substr({lender},1,3) IN ('SBI','NAB') THEN 'PSUs'
  WHEN substr({lender},1,3) IN ('HFC','NBF') THEN 'NBFCs' WHEN substr({lender},1,3) = 'PRB' THEN 'PVT' ELSE 'Others' END"""


def lender_type(lender: str) -> str:
    return f"""CASE WHEN {lender} LIKE 'ARC%' OR {lender} LIKE 'CCC%' OR {lender} LIKE 'NBF%' OR {lender} LIKE 'HFC%'
  THEN 'Non Banks' ELSE 'Banks' END"""


def groups(lender: str, table, default: str, self_id: str | None = None) -> str:
    arms = "" if self_id is None else f"WHEN {lender} = '{self_id}' THEN 'SELF' "
    arms += " ".join(
        f"WHEN {lender} IN ({', '.join(repr(m) for m in members)}) THEN '{name}'" for name, members in table
    )
    return f"CASE {arms} ELSE '{default}' END"


CARD_GROUPS = [("FRBs", ["CCC009", "FRB011"]), ("PRBs", ["PRB000", "PRB001", "PRB002", "PRB003"])]


# fixed values: account types of each class
PRODUCT_CLASSES = {
    "profile": (
        ("A01", "A04", "A09", "A08", "A07", "A06", "A20", "A31", "A67", "A03", "A41", "A10", "A61", "A05", "A42", "A11"),
        ("A62", "A19", "A24", "A25", "A28", "A12", "A22", "A26", "A14", "A15", "A13", "A63", "A29", "A27", "A40", "A37"),
    ),
    "dashboard": (
        ("A01", "A04", "A09", "A08", "A07", "A24", "A06", "A25", "A20", "A13", "A31", "A67", "A03", "A41", "A61", "A05", "A42", "A11"),
        ("A15", "A62", "A19", "A28", "A12", "A22", "A63", "A29", "A27"),
    ),
}


def product_class(col: str, variant: str) -> str:
    secured, unsecured = PRODUCT_CLASSES[variant]
    return f"CASE WHEN {col} IN {secured} THEN 'Secured' WHEN {col} IN {unsecured} THEN 'Unsecured' ELSE 'Others' END"


# fixed values: product categories and their codes
RETAIL_CATEGORIES = {
    "HL": ("A06",), "PL": ("A12",), "AL": ("A01",), "LAP": ("A07",), "CV": ("A04", "A33"),
    "BL": ("A14", "A22", "A23", "A27", "A31", "A42"),
}
COMMERCIAL_CATEGORIES = {
    "LAP": ("9002",), "CV": ("4000",), "WC": ("0200", "0310"), "TL": ("0420", "0410", "5100", "5000"),
}


def relabelled(column: str, labels: dict[str, tuple[str, ...]], other: str) -> str:
    """SQL for the label whose values hold the column."""
    arms = " ".join(f"WHEN {column} IN ({', '.join(repr(v) for v in values)}) THEN '{label}'" for label, values in labels.items())
    return f"CASE {arms} ELSE {other} END"


RETAIL_CATEGORY = relabelled("account_type", RETAIL_CATEGORIES, "account_type")
COMMERCIAL_CATEGORY = relabelled("credit_type", COMMERCIAL_CATEGORIES, "'OTHERS'")


def purpose(col: str) -> str:
    return f"""CASE upper({col}) WHEN 'OTHERS' THEN 'OTHERS' WHEN 'INCOME' THEN 'INCOME' WHEN 'EDUCATION' THEN 'EDU'
  WHEN 'HOUSING' THEN 'HOUSE' WHEN 'AUTOMOBILE' THEN 'AUTOMOBILE' WHEN 'REAL ESTATE' THEN 'REALESTATE'
  WHEN 'NA' THEN 'NA' ELSE 'INVALID' END"""


def occupation(col: str) -> str:
    return f"""CASE upper({col}) WHEN 'OTHERS' THEN 'OTHERS' WHEN 'AGRICULTURE AND ALLIED' THEN 'AGRI'
  WHEN 'CONTRACT EMPLOYEE' THEN 'CONTRACT_EMP' WHEN 'SELF EMPLOYED' THEN 'SELF_EMP' WHEN 'EMPLOYED' THEN 'EMP'
  WHEN 'NULL' THEN 'BLANK' ELSE 'NA' END"""


def suppress(col: str) -> str:
    return f"CASE WHEN upper({col})='Y' THEN '1' WHEN upper({col})='N' THEN '0' WHEN {col} IS NULL THEN 'BLANK' ELSE 'NA' END"


def min_due_calc(amount: str = "disbursed_amount", n: str = "num_installment") -> str:
    return (f"CAST(round(CAST(CAST(abs({amount}) AS DOUBLE)/(CASE WHEN {n} IS NULL OR {n}=0 THEN 1 ELSE {n} END)"
            f" AS DECIMAL(38,8)), 2) AS DECIMAL(18,2))")


def debt(min_due: str, income: str, balance: str, active: str) -> dict[str, str]:
    one = lambda x: f"(CASE WHEN ({x}) = 0 THEN 1 ELSE ({x}) END)"
    first = ratio(f"({min_due})*12", one(income))
    new = f"(CASE WHEN {first} > 1 THEN ({income})*12 ELSE ({income}) END)"
    base = one(f"CASE WHEN {active} > 0 THEN {new} ELSE 0 END")
    due = f"(CASE WHEN {active} > 0 THEN ({min_due})*12 ELSE 0 END)"
    return {
        "debt_income_ratio": first, "annual_income_new": new, "min_due_annual": f"({min_due})*12",
        "min_due_ratio": ratio(min_due, one(income)), "debt_to_income_final": ratio(due, base, 100),
        "portfolio_to_income": ratio(balance, base, 100), "debt_to_income_active": ratio(due, base, 100),
    }


# --- buckets ----------------------------------------------------------------------
def ranges(col: str, table, null: str | None = None, other: str | None = None) -> str:
    """CASE over the (low, high, label) rows of a table."""
    arms = [] if null is None else [f"WHEN {col} IS NULL THEN '{null}'"]
    for low, high, label in table:
        test = f"<= {high}" if low is None else f"> {low}" if high is None else f"BETWEEN {low} AND {high}"
        arms.append(f"WHEN {col} {test} THEN '{label}'")
    return f"CASE {' '.join(arms)} ELSE {'NULL' if other is None else repr(other)} END"


# fixed values: bucket ranges as (low, high, label); an open end is None, strict above and inclusive below
B_DPD7 = (
    (0, 0, "0"),
    (1, 30, "1_30"),
    (31, 60, "31_60"),
    (61, 90, "61_90"),
    (91, 180, "91_180"),
    (181, 360, "181_360"),
    (360, None, ">360"),
)
B_DPD30 = (
    (1, 30, "1_30"),
    (31, 60, "31_60"),
    (61, 90, "61_90"),
    (91, 120, "91_120"),
    (121, 150, "121_150"),
    (151, 180, "151_180"),
    (181, 210, "181_210"),
    (211, 240, "211_240"),
    (241, 270, "241_270"),
    (271, 300, "271_300"),
    (301, 330, "301_330"),
    (331, 360, "331_360"),
    (360, None, ">360"),
)
B_WORST = (
    (1, 30, "1_30"),
    (31, 60, "31_60"),
    (61, 90, "61_90"),
    (91, 180, "91_180"),
    (180, None, ">180"),
)
B_FLOW9 = (
    (0, 0, "No Due"),
    (1, 30, "1_30"),
    (31, 60, "30_60"),
    (61, 90, "60_90"),
    (91, 120, "90_120"),
    (121, 150, "120_150"),
    (151, 180, "150_180"),
    (181, 360, "180_360"),
    (360, None, "360+"),
)
B_FLOW5 = (
    (0, 0, "No Due"),
    (1, 30, "1_30"),
    (31, 60, "30_60"),
    (61, 90, "60_90"),
    (91, 180, "90_180"),
)
B_AMOUNT6 = (
    (0, 5000, "0-5K"),
    (5001, 10000, "5K-10K"),
    (10001, 15000, "10K-15K"),
    (15001, 20000, "15K-20K"),
    (20001, 50000, "20K-50K"),
    (50001, 500000, "50K-5LAC"),
)
B_AMOUNT10 = (
    (None, 250000, "0-2.5L"),
    (250001, 1000000, "2.5L-10L"),
    (1000001, 1500000, "10L-15L"),
    (1500001, 2000000, "15L-20L"),
    (2000001, 2500000, "20L-25L"),
    (2500001, 4000000, "25L-40L"),
    (4000001, 5000000, "40L-50L"),
    (5000001, 10000000, "50L-1Cr"),
    (10000001, 50000000, "1Cr-5Cr"),
    (50000000, None, ">5Cr"),
)
B_TICKET = (
    (0, 5000, "0_5K"),
    (5001, 10000, "5K_10K"),
    (10001, 15000, "10K_15K"),
    (15001, 20000, "15K_20K"),
    (20001, 25000, "20K_25K"),
    (25001, 30000, "25K_30K"),
    (30001, 35000, "30K_35K"),
    (35001, 40000, "35K_40K"),
    (40001, 45000, "40K_45K"),
    (45001, 50000, "45K_50K"),
    (50001, 55000, "50K_55K"),
    (55001, 60000, "55K_60K"),
    (60001, 65000, "60K_65K"),
    (65001, 70000, "65K_70K"),
    (70001, 75000, "70K_75K"),
    (75001, 80000, "75K_80K"),
    (80001, 90000, "80K_90K"),
    (90001, 100000, "90K_1LAC"),
    (100001, 150000, "1LAC_1.5LAC"),
    (150001, 200000, "1.5LAC_2LAC"),
    (200001, 250000, "2LAC_2.5LAC"),
    (250001, 300000, "2.5LAC_3LAC"),
    (300001, 350000, "3LAC_3.5LAC"),
    (350001, 400000, "3.5LAC_4LAC"),
    (400001, 450000, "4LAC_4.5LAC"),
    (450001, 500000, "4.5LAC_5LAC"),
    (500001, 700000, "5LAC_7LAC"),
    (700001, 1000000, "7LAC_10LAC"),
    (1000000, None, "GRTR_10LAC"),
)
B_EXPOSURE = (
    (0, 10000, "0_10K"),
    (10001, 15000, "10K_15K"),
    (15001, 20000, "15K_20K"),
    (20001, 25000, "20K_25K"),
    (25001, 30000, "25K_30K"),
    (30001, 40000, "30K_40K"),
    (40001, 60000, "40K_60K"),
    (60001, 80000, "60K_80K"),
    (80001, 100000, "80K_100K"),
    (100001, 150000, "100K_150K"),
    (150000, None, ">150K"),
)
B_COUNT6 = (
    (1, 1, "1"),
    (2, 2, "2"),
    (3, 3, "3"),
    (4, 4, "4"),
    (5, 5, "5"),
    (5, None, ">5"),
)
B_VINTAGE = (
    (0, 3, "0-3"),
    (4, 6, "3-6"),
    (7, 12, "6-12"),
    (13, 24, "12-24"),
    (25, 36, "24-36"),
    (37, 48, "36-48"),
    (49, 60, "48-60"),
    (61, 120, "60-120"),
    (120, None, ">120"),
)
B_VINTAGE_M = (
    (0, 2, "0-3M"),
    (3, 5, "3-6M"),
    (6, 11, "6-12M"),
    (12, 23, "12-24M"),
    (24, 35, "24-36M"),
    (36, 47, "36-48M"),
    (48, 59, "48-60M"),
    (60, 119, "60-120M"),
    (119, None, ">120M"),
)
B_MOB = (
    (0, 2, "1_3"),
    (3, 5, "4_6"),
    (6, 8, "7_9"),
    (9, 11, "10_12"),
    (12, 14, "13_15"),
    (15, 17, "16_18"),
    (18, 20, "19_21"),
    (21, 23, "22_24"),
    (24, 26, "25_27"),
    (27, 29, "28_30"),
    (30, 32, "31_33"),
    (33, 35, "34_36"),
    (35, None, ">36"),
)
B_INSTAL = (
    (0, 6, "0_6"),
    (7, 12, "7_12"),
    (13, 24, "13_24"),
    (24, None, "GRTR24"),
)
B_INCOME = (
    (0, 5000, "0_5K"),
    (5001, 10000, "5K_10K"),
    (10001, 15000, "10K_15K"),
    (15001, 50000, "15K_50K"),
    (50001, 100000, "50K_1LACS"),
    (100000, None, "GRTR_1LACS"),
)
B_AGE = (
    (1, 17, "<18"),
    (18, 21, "18-21"),
    (22, 25, "22-25"),
    (26, 30, "26-30"),
    (31, 35, "31-35"),
    (36, 40, "36-40"),
    (41, 45, "41-45"),
    (46, 50, "46-50"),
    (51, 55, "51-55"),
    (56, 60, "56-60"),
    (61, 65, "61-65"),
    (65, None, ">65"),
)
B_MIN_DUE = (
    (None, 250, "<=250"),
    (251, 500, "250_500"),
    (501, 750, "500_750"),
    (751, 1000, "750_1000"),
    (1001, 1250, "1000_1250"),
    (1251, 1500, "1250_1500"),
    (1501, 2000, "1500_2000"),
    (2001, 2500, "2001_2500"),
    (2501, 3000, "2500_3000"),
    (3001, 4000, "3000_4000"),
    (4001, 5000, "4001_5000"),
    (5000, None, ">5000"),
)
B_DTI = (
    (0, 10, "0-10"),
    (11, 25, "11-25"),
    (26, 50, "26-50"),
    (51, 75, "51-75"),
    (76, 100, "76-100"),
    (100, None, ">100"),
)
B_PTI = (
    (0, 100, "0-100"),
    (101, 200, "100-200"),
    (201, 500, "200-500"),
    (501, 1000, "500-1000"),
    (1001, 2000, "1000-2000"),
    (2000, None, ">2000"),
)
B_DUE_RATIO = (
    (0, 2, "0-2"),
    (3, 5, "3-5"),
    (5, 7, "5-7"),
    (8, 10, "8-10"),
    (11, 15, "10-15"),
    (16, 20, "15-20"),
    (21, 30, "20-30"),
    (31, 50, "31-50"),
    (51, 100, "51-100"),
    (100, None, ">100"),
)
B_LENDERS5 = (
    (1, 1, "1"),
    (2, 2, "2"),
    (3, 3, "3"),
    (4, 4, "4"),
    (5, 99999, ">=5"),
)
B_LENDERS8 = (
    (None, 3, "<=3"),
    (4, 6, "4-6"),
    (7, 10, "7-10"),
    (11, 15, "11-15"),
    (16, 20, "16-20"),
    (21, 30, "21-30"),
    (31, 40, "31-40"),
    (40, None, ">40"),
)
B_TICKET_KEYS = (
    (None, 2, "<=10K"),
    (3, 3, "10K-15K"),
    (4, 4, "15K-20K"),
    (5, 5, "20K-25K"),
    (6, 6, "25K-30K"),
    (7, 8, "30K-40K"),
    (9, 12, "40K-60K"),
    (12, None, "60K+"),
)


def dpd14(dpd: str, due: str, amount: str) -> str:
    over = f"coalesce({due}, 0) > 0.01 * coalesce({amount}, 0)"
    return f"""CASE WHEN ({dpd} = 0 OR {dpd} IS NULL) AND {over} THEN 'Not Stipulated(Bad)'
  WHEN {dpd} = 0 OR {dpd} IS NULL THEN 'Not Deliquent(Good)' ELSE {ranges(dpd, B_DPD30, None, 'NA')} END"""


def dpd_worst(das: str, worst: str, due: str, amount: str) -> str:
    over = f"coalesce(abs({due}), 0) > 0.01 * coalesce(abs({amount}), 0)"
    live = f"{das} IN ('S04','S05')"
    unpaid = f"CASE WHEN {over} THEN 'Not Stipulated(Bad)' WHEN {live} THEN 'Not Deliquent(Good)' ELSE 'NA' END"
    late = f"CASE WHEN {live} AND {worst} > 0 THEN {ranges(worst, B_WORST)} ELSE 'NA' END"
    return f"""CASE {das} WHEN 'S06' THEN 'WRITEOFF' WHEN 'S07' THEN 'CLOSED'
  ELSE CASE WHEN coalesce({worst}, 0) = 0 THEN {unpaid} ELSE {late} END END"""


def dpd_account(dpd: str, das: str) -> str:
    return f"CASE WHEN coalesce({dpd}, 0) = 0 AND {das} IN {PORTFOLIO} THEN '0' ELSE {ranges(dpd, B_DPD7[1:])} END"


def cycle3(c: str) -> str:
    return f"""CASE WHEN {c} IN ('0','00','1','01','001') OR {c} IS NULL THEN '01' WHEN {c} IN ('2','02','002') THEN '02'
  ELSE '>=03' END"""


def cycle9(c: str) -> str:
    arms = " ".join(f"WHEN {c} IN ('{n}','0{n}','00{n}') THEN '0{n}'" for n in range(2, 8))
    return f"""CASE WHEN {c} IN ('0','00','1','01','001') OR {c} IS NULL THEN '01' {arms}
  WHEN {c} IN ('8','08','008','9','09','009','10','010','0010') THEN '8-10' ELSE '>10' END"""


def period(d: str) -> str:
    return (f"CASE WHEN {d} < DATE '1998-04-30' THEN 'Pre-Apr 1998' WHEN {d} >= DATE '1998-04-30' THEN 'Since Apr 1998'"
            f" ELSE 'NA' END")


def _account(column: str, expr: str) -> str:
    return f"SELECT account_key, {expr} AS {column} FROM account"


def _consumer(column: str, expr: str) -> str:
    return f"SELECT consumer_key, {expr} AS {column} FROM consumer"


def _over(due="amount_overdue_total"):
    return f"coalesce(abs({due}), 0) > 0.01 * coalesce({LOAN}, 0)"


_MONTH_MOVE = "SELECT account_key, disbursed_dt, current_balance, lead(disbursed_amount) OVER (ORDER BY account_key) AS nxt FROM account"
_DEBT = debt("min_amount_due", "i.annual_income", "abs(current_balance)", "CASE WHEN closed_dt IS NULL THEN 1 ELSE 0 END")
_A6 = lambda c: ranges(c, B_AMOUNT6, None, "OTHERS")
_AGE = f"{months_between(AS_OF, 'birth_dt')} / 12"
_AGE_REPORTED = (f"CASE WHEN birth_dt IS NOT NULL THEN {_AGE} WHEN age IS NOT NULL AND age_as_on_dt IS NOT NULL THEN "
                 f"{months_between(AS_OF, 'age_as_on_dt')} / 12 + age END")

SQL = {
    "raw_dpd": _account("raw_dpd", _RAW),
    "derived_dpd": _account("derived_dpd", DERIVED_DPD),
    "derived_dpd_commercial": f"""SELECT account_key, {commercial_dpd('dpd', 'cls')} AS derived_dpd
FROM (SELECT *, {NORM_CLASS} AS cls FROM commercial_account)""",
    "norm_asset_class": f"SELECT account_key, {NORM_CLASS} AS asset_class_norm FROM commercial_account",
    "norm_instal_freq": _account("freq", NORM_FREQ),
    "freq_or_na": _account("freq", FREQ_NA),
    "tenure_months": f"""SELECT account_key, {tenure('round')} AS tenure_rounded, {tenure('floor')} AS tenure_floor,
  CAST(CASE account_key % 7 WHEN 0 THEN round(num_installment / 4.0) WHEN 1 THEN round(num_installment / 2.0)
    WHEN 2 THEN num_installment WHEN 3 THEN num_installment * 2 WHEN 4 THEN num_installment * 4
    WHEN 5 THEN round(num_installment * 20 / 3.0) ELSE round(num_installment * 12.5) END AS INTEGER) AS tenure_all_codes
FROM account""",
    "sdp_rank": _consumer("sdp", """CASE WHEN state IS NOT NULL AND district IS NOT NULL AND pin_code IS NOT NULL THEN 1
  WHEN state IS NOT NULL AND district IS NOT NULL AND pin_code IS NULL THEN 2
  WHEN state IS NOT NULL AND district IS NULL AND pin_code IS NOT NULL THEN 3
  WHEN state IS NULL AND district IS NOT NULL AND pin_code IS NOT NULL THEN 4 ELSE 5 END"""),
    "sdpcl_rank": _consumer("sdpcl", """CASE
  WHEN state IS NOT NULL AND district IS NOT NULL AND pin_code IS NOT NULL AND city IS NOT NULL AND locality IS NOT NULL THEN 1
  WHEN state IS NOT NULL AND district IS NOT NULL AND pin_code IS NOT NULL AND city IS NOT NULL THEN 2
  WHEN state IS NOT NULL AND district IS NOT NULL AND pin_code IS NOT NULL AND city IS NULL AND locality IS NOT NULL THEN 3
  WHEN state IS NOT NULL AND district IS NOT NULL AND pin_code IS NULL AND city IS NOT NULL AND locality IS NOT NULL THEN 4
  WHEN state IS NOT NULL AND district IS NULL AND pin_code IS NOT NULL AND city IS NOT NULL AND locality IS NOT NULL THEN 5
  WHEN state IS NULL AND district IS NOT NULL AND pin_code IS NOT NULL AND city IS NOT NULL AND locality IS NOT NULL THEN 6
  ELSE 7 END"""),
    "ownership_flag": _consumer("ownership_ind_flag", "coalesce(substr(ownership_ind, 3, 1), '9')"),
    "age_at": f"""SELECT consumer_key, CAST(floor({_AGE}) AS INTEGER) AS age_years,
  round({_AGE_REPORTED}, 4) AS age_reported FROM consumer""",
    "loan_amount": _account("loan_amount", LOAN),
    "exposure_amount": _account("exposure", EXPOSURE),
    "not_closed": _account("not_closed_ind", f"CASE WHEN closed_dt IS NULL OR closed_dt > act_reported_dt THEN 'Y' ELSE 'N' END"),
    "is_active": f"""SELECT account_key,
  (closed_dt IS NULL OR closed_dt > {AS_OF}) AND das IN {PORTFOLIO} AS active_portfolio,
  (closed_dt IS NULL OR closed_dt > {AS_OF}) AND das IN {BOOK} AS active_book,
  (closed_dt IS NULL OR closed_dt > {AS_OF}) AND das IN ('S04','S05') AS active_strict FROM account""",
    "closed_ind_noc": _account("closed_dt_ind", f"CASE WHEN closed_dt IS NULL OR (closed_dt > {AS_OF} AND das IN {BOOK}) THEN 'N' ELSE 'Y' END"),
    "overdue_ind": _account("overdue_ind", overdue(_RAW, "amount_overdue_total", LOAN)),
    "not_stipulated": _account("stipulation", f"""CASE WHEN ({_RAW} = 0 OR {_RAW} IS NULL) AND {_over()} THEN 'NS'
  WHEN {_RAW} = 0 OR {_RAW} IS NULL THEN 'current' END"""),
    "mfi_status": _account("mfi_das", MFI_STATUS),
    "active_lender": _account("active_lender", f"""CASE WHEN ({MFI_STATUS}) IN ('S04','S05')
  AND (closed_dt IS NULL OR closed_dt > {AS_OF}) THEN lender_id END"""),
    "loan_state": _account("loan_state", f"""CASE WHEN closed_dt BETWEEN {shift(AS_OF, -6)} AND {AS_OF} THEN 'CLOSED WITHIN 6 MONTHS'
  WHEN closed_dt < {shift(AS_OF, -6)} THEN 'CLOSED BEFORE 6 MONTHS'
  WHEN (closed_dt IS NULL OR closed_dt > {AS_OF}) AND das IN ('S04','S05') THEN 'ACTIVE'
  WHEN das IN ('S06','S07') THEN 'CLOSED' ELSE 'NA' END"""),
    "months_on_book": f"""SELECT account_key, {mob('act_reported_dt', 'disbursed_dt')} AS mob,
  {mob(AS_OF, 'disbursed_dt')} + 1 AS vintage_mob FROM account""",
    "lender_type": f"""SELECT account_key, {lender_type('lender_id')} AS lender_type,
  CASE WHEN lender_id = {SELF} THEN 'Self' ELSE {lender_type('lender_id')} END AS lender_type_self,
  {lender_class('lender_id')} AS lender_class FROM account""",
    "peer_group": _account("peer_group", groups("lender_id", CARD_GROUPS, "PSBs+OTH", "PRB000")),
    "product_class": f"""SELECT account_key, {product_class('account_type', 'profile')} AS product_profile,
  {product_class('account_type', 'dashboard')} AS product_dashboard FROM account""",
    "product_category": f"""SELECT account_key, {RETAIL_CATEGORY} AS category FROM account UNION ALL
SELECT account_key, {COMMERCIAL_CATEGORY} FROM commercial_account""",
    "clean_digits": _account("digits", DIGITS),
    "purpose_code": f"SELECT lender_id, loan_purpose, {purpose('purpose_status')} AS purpose_code FROM purpose_dim",
    "occupation_code": _consumer("occupation_code", f"""{occupation("CASE occupation WHEN 'AUTOMOBILE' THEN 'Employed' WHEN 'BUILDING' THEN 'self employed' WHEN 'FURNITURE' THEN 'Agriculture and Allied' WHEN 'HOUSEHOLD' THEN NULL ELSE 'null' END")}"""),
    "suppress_code": _account("suppress_code", suppress("suppress_indicator")),
    "income_final": """SELECT account_key, consumer_key, clst_id, coalesce(CASE WHEN rw = 1 THEN annual_income END,
  CASE WHEN rw_month = 1 THEN monthly_income * 12 END) AS income_final FROM income_row_rank""",
    "debt_ratios": "SELECT account_key, a.consumer_key, " + ", ".join(f"{e} AS {n}" for n, e in _DEBT.items()) +
    " FROM account a JOIN consumer i ON a.consumer_key = i.consumer_key",
    "min_due_calc": f"""SELECT account_key, {min_due_calc()} AS min_due_calc,
  coalesce(min_amount_due, {min_due_calc()}) AS min_due_both FROM account""",
    "pct_change": f"""SELECT account_key, CASE WHEN high_credit IS NULL OR current_balance IS NULL THEN 0
  ELSE {ratio('current_balance - high_credit', 'high_credit', 100)} END AS pct,
  coalesce(current_balance, 0) - coalesce(high_credit, 0) AS diff FROM account""",
    "bucket_dpd": f"""SELECT account_key, {ranges('d', B_DPD7)} AS dpd7, {dpd_account('d', 'das')} AS dpd_account,
  {dpd14('d', 'abs(amount_overdue_total)', 'disbursed_amount')} AS dpd14,
  {dpd_worst('das', 'd', 'amount_overdue_total', 'disbursed_amount')} AS dpd_worst,
  {ranges('d', B_FLOW9, 'No Due')} AS dpd_flow9, {ranges('d', B_FLOW5, 'No Due')} AS dpd_flow5
FROM (SELECT *, {DERIVED_DPD} AS d FROM account)""",
    "bucket_amount": f"""SELECT account_key, {_A6('abs(current_balance)')} AS amount6,
  {ranges('abs(current_balance) * 100', B_AMOUNT10, None, 'NA')} AS amount10,
  {ranges('high_credit', B_TICKET, 'BLANK', 'NA')} AS ticket30,
  {ranges('high_credit', B_EXPOSURE, 'BLANK', 'NA')} AS exposure12,
  {ranges('min_amount_due', B_MIN_DUE, 'BLANK', 'NA')} AS min_due13 FROM account""",
    "bucket_term": f"""SELECT account_key, {ranges('m', B_VINTAGE)} AS vintage9, {ranges('m', B_VINTAGE_M)} AS vintage9_months,
  {ranges('m', B_MOB)} AS mob13, {ranges('num_installment', B_INSTAL, '0_6', 'NA')} AS instal4,
  {cycle3('trim(loan_cycle_id)')} AS cycle3, {cycle9('trim(loan_cycle_id)')} AS cycle9, {period('disbursed_dt')} AS disbursed_period,
  CASE WHEN disbursed_dt < {shift(AS_OF, -36)} THEN '<36 Months' ELSE fyq END AS origination_period
FROM (SELECT *, {mob(AS_OF, 'disbursed_dt')} AS m FROM account) a
LEFT JOIN date_dim ON yyyymm = year(disbursed_dt)*100 + month(disbursed_dt)""",
    "bucket_people": f"""SELECT consumer_key, {ranges('monthly_income', B_INCOME, 'BLANK', 'NA')} AS income7,
  {ranges(f'({_AGE_REPORTED})', B_AGE, None, 'NA')} AS age12 FROM consumer""",
    "bucket_ratio": f"""SELECT account_key, {ranges('p', B_DTI)} AS dti6, {ranges('p * 10', B_PTI)} AS pti6,
  {ranges('p', B_DUE_RATIO)} AS min_due_ratio10
FROM (SELECT account_key, {ratio('abs(current_balance)', 'disbursed_amount', 100)} AS p FROM account)""",
    "bucket_count": f"""SELECT consumer_key, {ranges('n', B_COUNT6)} AS loan_count6, {ranges('l', B_LENDERS5, 'NA', 'NA')} AS lender_count5,
  {ranges('n', B_LENDERS8)} AS lender_count8
FROM (SELECT consumer_key, count(*) AS n, count(DISTINCT lender_id) AS l FROM account GROUP BY consumer_key)""",
    "bucket_relabel": f"""SELECT account_key,
  CASE WHEN e IN ('0_10K','10K_15K') THEN '<=15' WHEN e IN ('15K_20K','20K_25K','25K_30K') THEN '15K_30K'
    WHEN e IN ('30K_40K','40K_60K') THEN '30K-60K' WHEN e = '60K_80K' THEN '60K-80K' WHEN e = '80K_100K' THEN '80K-100K'
    WHEN e = '100K_150K' THEN '100K_150K' WHEN e = '>150K' THEN '>150K' ELSE 'NA' END AS credit_exposure
FROM (SELECT account_key, {ranges('high_credit', B_EXPOSURE, 'BLANK', 'NA')} AS e FROM account)""",
}
MONEY = {
    "loan_amount": ["loan_amount"], "exposure_amount": ["exposure"], "income_final": ["income_final"],
    "debt_ratios": ["annual_income_new", "min_due_annual"], "min_due_calc": ["min_due_calc", "min_due_both"],
    "pct_change": ["pct", "diff"],
}
