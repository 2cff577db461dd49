"""Labelled range buckets, with every range list held as data.

Bounds are inclusive. A value that falls between two integer ranges (for
example 5000.5) takes the ELSE label, and the first matching range wins.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

Bound = int | None


@dataclass(frozen=True)
class BucketSpec:
    ranges: tuple[tuple[Bound, Bound, str], ...]
    null_label: str | None = None
    else_label: str | None = None

    @property
    def labels(self) -> tuple[str, ...]:
        """Distinct labels in order; their positions are the dimension keys."""
        names = [label for _, _, label in self.ranges]
        names += [x for x in (self.null_label, self.else_label) if x is not None]
        return tuple(dict.fromkeys(names))


def steps(*edges_and_labels, start: int = 0, last: str | None = None, null=None, other=None) -> BucketSpec:
    """Consecutive ranges: each entry is (upper bound, label); `last` is the open top."""
    ranges, low = [], start
    for high, label in edges_and_labels:
        ranges.append((low, high, label))
        low = high + 1
    if last is not None:
        ranges.append((low - 1, None, last))
    return BucketSpec(tuple(ranges), null, other)


def _range_test(col: Column, low: Bound, high: Bound) -> Column:
    if high is None:
        # an open top starts strictly above the last closed bound
        return col > F.lit(low)
    if low is None:
        return col <= F.lit(high)
    return col.between(F.lit(low), F.lit(high))


def bucket(col: Column, spec: BucketSpec) -> Column:
    """Label of the range holding `col`."""
    arms = None
    if spec.null_label is not None:
        arms = F.when(col.isNull(), F.lit(spec.null_label))
    for low, high, label in spec.ranges:
        test = _range_test(col, low, high)
        arms = F.when(test, F.lit(label)) if arms is None else arms.when(test, F.lit(label))
    return arms.otherwise(F.lit(spec.else_label).cast("string"))


# --- fixed values: bucket ranges ----------------------------------------------
DPD7 = steps((0, "0"), (30, "1_30"), (60, "31_60"), (90, "61_90"), (180, "91_180"), (360, "181_360"), last=">360")
DPD_BANDS_30 = steps(
    (30, "1_30"), (60, "31_60"), (90, "61_90"), (120, "91_120"), (150, "121_150"), (180, "151_180"),
    (210, "181_210"), (240, "211_240"), (270, "241_270"), (300, "271_300"), (330, "301_330"), (360, "331_360"),
    start=1, last=">360",
)
DPD_WORST = steps((30, "1_30"), (60, "31_60"), (90, "61_90"), (180, "91_180"), start=1, last=">180")
DPD_FLOW9 = steps(
    (0, "No Due"), (30, "1_30"), (60, "30_60"), (90, "60_90"), (120, "90_120"), (150, "120_150"), (180, "150_180"),
    (360, "180_360"), last="360+", null="No Due",
)
DPD_FLOW5 = steps((0, "No Due"), (30, "1_30"), (60, "30_60"), (90, "60_90"), (180, "90_180"), null="No Due")
AMOUNT6 = steps(
    (5000, "0-5K"), (10000, "5K-10K"), (15000, "10K-15K"), (20000, "15K-20K"), (50000, "20K-50K"),
    (500000, "50K-5LAC"), other="OTHERS",
)
AMOUNT10 = BucketSpec(
    ((None, 250000, "0-2.5L"),)
    + steps(
        (1000000, "2.5L-10L"), (1500000, "10L-15L"), (2000000, "15L-20L"), (2500000, "20L-25L"),
        (4000000, "25L-40L"), (5000000, "40L-50L"), (10000000, "50L-1Cr"), (50000000, "1Cr-5Cr"),
        start=250001, last=">5Cr",
    ).ranges,
    else_label="NA",
)


TICKET30 = BucketSpec((
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
), null_label="BLANK", else_label="NA")
EXPOSURE12 = steps(
    (10000, "0_10K"), (15000, "10K_15K"), (20000, "15K_20K"), (25000, "20K_25K"), (30000, "25K_30K"),
    (40000, "30K_40K"), (60000, "40K_60K"), (80000, "60K_80K"), (100000, "80K_100K"), (150000, "100K_150K"),
    last=">150K", null="BLANK", other="NA",
)
LOAN_COUNT6 = BucketSpec((
    (1, 1, "1"),
    (2, 2, "2"),
    (3, 3, "3"),
    (4, 4, "4"),
    (5, 5, "5"),
    (5, None, ">5"),
))
VINTAGE9 = steps(
    (3, "0-3"), (6, "3-6"), (12, "6-12"), (24, "12-24"), (36, "24-36"), (48, "36-48"), (60, "48-60"),
    (120, "60-120"), last=">120",
)
VINTAGE9_MONTHS = steps(
    (2, "0-3M"), (5, "3-6M"), (11, "6-12M"), (23, "12-24M"), (35, "24-36M"), (47, "36-48M"), (59, "48-60M"),
    (119, "60-120M"), last=">120M",
)
MOB13 = BucketSpec((
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
))
INSTAL4 = steps((6, "0_6"), (12, "7_12"), (24, "13_24"), last="GRTR24", null="0_6", other="NA")
INCOME7 = steps(
    (5000, "0_5K"), (10000, "5K_10K"), (15000, "10K_15K"), (50000, "15K_50K"), (100000, "50K_1LACS"),
    last="GRTR_1LACS", null="BLANK", other="NA",
)
AGE12 = steps(
    (17, "<18"), (21, "18-21"), (25, "22-25"), (30, "26-30"), (35, "31-35"), (40, "36-40"), (45, "41-45"),
    (50, "46-50"), (55, "51-55"), (60, "56-60"), (65, "61-65"), start=1, last=">65", other="NA",
)
MIN_DUE13 = BucketSpec(
    ((None, 250, "<=250"),)
    + steps(
        (500, "250_500"), (750, "500_750"), (1000, "750_1000"), (1250, "1000_1250"), (1500, "1250_1500"),
        (2000, "1500_2000"), (2500, "2001_2500"), (3000, "2500_3000"), (4000, "3000_4000"), (5000, "4001_5000"),
        start=251, last=">5000",
    ).ranges,
    null_label="BLANK", else_label="NA",
)
DTI6 = steps((10, "0-10"), (25, "11-25"), (50, "26-50"), (75, "51-75"), (100, "76-100"), last=">100")
PTI6 = steps(
    (100, "0-100"), (200, "100-200"), (500, "200-500"), (1000, "500-1000"), (2000, "1000-2000"), last=">2000",
)
MIN_DUE_RATIO10 = BucketSpec((
    (0, 2, "0-2"), (3, 5, "3-5"), (5, 7, "5-7"), (8, 10, "8-10"), (11, 15, "10-15"), (16, 20, "15-20"),
    (21, 30, "20-30"), (31, 50, "31-50"), (51, 100, "51-100"), (100, None, ">100"),
))
LENDER_COUNT5 = BucketSpec((
    (1, 1, "1"),
    (2, 2, "2"),
    (3, 3, "3"),
    (4, 4, "4"),
    (4, None, ">=5"),
), null_label="NA", else_label="NA")
LENDER_COUNT8 = BucketSpec(
    ((None, 3, "<=3"),)
    + steps((6, "4-6"), (10, "7-10"), (15, "11-15"), (20, "16-20"), (30, "21-30"), (40, "31-40"),
            start=4, last=">40").ranges,
)

# --- fixed values: label groups for reports -----------------------------------
EXPOSURE_RELABEL = {
    "0_10K": "<=15", "10K_15K": "<=15", "15K_20K": "15K_30K", "20K_25K": "15K_30K", "25K_30K": "15K_30K",
    "30K_40K": "30K-60K", "40K_60K": "30K-60K", "60K_80K": "60K-80K", "80K_100K": "80K-100K",
    "100K_150K": "100K_150K", ">150K": ">150K",
}
DPD_WORST_RELABEL = {
    "Not Deliquent(Good)": "CURRENT", "1_30": "1-30 DPD", "31_60": "31-60 DPD", "61_90": "61-90 DPD",
    "91_180": "91-180 DPD", ">180": ">180 DPD", "Not Stipulated(Bad)": "Not stipulated", "WRITEOFF": "Written-Off",
}
LENDER_COUNT_RELABEL = {
    "1": "1 Lender", "2": "2 Lenders", "3": "3 Lenders", "4": "4 Lenders", ">=5": ">=5 Lenders",
}
TICKET_KEY_GROUPS = BucketSpec(
    ((None, 2, "<=10K"), (3, 3, "10K-15K"), (4, 4, "15K-20K"), (5, 5, "20K-25K"), (6, 6, "25K-30K"),
     (7, 8, "30K-40K"), (9, 12, "40K-60K"), (12, None, "60K+")), "NA", "NA",
)
CYCLE3 = {"01": ("0", "00", "1", "01", "001"), "02": ("2", "02", "002")}
CYCLE9 = {
    "01": ("0", "00", "1", "01", "001"), "02": ("2", "02", "002"), "03": ("3", "03", "003"),
    "04": ("4", "04", "004"), "05": ("5", "05", "005"), "06": ("6", "06", "006"), "07": ("7", "07", "007"),
    "8-10": ("8", "08", "008", "9", "09", "009", "10", "010", "0010"),
}

ONE_PERCENT = Decimal("0.01")


def relabel(col: Column, mapping: dict[str, str], other: str = "NA") -> Column:
    """Map labels through `mapping`; anything else becomes `other`."""
    groups: dict[str, list[str]] = {}
    for source, target in mapping.items():
        groups.setdefault(target, []).append(source)
    arms = None
    for target, sources in groups.items():
        test = col.isin(*sources)
        arms = F.when(test, F.lit(target)) if arms is None else arms.when(test, F.lit(target))
    return arms.otherwise(F.lit(other))


def dpd_account(dpd: Column, is_active_status: Column) -> Column:
    """Seven DPD bands in which band 0 also asks for an active status."""
    no_zero = replace(DPD7, ranges=DPD7.ranges[1:])
    return F.when((F.coalesce(dpd, F.lit(0)) == 0) & is_active_status, F.lit("0")).otherwise(bucket(dpd, no_zero))


def dpd14(dpd: Column, overdue: Column, amount: Column) -> Column:
    """30-day bands, with zero DPD split by the one-percent overdue rule."""
    zero = F.coalesce(dpd, F.lit(0)) == 0
    over = F.coalesce(overdue, F.lit(0)) > F.lit(ONE_PERCENT) * F.coalesce(amount, F.lit(0))
    labelled = replace(DPD_BANDS_30, else_label="NA")
    return (
        F.when(zero & over, F.lit("Not Stipulated(Bad)"))
        .when(zero & ~over, F.lit("Not Deliquent(Good)"))
        .otherwise(bucket(dpd, labelled))
    )


def dpd_worst(status: Column, worst: Column, overdue: Column, amount: Column) -> Column:
    """Worst active DPD of the borrower, crossed with the loan's own status."""
    live = status.isin("S04", "S05")
    zero = F.coalesce(worst, F.lit(0)) == 0
    over = F.coalesce(F.abs(overdue), F.lit(0)) > F.lit(ONE_PERCENT) * F.coalesce(F.abs(amount), F.lit(0))
    return (
        F.when(live & zero & ~over, F.lit("Not Deliquent(Good)"))
        .when(live & (worst > 0), bucket(worst, DPD_WORST))
        .when(status == "S06", F.lit("WRITEOFF"))
        .when(status == "S07", F.lit("CLOSED"))
        .when(zero & over, F.lit("Not Stipulated(Bad)"))
        .otherwise(F.lit("NA"))
    )


def cycle3(cycle: Column) -> Column:
    return (
        F.when(cycle.isNull() | cycle.isin(*CYCLE3["01"]), F.lit("01"))
        .when(cycle.isin(*CYCLE3["02"]), F.lit("02"))
        .otherwise(F.lit(">=03"))
    )


def cycle9(cycle: Column) -> Column:
    arms = F.when(cycle.isNull(), F.lit("01"))
    for label, codes in CYCLE9.items():
        arms = arms.when(cycle.isin(*codes), F.lit(label))
    return arms.otherwise(F.lit(">10"))


def disbursed_period(disbursed: Column, cutoff) -> Column:
    """Before / since a cutoff month, labelled with that month."""
    month = cutoff.strftime("%b %Y")
    return (
        F.when(disbursed < F.lit(cutoff), F.lit(f"Pre-{month}"))
        .when(disbursed >= F.lit(cutoff), F.lit(f"Since {month}"))
        .otherwise(F.lit("NA"))
    )


def origination_period(disbursed: Column, observed_from, fiscal_quarter: Column) -> Column:
    return F.when(disbursed < F.lit(observed_from), F.lit("<36 Months")).otherwise(fiscal_quarter)
