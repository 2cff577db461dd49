"""Dimension tables that follow from configuration: fixed, small, broadcastable."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanbook.functions import buckets as B
from loanbook.functions import rules as R

# --- fixed values: lenders of the test book -----------------------------------
LENDERS = (
    "PRB000", "PRB001", "PRB002", "PRB003", "NBF004", "NBF005", "NBF006", "HFC007", "ARC008", "CCC009", "SBI010",
    "FRB011",
)
ACCOUNT_TYPES = ("A01", "A06", "A07", "A12", "A13", "A15", "A22")
# fixed values: account status -> dimension key
STATUS_KEYS = {
    "S01": 1, "S02": 2, "S03": 3, "S04": 4, "S05": 5, "S06": 6, "S07": 7, "S11": 8, "S12": 9, "S13": 10, "S16": 11,
    "S18": 12, "S20": 13, "S25": 14,
}


def _label_rows(labels) -> list[tuple[int, str, int]]:
    return [(key, label, 1) for key, label in enumerate(labels, start=1)]


def label_dim(spark: SparkSession, labels) -> DataFrame:
    """(key, label, active) with keys 1..n in label order."""
    return spark.createDataFrame(_label_rows(labels), "key int, label string, active int")


DPD14_LABELS = ("Not Stipulated(Bad)", *[x for _, _, x in B.DPD_BANDS_30.ranges], "Not Deliquent(Good)", "NA")


def bucket_dims(spark: SparkSession) -> dict[str, DataFrame]:
    """The label dimensions of the fact table by name."""
    cycle9 = tuple(B.CYCLE9) + (">10",)
    labels = {
        "loan_state": R.LOAN_STATES,
        "dpd": DPD14_LABELS,
        "ticket_size": B.TICKET30.labels,
        "cycle": ("01", "02", ">=03"),
        "cycle_new": cycle9,
        "instalments": ("0_6", "7_12", "13_24", "GRTR24", "NA"),
        "frequency": R.KNOWN_FREQS + ("NA",),
        "income": B.INCOME7.labels,
        "age": B.AGE12.labels,
        "occupation": tuple(R.OCCUPATION_CODES.values()) + ("NA",),
        "purpose": tuple(R.PURPOSE_CODES.values()) + ("INVALID",),
        "suppress": ("1", "0", "BLANK", "NA"),
        "min_due": B.MIN_DUE13.labels,
    }
    dims = {name: label_dim(spark, values) for name, values in labels.items()}
    dims["status"] = spark.createDataFrame(
        [(key, code, 1) for code, key in STATUS_KEYS.items()], "key int, label string, active int"
    )
    dims["category"] = category_dim(spark).select(
        F.col("category_key").alias("key"), F.col("loan_category").alias("label"), "active"
    )
    return dims


def category_dim(spark: SparkSession) -> DataFrame:
    """Loan categories."""
    rows = [(1, "T01", "Group loan", 1), (2, "T02", "Individual loan", 1), (3, "T03", "Housing loan", 1), (4, "T04", "Other loan", 1)]
    return spark.createDataFrame(rows, "category_key int, loan_category string, category_name string, active int")


def lender_dim(spark: SparkSession) -> DataFrame:
    rows = [(n, lender, f"{lender} {'Bank' if lender[:3] in ('PRB', 'SBI') else 'Finance'}", 1)
            for n, lender in enumerate(LENDERS, start=1)]
    return spark.createDataFrame(rows, "contri_key int, lender_id string, institution_name string, active int")


def account_type_dim(spark: SparkSession) -> DataFrame:
    """Account types."""
    rows = [(n, code, f"Product {code}", 1) for n, code in enumerate(ACCOUNT_TYPES, start=1)]
    return spark.createDataFrame(rows, "account_type_key int, account_type string, account_name string, active int")


def date_dim(spark: SparkSession, calendar: tuple[date, date]) -> DataFrame:
    """One row per month of the calendar, from its first to its last, with its April-based fiscal quarter."""
    first, last = calendar
    months = spark.range((last.year - first.year) * 12 + last.month - first.month + 1).select(
        F.add_months(F.lit(first), F.col("id").cast("int")).alias("d")
    )
    fiscal = F.add_months("d", -3)
    return months.select(
        R.yyyymm(F.col("d")).alias("yyyymm"),
        F.concat(F.lit("FY"), F.year(fiscal), F.lit("-Q"), F.quarter(fiscal)).alias("fyq"),
    )
