"""Odd rows that every corpus operator must take: nulls, empty and very long texts, ties, repeats, clashing names."""

from __future__ import annotations

import pytest

LONG = "Lorem ipsum dolor sit amet consectetur. " * 6000
ROWS = [
    (1, "Abc def ghi jkl mno pqr", "en", "s", 23), (2, "aBC DEF ghi jkl mno pqr", "en", "s", 23),
    (3, None, None, None, None), (4, "", "en", "s", 0), (5, "  \n \n", "fr", None, 5), (None, "Ünïcode ÀÉ text", "fr", "s", 15),
    (None, "Ünïcode ÀÉ text", "fr", "s", 15), (None, "ünïcode àé text", None, "s", 15), (7, LONG, "en", "s", len(LONG)),
    (8, LONG.upper(), "en", "s", len(LONG)), (9, LONG + "x", "en", "s", len(LONG) + 1), (10, "1234 5678 !!", "en", "s", 12),
    (11, "same row", "en", "s", 8), (11, "same row", "en", "s", 8), (11, "other text of an id used twice", "en", "s", 30),
    (12, "a" * 64, "en", "s", 64), (13, "a" * 64, "en", "s", 64), (14, "a" * 65, "en", "s", 65), (15, "\x00\U0001f600 漢字", "en", "s", 5),
]
NAMES = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = (
    "size", "chunk", "row", "tag", "group_no", "live", "kept", "score", "lang_pred", "bits", "shard", "length", "piece",
    "row_no", "digest", "bands", "cid", "none", "part", "place", "entry",
)


@pytest.fixture
def odd(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame(ROWS, NAMES)
    return rows.withColumns({name: F.lit(f"own {name}") for name in CLASHING}).repartition(5)


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], NAMES)


@pytest.fixture
def texts(spark, small):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
