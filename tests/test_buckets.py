"""Every bucket range at its bounds, between bounds and for NULL."""

import pytest
from pyspark.sql import functions as F

from loanbook.functions import buckets as B

SPECS = {n: s for n, s in vars(B).items() if isinstance(s, B.BucketSpec)}


def expected(spec, x):
    if x is None:
        return spec.null_label if spec.null_label is not None else spec.else_label
    for low, high, label in spec.ranges:
        if (low is None and x <= high) or (high is None and x > low):
            return label
        if low is not None and high is not None and low <= x <= high:
            return label
    return spec.else_label


@pytest.mark.parametrize("name", SPECS)
def test_bounds(spark, name):
    spec = SPECS[name]
    points = {None}
    for low, high, _ in spec.ranges:
        for bound in (low, high):
            if bound is not None:
                points |= {float(bound), bound + 0.5, bound + 1.0, bound - 1.0}
    df = spark.createDataFrame([(p,) for p in points], "x double")
    for x, label in df.select("x", B.bucket(F.col("x"), spec)).collect():
        assert label == expected(spec, x), (name, x)


def test_gap_and_overlap():
    assert expected(B.AGE12, 21.5) == "NA"
    assert expected(B.AMOUNT6, 5000.5) == "OTHERS"
    assert expected(B.MIN_DUE_RATIO10, 5) == "3-5"
    assert expected(B.MIN_DUE_RATIO10, 2.5) is None


def test_ticket_labels():
    assert len(B.TICKET30.ranges) == 29
    assert B.TICKET30.labels[:3] == ("0_5K", "5K_10K", "10K_15K")
    assert "90K_1LAC" in B.TICKET30.labels and "1.5LAC_2LAC" in B.TICKET30.labels
