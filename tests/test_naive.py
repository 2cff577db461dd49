"""Single-plan forms give the rows of the plain forms."""

from dataclasses import replace

import pytest

from benchmarks.naive import NAIVE
from compare import rows_of
from loanbook.params import DEFAULT_PARAMS
from loanbook.plans.catalog import QUERIES, as_output
from loanbook.sources.views import Book


PARAMS = replace(DEFAULT_PARAMS, look_back_months=6, wallet_lenders=("CCC009", "PRB000", "NBF004"))


@pytest.mark.parametrize("name", NAIVE)
def test_same_rows(spark, small, name):
    plain = as_output(NAIVE[name](Book(spark, small), PARAMS))
    single = as_output(QUERIES[name](Book(spark, small), PARAMS))
    assert sorted(plain.columns) == sorted(single.columns)
    assert rows_of(plain.columns, plain.collect()) == rows_of(single.columns, single.collect())
