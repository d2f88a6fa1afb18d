"""Every registered query against its SQL, and the inventory of operators."""

import re

import pytest

import __spark_entry__ as entry
from compare import difference
from formsift.plans.catalog import QUERIES
from oracle.queries import ORACLE


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, duck, small, name):
    assert difference(spark, duck, small, name) == ""


def test_every_operator_has_a_query():
    have = {re.match(r"[a-z]+\d+", name).group() for name in QUERIES}
    wanted = {f"{group}{i}" for group, n in
              {"s": 11, "c": 10, "t": 14, "l": 16, "a": 10, "b": 6, "n": 12, "v": 19, "e": 10, "g": 10}.items()
              for i in range(1, n + 1)}
    assert wanted <= have


def test_no_query_lacks_sql():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= entry.queries().items() and ORACLE.items() <= entry.oracle_sql().items()


def test_entry_has_result_rows(spark):
    assert entry.entry(spark).count() > 0
