"""Every registered query runs; those with an oracle equal DuckDB value by value and are not empty."""

import check
import pytest

import __spark_entry__ as entry

ORACLES = entry.oracle_sql()
# Fitted trees and topic models take long and have their own tests.
SLOW = {"m09_model_comparison", "u02_registered_tasks"}
# Nothing in the smallest tables matches; the larger ones are compared by tools/check.py.
MAY_BE_EMPTY = {"d08_pii_of_one_type", "f21_substring_by_offsets", "g02_graph_facet", "g06_triples_by_relation"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    return check.oracle(sf_dir)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


@pytest.mark.parametrize("name", [n for n in entry.queries() if n not in SLOW])
def test_query(spark, duck, sf_dir, name):
    status, detail, _ = check.compare(spark, duck, name, sf_dir)
    allowed = {"ok", "rows"} | ({"EMPTY"} if name in MAY_BE_EMPTY else set())
    assert status in allowed, f"{status}: {detail}"


def test_entry(spark):
    assert entry.entry(spark).count() > 0
