"""Registered queries against their SQL, on whole tables."""

import os
import re

import pytest

import __spark_entry__ as entry
from compare import connect, duck_bag, spark_bag

SF_DIR = os.environ.get("MARTLOOM_SF_DIR", "/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test data not there")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    without = set(entry.queries()) - set(entry.oracle_sql())
    assert {q for q in without if not re.match(r"op\d+_|pipeline$", q)} == set()


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    cols, got = spark_bag(entry.queries()[name](spark, SF_DIR))
    expected_cols, expected = duck_bag(duck, entry.oracle_sql()[name])
    assert cols == expected_cols
    assert got == expected
    assert got


def test_invariants(spark):
    run = entry.queries()
    for r in run["community_conversion"](spark, SF_DIR).collect():
        assert r.writers <= r.joined_users and (r.conversion is None or 0 <= r.conversion <= 1)
    assert run["friend_recommendations"](spark, SF_DIR).filter("a >= b").count() == 0


def test_smoke_entry(spark):
    assert entry.entry(spark).count() == 10
