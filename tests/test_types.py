"""Result types of queries and SQL agree."""

import os

import pytest

import __spark_entry__ as entry
from compare import connect

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test data not there")

SAME = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP",
        "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if not n.startswith("stream_")))
def test_types(spark, name):
    described = connect(SF_DIR).execute(f"DESCRIBE {entry.oracle_sql()[name]}").fetchall()
    expected = {col: dtype for col, dtype, *_ in described}
    got = {col: SAME[dtype] for col, dtype in entry.queries()[name](spark, SF_DIR).dtypes}
    assert got == expected
