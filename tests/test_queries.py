"""Every registered query against its SQL counterpart, on the smallest tables."""

import hashlib
import os
import re

import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# the optional queries for training data have tests of their own in tests/llm
OPTIONAL = re.compile(r"op\d+_.*|pipeline")
QUERIES, ORACLES = ({k: v for k, v in x.items() if not OPTIONAL.fullmatch(k)} for x in (entry.queries(), entry.oracle_sql()))


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    problem = difference(QUERIES[name](spark, SF_DIR), con, ORACLES[name])
    assert problem is None, problem


def test_every_query_has_a_counterpart_or_a_test_of_its_own():
    assert set(QUERIES) - set(ORACLES) == {"file_checksums"}


def test_file_checksums(spark):
    found = {r["file_name"]: (r["sha256"], r["bytes"]) for r in QUERIES["file_checksums"](spark, SF_DIR).collect()}
    expected = {}
    for name in os.listdir(SF_DIR):
        with open(f"{SF_DIR}/{name}", "rb") as handle:
            content = handle.read()
        expected[name] = (hashlib.sha256(content).hexdigest(), len(content))
    assert found == expected


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns[0] == "vehicle_key"
    assert frame.count() > 0
