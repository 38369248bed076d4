"""The queries are registered, and those with SQL agree with it."""

from __future__ import annotations

import os
import re
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import compare, duck_connection  # noqa: E402

from tests.conftest import SF_SMALL  # noqa: E402


def test_all_queries():
    names = [k for k in entry.queries() if re.match(r"op\d+_", k)]
    assert sorted(int(re.match(r"op(\d+)_", k)[1]) for k in names) == list(range(1, 14))
    assert "pipeline" in entry.queries() and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["op4_minhash", "op6_exact", "op12_negatives", "op13_repair"])
def test_query_matches_oracle(spark, name):
    got = compare(spark, duck_connection(SF_SMALL), name, entry.queries()[name], entry.oracle_sql()[name], SF_SMALL)
    assert got["match"], got
