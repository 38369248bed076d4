"""Every registered query against its DuckDB oracle on the smallest tables,
and the rows-only ones for running and returning rows."""

from __future__ import annotations

import math
import os
import re
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import compare, duck_connection  # noqa: E402

from tests.conftest import SF_SMALL  # noqa: E402

# the document operators have their own tests in tests/llm
QUERIES = {k: q for k, q in entry.queries().items() if not re.match(r"op\d+_|pipeline$", k)}
ORACLE = {k: q for k, q in entry.oracle_sql().items() if k in QUERIES}
WITH_SQL = sorted(ORACLE)
ROWS_ONLY = sorted(set(QUERIES) - set(ORACLE))


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF_SMALL)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", WITH_SQL)
def test_query_matches_oracle(spark, duck, name):
    res = compare(spark, duck, name, QUERIES[name], ORACLE[name], SF_SMALL)
    assert res["match"], res


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows_only_query_runs(spark, name):
    rows = QUERIES[name](spark, SF_SMALL).collect()
    assert rows
    if {"model", "metric", "value"} <= set(rows[0].__fields__):
        values = {(r["model"], r["metric"]): r["value"] for r in rows}
        assert all(v is None or math.isfinite(v) for v in values.values()), values
        assert all(0 <= v <= 1 for (_, m), v in values.items() if m == "accuracy")


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:2] == ["subject_id", "hadm_id"]
    assert df.columns[-20:] == [f"icd9_g{i}" for i in range(1, 21)]
    assert entry.entry(spark).schema == df.schema
