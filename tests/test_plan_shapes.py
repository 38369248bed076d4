"""Plan-shape guards: the shapes that matter at scale must not regress.

Size-based broadcasts are switched off so the plans have the form they take
on large tables; counts come from ``explain("formatted")``.
"""

from __future__ import annotations

import contextlib
import io
import re

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL

NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture()
def no_broadcast(spark):
    old = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    for k, v in NO_BROADCAST.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _plan(spark, name):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        entry.queries()[name](spark, SF_SMALL).explain("formatted")
    text = buf.getvalue()
    tree = text.split("\n\n")[0]
    shuffles = tree.count("Exchange") - tree.count("BroadcastExchange")
    return text, shuffles, tree.count("Scan parquet")


def test_one_pass_measures_shape(no_broadcast):
    text, shuffles, scans = _plan(no_broadcast, "subject_features")
    assert (shuffles, scans) == (5, 4)
    assert re.search(r"PushedFilters: \[In\(event_type,", text)
    # the events scan reads only the three columns the aggregate needs
    assert "ReadSchema: struct<user_id:bigint,event_type:string,value:double>" in text
    assert "partial_sum" in text and "PythonUDF" not in text and "BatchEvalPython" not in text


def test_chain_is_the_expensive_shape(no_broadcast):
    _, shuffles, scans = _plan(no_broadcast, "measures_chain")
    assert shuffles > 5 * 5 and scans > 4 * 4


def test_single_scan_queries_do_not_shuffle(no_broadcast):
    for name in ("filter_isin", "filter_eq", "filter_or", "code_group", "unit_convert", "safe_numeric"):
        text, shuffles, scans = _plan(no_broadcast, name)
        assert (shuffles, scans) == (0, 1), name
        # formatted explain marks operators inside whole-stage codegen with "*"
        assert re.search(r"^(\+- )?\* (Project|Filter)", text.split("\n\n")[0], re.M), name


def test_flagship_joins_lines_with_orders_once(no_broadcast):
    text, shuffles, scans = _plan(no_broadcast, "stay_features")
    tree = text.split("\n\n")[0]
    assert tree.count("SortMergeJoin") <= 7
    reads = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    # once for labs and diagnoses together (with its order), once for the stays
    lines = [r for r in reads if "l_orderkey" in r]
    assert len(lines) == 2 and sum("l_partkey" in r for r in lines) == 1
    assert (shuffles, scans) == (9, 7)


def test_stays_meet_admissions_on_narrow_rows(no_broadcast):
    """No chapter count goes through the admission shuffle."""
    text, _, _ = _plan(no_broadcast, "cohort_features")
    for block in re.findall(r"\(\d+\) Exchange\n(.*?)\n\n", text, re.S):
        if re.search(r"hashpartitioning\(hadm_id", block):
            assert "icd9_g" not in block
