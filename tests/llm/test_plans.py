"""Plan shape of the text operators."""

from __future__ import annotations

import re

import pytest

from tests.conftest import SF001, SF01, plan_text
from tests.oracle import compare, duck
from tickwise.llm import queries

TABLES = {"op1_toxicity": "documents", "op4_warc": "pages", "op5_url_filter": "pages", "op10_html_text": "pages"}


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_no_all_pairs_join_and_no_row_wise_python(spark, name):
    txt = plan_text(queries.QUERIES[name](spark, SF001))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in txt


def test_url_filter_and_quality_rules_are_native(spark):
    for name in ("op3_quality_rules", "op5_url_filter"):
        assert not re.search("Python|Pandas|Arrow", plan_text(queries.QUERIES[name](spark, SF001)))
    assert "Exchange" not in plan_text(queries.op3_quality_rules(spark, SF001))


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_matches_duckdb(spark, name):
    ok, message = compare(spark, SF01, name, queries.QUERIES[name], queries.ORACLES[name], duck(SF01))
    assert ok, message


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_schema_is_stable(spark, name):
    assert queries.QUERIES[name](spark, SF001).schema == queries.QUERIES[name](spark, SF01).schema
