"""Every registered query against its DuckDB oracle at sf0.01 (the driver's gate)."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from tests.conftest import SF001, SF01
from tests.oracle import compare, duck

NAMES = [n for n in E.queries() if n not in E.LLM_QUERIES]


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    fn = E.queries()[name]
    if name not in E.oracle_sql():
        assert fn(spark, SF01).count() >= 0
        return
    ok, msg = compare(spark, SF01, name, fn, E.oracle_sql()[name], con)
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 31
    assert df.columns == ["company_id", "date", "open", "high", "low", "close", "volume"]


@pytest.fixture(scope="module")
def no_broadcast(spark):
    """A session where no side fits a broadcast: Spark's own thresholds are
    off and every size check fails, so each lookup takes the shuffle path."""
    s = spark.newSession()
    s.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    s.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    return s


@pytest.mark.parametrize("name", [n for n in NAMES if n in E.oracle_sql()])
def test_shuffle_join_path_matches_oracle(no_broadcast, con, name, monkeypatch):
    from tests.conftest import plan_text
    from tickwise.operators import joins
    monkeypatch.setattr(joins, "is_broadcastable", lambda df, max_bytes=0: False)
    fn = E.queries()[name]
    # seed_ids broadcasts its offsets, one row per partition; the ingested store's
    # list of merged batches is empty here
    if name not in ("seed_ids", "ingested_ticks"):
        assert "BroadcastHashJoin" not in plan_text(fn(no_broadcast, SF01)), name
    ok, msg = compare(no_broadcast, SF01, name, fn, E.oracle_sql()[name], con)
    assert ok, msg


def test_schemas_are_stable_across_scales(spark):
    for name in NAMES:
        fn = E.queries()[name]
        assert fn(spark, SF001).schema == fn(spark, SF01).schema, name
