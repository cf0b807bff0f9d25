"""Driver contract: entry smoke, and every named query against its DuckDB
oracle at sf0.001 (row count, column names, order-insensitive values)."""

import contextlib
import io

import pytest

import __spark_entry__ as entry_mod
from tests.conftest import SF001
from tools.compare import compare, duck

# the corpus queries have tests of their own, beside their subpackage
QUERIES = {n: q for n, q in entry_mod.queries().items() if n not in entry_mod.LLM_QUERIES}
ORACLE = {n: q for n, q in entry_mod.oracle_sql().items() if n in QUERIES}


def _plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert rows and df.columns == ["attribution_model", "channel", "attribution_percent"]
    assert {r.attribution_model for r in rows} == {"first_touch", "last_touch", "markov_chain"}


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLE) == entry_mod.NO_ORACLE


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    """Also audits the plan: no cross products, no row-at-a-time Python UDFs."""
    df = QUERIES[name](spark, SF001)
    plan = _plan(df)
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert banned not in plan, f"{name}: {banned}"
    result = compare(spark, con, name, lambda *_: df, ORACLE.get(name), SF001)
    if name in ORACLE:
        assert result["rows"] == result["oracle_rows"]
        assert result["cols"] and result["exact"], result
    else:
        assert result["rows"] > 0


@pytest.mark.parametrize("name", ["user_journey", "journey_transitions", "sales_line_items", "markov_attribution"])
def test_matches_oracle_with_every_key_chunked(spark, con, name):
    """hotKeyRows=0 routes every key through the range-chunked path."""
    from pathcredit.operators.sequence import HOT_ROWS_CONF

    spark.conf.set(HOT_ROWS_CONF, "0")
    try:
        result = compare(spark, con, name, QUERIES[name], ORACLE.get(name), SF001)
    finally:
        spark.conf.unset(HOT_ROWS_CONF)
    assert result["rows"] == result["oracle_rows"] and result["exact"], result
