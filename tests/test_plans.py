"""Plan checks: filters and column pruning reach the parquet scans; top-k
plans as TakeOrderedAndProject.  (Every named query is also audited for cross
products and row UDFs in test_entry_oracle.py.)"""

import contextlib
import io

from pathcredit.named import QUERIES
from pathcredit.sources import fixtures as X
from pathcredit.sources.tables import Tables
from tests.conftest import SF001


def _plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_pushdown_and_pruning(spark):
    plan = _plan(QUERIES["conversions_by_date"](spark, SF001))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,purchase)]" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in plan
    plan = _plan(QUERIES["top_referrers"](spark, SF001))  # over the published dataset
    assert "TakeOrderedAndProject" in plan
    assert "EqualTo(current_page_title,Brand#2)" in plan
    t = Tables(spark, SF001)
    plan = _plan(X.clickstream_raw(t.lineitem, t.part, t.supplier))
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint>" in plan


def test_heuristic_credit_reads_touches_once(spark):
    """Both credits and the denominators come from one checkpointed count."""
    plan = _plan(QUERIES["gold_attribution"](spark, SF001))
    assert "events.parquet" not in plan and "hashpartitioning(uid" not in plan
    plan = _plan(QUERIES["cpa_summary"](spark, SF001))
    assert "hashpartitioning(uid" not in plan


def test_one_shuffle_per_ordered_scan_without_hot_keys(spark):
    plan = _plan(QUERIES["journey_transitions"](spark, SF001))
    assert plan.count("hashpartitioning(uid") == 1
    assert "rangepartitioning" not in plan
    # the scan reads only the columns the window needs
    assert "ReadSchema: struct<uid:string,time:timestamp_ntz,channel:string,conversion:int,event_id:bigint>" in plan
