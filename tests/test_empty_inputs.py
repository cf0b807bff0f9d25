"""Every named query runs on empty tables (same schemas, no rows)."""

import pytest

import __spark_entry__ as entry_mod
from pathcredit.sources.tables import BASE_TABLES
from tests.conftest import SF001


@pytest.fixture(scope="module")
def empty_dir(spark):
    from pathcredit.session import work_dir

    root = work_dir(spark, "empty-tables")
    for t in BASE_TABLES:
        spark.read.parquet(f"{SF001}/{t}.parquet").limit(0).write.parquet(f"{root}/{t}.parquet")
    return root


@pytest.mark.parametrize("name", sorted(set(entry_mod.queries()) - set(entry_mod.LLM_QUERIES)))
def test_runs_on_empty_tables(spark, empty_dir, name):
    rows = entry_mod.queries()[name](spark, empty_dir).collect()
    assert isinstance(rows, list)
