"""Catalog tables (create once, replace, typed and empty, parametrised insert) and
append-only keyed tables."""

import glob
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pathcredit.operators import catalog, upsert
from pathcredit.operators.keyed import KeyedTable
from pathcredit.session import work_dir
from pathcredit.sources import fixtures as X


@pytest.fixture()
def name(spark):
    n = "t_" + os.urandom(4).hex()
    yield n
    spark.sql(f"DROP TABLE IF EXISTS {n}")


def _rows(df):
    return sorted(((r.k, r.v) for r in df.collect()), key=repr)


def test_create_once_then_replace(spark, name, scratch):
    assert catalog.create_table_as(spark, name, lambda: spark.sql("SELECT 1 AS k, 'a' AS v"), scratch, "first's comment")
    assert not catalog.create_table_as(spark, name, lambda: pytest.fail("a second creation reads nothing"), scratch)
    assert _rows(spark.table(name)) == [(1, "a")] and catalog.table_comment(spark, name) == "first's comment"
    catalog.replace_table_as(spark, name, spark.table(name).selectExpr("k + 1 AS k", "v"))
    assert _rows(spark.table(name)) == [(2, "a")] and catalog.table_comment(spark, name) == "first's comment"
    assert _rows(spark.read.parquet(scratch)) == [(2, "a")]


def test_create_after_a_failed_try(spark, name, scratch):
    bad = spark.range(10).select(F.when(F.col("id") == 7, F.raise_error(F.lit("no"))).otherwise(F.col("id").cast("string")).alias("v"), F.col("id").alias("k"))
    with pytest.raises(Exception, match="no"):
        catalog.create_table_as(spark, name, lambda: bad, scratch)
    assert not spark.catalog.tableExists(name) and not catalog.register_table(spark, name, scratch)
    assert catalog.create_table_as(spark, name, lambda: spark.sql("SELECT 3 AS k, 'c' AS v"), scratch)
    assert _rows(spark.table(name)) == [(3, "c")]


def test_register_what_another_session_wrote(spark, name, scratch):
    spark.sql("SELECT 1 AS k, 'a' AS v").write.parquet(scratch)
    assert catalog.register_table(spark, name, scratch, "again") and _rows(spark.table(name)) == [(1, "a")]
    assert catalog.table_comment(spark, name) == "again"


def test_empty_table_and_parametrised_insert(spark, name, scratch):
    table = X.spend_table(spark, name, scratch)
    assert spark.table(name).count() == 0
    kinds = {f.name: f.dataType.simpleString() for f in spark.table(table).schema}
    assert kinds == {"campaign_id": "string", "total_spend_in_dollars": "float", "channel_spend": "map<string,float>", "campaign_start_date": "timestamp"}
    for spend in (10000, 10000, 2500):  # a rerun keeps one row; a new budget replaces it
        X.insert_campaign(spark, name, spend)
        row = spark.table(name).collect()
        assert len(row) == 1 and row[0].total_spend_in_dollars == spend and abs(row[0].channel_spend["Email"] - 0.2) < 1e-6
    X.insert_campaign(spark, name, 70, campaign="other's")
    assert sorted(r.total_spend_in_dollars for r in spark.table(name).collect()) == [70, 2500]
    assert X.spend_table(spark, name, scratch) == name and spark.table(name).count() == 2


SCHEMA = "k int, v string"


def test_upsert_writes_its_source_alone(spark, scratch):
    table = KeyedTable(spark, scratch, ["k"], SCHEMA)
    table.append(spark.range(1000).selectExpr("CAST(id AS INT) AS k", "'old' AS v"), 0)
    before = {f: os.path.getmtime(f) for f in glob.glob(f"{scratch.removeprefix('file:')}/version=*/*")}
    table.append(spark.createDataFrame([(5, "new"), (2000, "more")], SCHEMA), 1)
    after = {f: os.path.getmtime(f) for f in glob.glob(f"{scratch.removeprefix('file:')}/version=*/*")}
    assert all(after[f] == t for f, t in before.items())
    assert spark.read.parquet(f"{scratch}/version=1").count() == 2
    assert table.read().count() == 1001 and _rows(table.read().filter("k IN (5, 6, 2000)")) == [(2000, "more"), (5, "new"), (6, "old")]
    small = table.compact(scratch + "-small", 7)
    assert small.read().count() == 1001 and spark.read.parquet(scratch + "-small").count() == 1001


def test_killed_upsert_runs_again(spark, scratch):
    """Half of the batch's files are gone, as after a crash: nothing else is lost, and the
    same batch again makes it whole."""
    table = KeyedTable(spark, scratch, ["k"], SCHEMA, buckets=4)
    table.append(spark.range(100).selectExpr("CAST(id AS INT) AS k", "'old' AS v"), 0)
    source = spark.range(50, 150).selectExpr("CAST(id AS INT) AS k", "'new' AS v")
    table.append(source, 1)
    expected = _rows(table.read())
    files = sorted(glob.glob(f"{scratch.removeprefix('file:')}/version=1/bucket=*/*.parquet"))
    for f in files[::2]:
        os.remove(f)
    assert {k for k, v in _rows(table.read())} >= set(range(100))
    table.append(source, 1)
    assert _rows(table.read()) == expected and len(expected) == 150


def test_rows_of_a_key_move_together(spark, scratch):
    table = KeyedTable(spark, scratch, ["k"], SCHEMA, buckets=3)
    table.append(spark.createDataFrame([(1, "a"), (1, "b"), (1, "c"), (2, "d"), (None, "x")], SCHEMA), 0)
    table.append(spark.createDataFrame([(1, "z"), (None, "y")], SCHEMA), 1)
    assert _rows(table.read()) == sorted([(1, "z"), (2, "d"), (None, "x"), (None, "y")], key=repr)
    assert _rows(table.read(buckets=[0, 1, 2])) == _rows(table.read())
    with pytest.raises(upsert.DuplicateSourceKeyError):
        table.append(spark.createDataFrame([(2, "x"), (2, "y")], SCHEMA), 2, check=True)


batch = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 5)), st.text(alphabet="ab", min_size=1, max_size=2)), max_size=5, unique_by=lambda r: r[0])


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batches=st.lists(batch, min_size=1, max_size=4))
def test_batches_equal_merges(spark, batches):
    table, model = KeyedTable(spark, work_dir(spark, "keyed"), ["k"], SCHEMA), []
    for version, rows in enumerate(batches):
        table.append(spark.createDataFrame(rows, SCHEMA), version)
        keys = {k for k, _ in rows if k is not None}
        model = [r for r in model if r[0] not in keys] + rows
    assert _rows(table.read()) == sorted(model, key=repr)
