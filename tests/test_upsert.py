"""Keyed upsert (MERGE) semantics, audit counts, snapshots, clustering."""

import pytest
from pyspark.sql import functions as F

from pathcredit.operators import layout, upsert

SCHEMA = "k int, v string"


def _rows(df):
    return sorted(((r.k, r.v) for r in df.collect()), key=lambda x: (x[0] is None, x[0] or 0, x[1]))


def test_merge_golden(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], SCHEMA)
    source = spark.createDataFrame([(2, "B"), (3, "C"), (None, "D")], SCHEMA)
    out = upsert.merge(target, source, ["k"])
    assert _rows(out) == [(1, "a"), (2, "B"), (3, "C"), (None, "D"), (None, "c")]


def test_duplicate_match_raises(spark):
    target = spark.createDataFrame([(2, "b")], SCHEMA)
    source = spark.createDataFrame([(2, "x"), (2, "y")], SCHEMA)
    with pytest.raises(upsert.DuplicateSourceKeyError):
        upsert.merge(target, source, ["k"])


def test_duplicate_unmatched_is_inserted(spark):
    target = spark.createDataFrame([(1, "a")], SCHEMA)
    source = spark.createDataFrame([(5, "x"), (5, "y")], SCHEMA)
    assert len(_rows(upsert.merge(target, source, ["k"]))) == 3


def test_upsert_idempotent(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA)
    source = spark.createDataFrame([(2, "B"), (3, "C")], SCHEMA)
    once = upsert.merge(target, source, ["k"])
    twice = upsert.merge(once, source, ["k"])
    assert _rows(once) == _rows(twice)


def test_audit(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], SCHEMA)
    source = spark.createDataFrame([(2, "B"), (3, "C"), (None, "D")], SCHEMA)
    row = upsert.audit(target, source, ["k"], "t").first()
    assert (row.rows_inserted, row.rows_updated, row.rows_kept) == (2, 1, 2)


def test_clustered_layout(spark, scratch):
    df = spark.range(1000).select(F.format_string("u%04d", (F.col("id") * 7919) % 1000).alias("uid"))
    layout.write_clustered(df, "uid", scratch, files=4)
    back = spark.read.parquet(scratch).withColumn("f", F.input_file_name())
    ranges = back.groupBy("f").agg(F.min("uid").alias("lo"), F.max("uid").alias("hi")).orderBy("lo").collect()
    assert len(ranges) >= 2
    assert all(a.hi < b.lo for a, b in zip(ranges, ranges[1:]))  # disjoint key ranges per file


def test_bucketed_target_is_not_shuffled(spark, scratch):
    """A target table bucketed on the key: an upsert shuffles its source alone."""
    import contextlib
    import io
    import os

    name = "bucketed_" + os.urandom(4).hex()
    spark.range(200).selectExpr("CAST(id AS INT) AS k", "CAST(id AS STRING) AS v").write.bucketBy(4, "k").sortBy("k").option("path", scratch).saveAsTable(name)
    source = spark.createDataFrame([(5, "x"), (500, "y")], SCHEMA)
    merged = upsert.merge(spark.table(name), source, ["k"], check=False)
    out = io.StringIO()
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    saved = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:  # the sort-merge case: a small source would just be broadcast
            spark.conf.set(k, "-1")
        with contextlib.redirect_stdout(out):
            merged.explain()
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    plan = out.getvalue()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    # exactly one exchange: the source hashed to the target's buckets
    assert plan.count("Exchange hashpartitioning") == 1
    assert _rows(merged.filter("k IN (5, 500, 7)")) == [(5, "x"), (7, "7"), (500, "y")]
    spark.sql(f"DROP TABLE {name}")


def test_audit_counts_rows(spark):
    target = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], SCHEMA)
    source = spark.createDataFrame([(1, "x"), (3, "y"), (3, "z"), (None, "w")], SCHEMA)
    row = upsert.audit(target, source, ["k"], "t").first()
    assert (row.rows_inserted, row.rows_updated, row.rows_kept) == (3, 1, 2)
