"""Skew-safe scans agree with plain windows, including a key that holds a
third of all rows and chunk boundaries inside ties and inside hot keys."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pathcredit.operators.sequence import dense_rank_by, neighbors, running_sum


def _skewed(spark, seed, rows=3000):
    rnd = random.Random(seed)
    data = []
    for i in range(rows):
        key = "hot" if i % 3 == 0 else f"k{rnd.randrange(200)}"
        data.append((key, rnd.randrange(50), i, rnd.choice("abcde"), rnd.randrange(2)))
    rnd.shuffle(data)
    return spark.createDataFrame(data, "key string, t int, id int, v string, flag int")


@pytest.mark.parametrize("chunks,hot_rows", [(1, 0), (7, 0), (16, 0), (None, 50), (None, None)])
def test_against_windows(spark, chunks, hot_rows):
    """hot_rows=0: every key chunked; 50: 'hot' routed to chunks, the rest to
    plain windows; None: default threshold, nothing is hot at this size."""
    df = _skewed(spark, seed=chunks or 5)
    w = Window.partitionBy("key").orderBy("t", "id")
    expected = df.select(
        "id",
        F.lag("v").over(w).alias("p"),
        F.lead("v").over(w).alias("n"),
        F.coalesce(F.sum("flag").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("rs"),
        F.sum("flag").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("rsi"),
        F.dense_rank().over(Window.partitionBy("key").orderBy("t")).alias("dr"),
    )
    kw = dict(n_chunks=chunks, hot_rows=hot_rows)
    got = neighbors(df, ["key"], ["t", "id"], ["v"], **kw)
    got = running_sum(got, ["key"], ["t", "id"], "flag", "rs", inclusive=False, **kw)
    got = running_sum(got, ["key"], ["t", "id"], "flag", "rsi", inclusive=True, **kw)
    got = dense_rank_by(got, ["key"], "t", ["id"], "dr", **kw)
    got = got.select("id", F.col("prev.v").alias("p"), F.col("next.v").alias("n"), "rs", "rsi", "dr")
    assert sorted(got.collect()) == sorted(expected.collect())


def test_hot_key_is_split_across_chunks(spark):
    df = _skewed(spark, seed=3)
    ranged = df.repartitionByRange(8, "key", "t", "id").withColumn("c", F.spark_partition_id())
    chunks_of_hot = ranged.filter(F.col("key") == "hot").select("c").distinct().count()
    assert chunks_of_hot >= 3


def test_null_keys_form_one_group(spark):
    rows = [(None, t, 1) for t in range(40)] + [("a", 1, 1)]
    df = spark.createDataFrame(rows, "key string, t int, flag int")
    out = running_sum(df, ["key"], ["t"], "flag", "rs", inclusive=True, n_chunks=4, hot_rows=0)
    got = {(r.key or "", r.t): r.rs for r in out.collect()}
    assert got[("", 39)] == 40 and got[("a", 1)] == 1
    assert all(got[("", t)] == t + 1 for t in range(40))


def test_hot_list_is_bounded_and_exact(spark):
    from pathcredit.operators.sequence import split_hot

    df = _skewed(spark, seed=9)
    ordinary, hot, n = split_hot(df, ["key"], hot_rows=50)
    assert {r.key for r in hot.select("key").distinct().collect()} == {"hot"}
    assert ordinary.count() + hot.count() == df.count() and n >= 2
    none_hot, nothing, _ = split_hot(df, ["key"], hot_rows=10**9)
    assert nothing is None and none_hot.count() == df.count()


def test_hot_null_key(spark):
    rows = [(None, t, 1) for t in range(300)] + [(f"k{i}", 1, 1) for i in range(20)]
    df = spark.createDataFrame(rows, "key string, t int, flag int")
    out = running_sum(df, ["key"], ["t"], "flag", "rs", hot_rows=50)
    got = {(r.key or "", r.t): r.rs for r in out.collect()}
    assert got[("", 299)] == 300 and got[("k3", 1)] == 1


def test_single_key_holds_everything(spark):
    df = spark.range(3000).select(
        F.lit("k").alias("key"), (F.col("id") % 97).alias("t"), F.col("id").alias("id"), (F.col("id") % 2).cast("int").alias("flag")
    )
    w = Window.partitionBy("key").orderBy("t", "id")
    expected = df.select("id", F.lag("id").over(w).alias("p"), F.sum("flag").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("rs"))
    got = running_sum(neighbors(df, ["key"], ["t", "id"], ["id"], hot_rows=100), ["key"], ["t", "id"], "flag", "rs", hot_rows=100)
    got = got.select("id", F.col("prev.id").alias("p"), "rs")
    assert sorted(got.collect()) == sorted(expected.collect())
