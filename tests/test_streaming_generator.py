"""One-shot streaming ingest (exactly-once files, rerun adds nothing, equals
batch) and the distributed generator's rules."""

import contextlib
import glob
import io
import os
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pathcredit.plans import journeys as J
from pathcredit.plans import markov as M
from pathcredit.plans import refresh as R
from pathcredit.plans.generator import generate_touches, generator_profile
from pathcredit.sources import fixtures as X
from pathcredit.sources.files import read_raw_touches, typed_touches, write_raw_touches
from pathcredit.operators.keyed import KeyedTable
from pathcredit.schemas import USER_JOURNEY
from pathcredit.sources.files import TOUCH_EXPECTATIONS
from pathcredit.streaming.ingest import ingest_and_refresh, ingest_checked, ingest_once, refresh_journeys_batch, with_event_id
from pathcredit.session import work_dir
from tests.conftest import SF001


def test_stream_ingest_exactly_once(spark, scratch):
    raw = X.raw_touch_text(X.load_touches(spark, SF001))
    part_a = raw.filter(F.col("time") < "2024-01-10")
    part_b = raw.filter((F.col("time") >= "2024-01-10") & (F.col("time") < "2024-01-20"))
    part_c = raw.filter(F.col("time") >= "2024-01-20")
    landing, table, ckpt = f"{scratch}/landing", f"{scratch}/bronze", f"{scratch}/_ckpt"
    write_raw_touches(part_a, f"{landing}/a", files=1)
    write_raw_touches(part_b, f"{landing}/b", files=1)
    src = f"{landing}/*"
    first = ingest_once(spark, src, table, ckpt)
    assert first == part_a.count() + part_b.count()
    assert ingest_once(spark, src, table, ckpt) == 0  # rerun adds nothing
    write_raw_touches(part_c, f"{landing}/c", files=1)
    assert ingest_once(spark, src, table, ckpt) == part_c.count()
    streamed = spark.read.parquet(table)
    batch = typed_touches(read_raw_touches(spark, src))
    assert streamed.count() == raw.count()
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_generator_rules(spark):
    g = generate_touches(spark, 20000, seed=7)
    p = generator_profile(g).first()
    assert p.users == 20000
    assert 1 <= p.min_steps and p.max_steps <= 9
    assert abs(p.conversion_share - 0.14) < 0.015
    w = Window.partitionBy("uid").orderBy("step")
    assert g.withColumn("p", F.lag("time").over(w)).filter("time < p").count() == 0
    last = g.withColumn("m", F.max("step").over(Window.partitionBy("uid")))
    assert last.filter("conversion = 1 AND step != m").count() == 0
    assert last.filter("interaction = 'conversion' AND conversion != 1").count() == 0


def test_generator_deterministic_across_partitions(spark):
    a = generate_touches(spark, 3000, seed=11, partitions=2)
    b = generate_touches(spark, 3000, seed=11, partitions=9)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_generated_data_through_attribution(spark):
    g = generate_touches(spark, 5000, seed=3).withColumnRenamed("step", "event_id")
    edges = M.edge_table(g)
    sums = M.row_sums(edges).collect()
    assert all(r.transition_probability_sum == 1.0 for r in sums)
    summary = J.journey_summary(g)
    rate = summary.filter("conversion = 1").count() / summary.count()
    absorbing = {r.removed: r.conversion_probability for r in M.absorbing_probability(edges).collect()}
    assert abs(absorbing[None] - rate) < 1e-9


def _journeys_table(spark, root):
    return KeyedTable(spark, f"{root}/journeys", ["uid"], USER_JOURNEY, 4)


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_stream_keeps_journeys_current(spark, scratch):
    """Two batches, the second by a stream and a table object of their own (a
    restart); a third start finds nothing new."""
    raw = X.raw_touch_text(X.load_touches(spark, SF001))
    landing = f"{scratch}/landing"
    expected = _rows(J.render_journeys(J.user_journeys(with_event_id(typed_touches(raw)))))
    for name, part in [("a", F.col("time") < "2024-01-15"), ("b", F.col("time") >= "2024-01-15"), (None, None)]:
        if name:
            write_raw_touches(raw.filter(part), f"{landing}/{name}", files=1)
        table = _journeys_table(spark, scratch)
        ingest_and_refresh(spark, f"{landing}/*", f"{scratch}/bronze", table, f"{scratch}/_ckpt", max_files_per_trigger=1)
    assert len(expected) == 520
    assert _rows(J.render_journeys(_journeys_table(spark, scratch).read())) == expected


def test_replayed_epoch_changes_nothing(spark, scratch):
    batch = typed_touches(X.raw_touch_text(X.load_touches(spark, SF001))).limit(200).cache()
    handle = refresh_journeys_batch(spark, f"{scratch}/bronze", _journeys_table(spark, scratch), buckets=4)
    handle(batch, 0)
    once = _rows(_journeys_table(spark, scratch).read().withColumn("visiting_order", F.col("visiting_order").cast("string")))
    handle(batch, 0)
    assert spark.read.parquet(f"{scratch}/bronze").count() == 200
    assert _rows(_journeys_table(spark, scratch).read().withColumn("visiting_order", F.col("visiting_order").cast("string"))) == once
    handle(batch.limit(0), 1)
    assert spark.read.parquet(f"{scratch}/bronze").count() == 200


GOOD = "u1-20240101-0,2024-01-01 10:00:00,impression,Email,0"


def _land(spark, landing, name, lines):
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(f"{landing}/{name}")


def _ingest(spark, scratch):
    ingest_checked(spark, f"{scratch}/landing/*", f"{scratch}/out", "touches", TOUCH_EXPECTATIONS, max_files_per_trigger=1, header=False)


def test_bad_file_stops_the_stream_unpublished(spark, scratch):
    """Malformed lines are set aside; a line that breaks an expectation stops the stream
    before its batch is published; the counts of what was published are stored."""
    landing = f"{scratch}/landing"
    _land(spark, landing, "a", [GOOD, "u2-20240101-0,2024-01-01", GOOD + ",more", ""])
    _ingest(spark, scratch)
    assert spark.read.parquet(f"{scratch}/out/bronze").count() == 1
    assert sorted(r.record for r in spark.read.parquet(f"{scratch}/out/quarantine").collect()) == sorted([GOOD + ",more", "u2-20240101-0,2024-01-01"])
    _land(spark, landing, "b", [GOOD, "u3-20240101-0,not a time,impression,Email,0"])
    with pytest.raises(Exception, match="valid_time"):
        _ingest(spark, scratch)
    assert spark.read.parquet(f"{scratch}/out/bronze").count() == 1
    counts = {(r.epoch, r.expectation): (r.passed, r.failed) for r in spark.read.parquet(f"{scratch}/out/counts").collect()}
    assert counts == {(0, e.name): (1, 0) for e in TOUCH_EXPECTATIONS}
    # the file is mended in place; the same batch runs again and lands once
    for f in glob.glob(f"{landing.removeprefix('file:')}/b/*.txt"):
        with open(f, "w") as out:
            out.write(GOOD + "\n")
        crc = os.path.join(os.path.dirname(f), "." + os.path.basename(f) + ".crc")
        if os.path.exists(crc):
            os.remove(crc)
    _ingest(spark, scratch)
    _ingest(spark, scratch)
    assert spark.read.parquet(f"{scratch}/out/bronze").count() == 2


def test_refresh_of_changed_journeys_equals_a_rebuild(spark):
    """Random deliveries: counts by retraction against counts of everything, and the same
    delivery again."""
    rng = random.Random(12)

    def touches(uids, seed):
        r = random.Random(seed)
        return spark.createDataFrame([(f"u{u}", t, t, r.choice(["A", "B", "C"]), r.randint(0, 1)) for u in uids for t in range(r.randint(1, 5))], "uid string, time int, event_id int, channel string, conversion int")

    state = KeyedTable(spark, work_dir(spark, "refresh-test"), ["uid"], USER_JOURNEY, 8)
    state.append(J.user_journeys(touches(range(40), 0), segment_touches=3), 0)
    counts = M.path_transitions(state.read()).checkpoint()
    for version in (1, 2, 3):
        source = J.user_journeys(touches(rng.sample(range(60), 6), version), segment_touches=3)
        again = R.refreshed(state, source, version, counts, M.path_transitions, "total_transitions")
        counts = R.refreshed(state, source, version, counts, M.path_transitions, "total_transitions")
        assert _rows(again) == _rows(counts) == _rows(M.path_transitions(state.read()))


def test_refresh_opens_the_touched_folders_alone(spark):
    state = KeyedTable(spark, work_dir(spark, "refresh-plan"), ["uid"], "uid string, v int", 16)
    state.append(spark.range(500).selectExpr("CAST(id AS STRING) AS uid", "1 AS v"), 0)
    source = spark.createDataFrame([("7", 2)], "uid string, v int")
    old = R.stored_rows_of(state, source)
    assert _rows(old) == [("7", 1)]
    bucket = source.select(state.bucket()).first()[0]
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        old.explain("formatted")
    filters = [line for line in out.getvalue().splitlines() if line.startswith("PartitionFilters")]
    assert filters and all(f"= {bucket})" in f for f in filters)
