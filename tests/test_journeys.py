"""User journeys and heuristic credit: golden hand journeys (ties,
single-step, self-transition) and the sf0.01 touch fixture counts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pathcredit.plans import attribution as A
from pathcredit.plans import journeys as J
from pathcredit.plans import markov as M
from pathcredit.sources.fixtures import load_touches
from tests.conftest import SF001, SF01


def _t(h):
    return dt.datetime(2024, 1, 1, h, 0, 0)


@pytest.fixture(scope="module")
def hand(spark):
    rows = [
        ("a", _t(10), "impression", "Email", 0, 1),
        ("a", _t(11), "impression", "Affiliates", 0, 2),
        ("a", _t(12), "conversion", "Email", 1, 3),
        ("b", _t(10), "impression", "Affiliates", 0, 1),
        ("c", _t(10), "impression", "Email", 0, 5),
        ("c", _t(10), "impression", "Affiliates", 0, 4),
        ("d", _t(10), "conversion", "Email", 1, 1),
        ("e", _t(10), "impression", "Email", 0, 1),
        ("e", _t(11), "impression", "Email", 0, 2),
    ]
    schema = "uid string, time timestamp_ntz, interaction string, channel string, conversion int, event_id long"
    return spark.createDataFrame(rows, schema).repartition(3)


def test_hand_journeys(hand):
    got = {r.uid: r for r in J.user_journeys(hand).collect()}
    assert got["a"].path == "Start > Email > Affiliates > Email > Conversion"
    assert got["a"].visiting_order == [1, 2, 3]
    assert got["b"].path == "Start > Affiliates > Null"
    assert got["b"].first_interaction == got["b"].last_interaction == "Affiliates"
    assert got["c"].path == "Start > Affiliates > Email > Null"  # tie broken by event_id
    assert got["c"].visiting_order == [1, 1]
    assert got["d"].path == "Start > Email > Conversion"
    assert got["e"].path == "Start > Email > Email > Null"


def test_hand_credit(hand):
    summary = J.journey_summary(hand)
    first = {r.channel: r.attribution_percent for r in A.first_touch(summary).collect()}
    last = {r.channel: r.attribution_percent for r in A.last_touch(summary).collect()}
    assert first == {"Email": 1.0} and last == {"Email": 1.0}


def test_hand_transitions(hand):
    tr = M.transitions(hand)
    assert tr.count() == 14  # 9 touches + 5 journeys
    pairs = {(r.start_state, r.end_state) for r in tr.collect()}
    assert ("Email", "Email") in pairs and ("Start", "Affiliates") in pairs


def test_order_independent_of_input_partitioning(spark, hand):
    a = sorted(J.render_journeys(J.user_journeys(hand)).collect())
    b = sorted(J.render_journeys(J.user_journeys(hand.repartition(7, "channel"))).collect())
    assert a == b


@pytest.mark.parametrize(
    "sf,touches,journeys,converting",
    [(SF001, 1000, 520, 202), (SF01, 10000, 5157, 1981)],
)
def test_fixture_counts(spark, sf, touches, journeys, converting):
    t = load_touches(spark, sf)
    s = J.journey_summary(t)
    assert t.count() == touches
    assert s.count() == journeys
    assert s.filter("conversion = 1").count() == converting
    # a purchase always closes its journey
    assert s.filter("conversion = 1").count() == t.filter("conversion = 1").count()


def test_first_last_counts_sf001(spark):
    s = J.journey_summary(load_touches(spark, SF001)).filter("conversion = 1")
    first = {r[0]: r[1] for r in s.groupBy("first_interaction").count().collect()}
    last = {r[0]: r[1] for r in s.groupBy("last_interaction").count().collect()}
    assert first == {"Affiliates": 36, "Email": 37, "Google Display Network": 40, "Search Engine Marketing": 44, "Social Network": 45}
    assert last == {"Affiliates": 35, "Email": 35, "Google Display Network": 36, "Search Engine Marketing": 42, "Social Network": 54}


def test_linear_and_decay_sum_to_one(spark):
    t = load_touches(spark, SF001)
    for df in (A.linear_touch(t), A.time_decay(t)):
        total = df.agg(F.sum("attribution_percent")).first()[0]
        assert abs(total - 1.0) < 1e-5


def test_hot_journey_is_segmented_not_truncated(spark):
    rows = [("hot", dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i), "impression", ["Email", "Affiliates"][i % 2], 0, i) for i in range(250)]
    rows[-1] = ("hot", rows[-1][1], "conversion", "Email", 1, 249)
    rows += [("x", _t(9), "impression", "Email", 0, 1000), ("x", _t(10), "conversion", "Affiliates", 1, 1001)]
    schema = "uid string, time timestamp_ntz, interaction string, channel string, conversion int, event_id long"
    df = spark.createDataFrame(rows, schema)
    out = J.user_journeys(df, hot_rows=40, segment_touches=40).orderBy("uid", "segment").collect()
    hot = [r for r in out if r.uid == "hot"]
    assert [r.segment for r in hot] == list(range(7))  # 250 touches / 40 per segment
    assert all(len(r.visiting_order) <= 40 for r in hot)
    full = " > ".join(r.path for r in hot)
    expected = "Start > " + " > ".join(r[3] for r in rows[:250]) + " > Conversion"
    assert full == expected
    assert [v for r in hot for v in r.visiting_order] == list(range(1, 251))
    assert {(r.first_interaction, r.last_interaction, r.conversion) for r in hot} == {("Email", "Email", 1)}
    x = [r for r in out if r.uid == "x"]
    assert len(x) == 1 and x[0].path == "Start > Email > Affiliates > Conversion" and x[0].segment == 0


def _one_journey(n):
    return [("long", dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i), "impression", ["Email", "Affiliates"][i % 2], 0, i) for i in range(n)]


def test_segments_do_not_depend_on_other_rows_or_partitions(spark):
    """The same journey gives the same rows alone, among strangers, and under any
    partition count or routing."""
    schema = "uid string, time timestamp_ntz, interaction string, channel string, conversion int, event_id long"
    rows = _one_journey(250)
    others = [(f"u{i % 1700}", _t(i % 24), "impression", "Email", 0, 1000 + i) for i in range(5000)]
    expected, before = None, spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in (3, 64):
            spark.conf.set("spark.sql.shuffle.partitions", str(parts))
            for table in (rows, rows + others):
                for hot_rows in (0, 40, None):
                    df = spark.createDataFrame(table, schema)
                    got = J.user_journeys(df, hot_rows=hot_rows, segment_touches=40).filter("uid = 'long'")
                    found = sorted(map(tuple, J.render_journeys(got).collect()))
                    expected = expected or found
                    assert found == expected and len(found) == 7
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_no_task_holds_a_hot_journey(spark):
    """Half of all touches on one uid: its rows come out of many tasks."""
    n = 40_000
    df = spark.range(n).selectExpr(
        "CASE WHEN id % 2 = 0 THEN 'hot' ELSE concat('u', id) END AS uid",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) AS time",
        "'Email' AS channel", "0 AS conversion", "id AS event_id",
    )
    merging = "spark.sql.adaptive.coalescePartitions.enabled"  # would put these few rows into one task
    before = spark.conf.get(merging)
    spark.conf.set(merging, "false")
    try:
        out = J.user_journeys(df, hot_rows=1000, segment_touches=500).withColumn("task", F.spark_partition_id())
        per_task = out.filter("uid = 'hot'").groupBy("task").agg(F.sum(F.size("visiting_order")).alias("n")).collect()
    finally:
        spark.conf.set(merging, before)
    assert sum(r.n for r in per_task) == n // 2
    assert max(r.n for r in per_task) <= n // 4


def test_credit_from_counts_equals_credit_from_journeys(spark):
    s = J.journey_summary(load_touches(spark, SF001))
    counts = A.outcomes(s)
    for f in (A.first_touch, A.last_touch, A.gold_attribution):
        assert sorted(map(tuple, f(counts).collect())) == sorted(map(tuple, f(s).collect()))


def test_decay_aggregates_before_the_uid_meets(spark):
    """No join, and the window over the uid sits on pre-aggregated rows."""
    plan = A.time_decay(load_touches(spark, SF001))._jdf.queryExecution().executedPlan().toString()
    tail = plan[plan.index("Window [max(last"):]
    assert "Join" not in plan.split("seq#")[0] and "HashAggregate" in tail or "SortAggregate" in tail
