"""Markov removal-effect attribution: the worked example of the reference's
text for all three methods, fixture values, and invariants."""

import pytest
from pyspark.sql import functions as F

from pathcredit.plans import journeys as J
from pathcredit.plans import markov as M
from pathcredit.sources.fixtures import load_touches
from tests.conftest import SF001, SF01

WORKED = [
    ("Start", "Facebook", 0.2),
    ("Start", "GDS", 0.8),
    ("Facebook", "Conversion", 0.8),
    ("Facebook", "Email", 0.2),
    ("Email", "Conversion", 0.1),
    ("Email", "Null", 0.9),
    ("GDS", "Conversion", 0.6),
    ("GDS", "Facebook", 0.4),
]


@pytest.fixture(scope="module")
def worked(spark):
    return spark.createDataFrame(WORKED, "start_state string, end_state string, transition_probability double")


@pytest.mark.parametrize("method", ["simple_path", "absorbing", "memo_dfs"])
def test_worked_example(worked, method):
    p = {r.removed: r.conversion_probability for r in M.conversion_probability(worked, method).collect()}
    assert p[None] == pytest.approx(0.9064, abs=1e-12)
    assert p["Facebook"] == pytest.approx(0.48, abs=1e-12)
    effects = {r.channel: r.removal_effect for r in M.removal_effects(M.conversion_probability(worked, method)).collect()}
    assert effects == {"Email": 0.01, "Facebook": 0.47, "GDS": 0.82}
    credit = {r.channel: r.attribution_percent for r in M.markov_attribution(M.removal_effects(M.conversion_probability(worked, method))).collect()}
    assert credit == {"Email": 0.01, "Facebook": 0.36, "GDS": 0.63}


def test_removal_graph_semantics(worked):
    g = M.removal_graph(worked).filter(F.col("removed") == "Facebook").collect()
    assert all(r.start_state != "Facebook" for r in g)
    redirected = [r for r in g if r.original_end_state == "Facebook"]
    assert redirected and all(r.end_state == "Null" for r in redirected)
    assert len(g) == len(WORKED) - 2  # two edges leave Facebook


@pytest.fixture(scope="module")
def edges01(spark):
    return M.edge_table(load_touches(spark, SF01))


def test_matrix_rows_sum_to_one(edges01):
    sums = M.row_sums(edges01).collect()
    assert sums and all(r.transition_probability_sum == 1.0 for r in sums)
    assert edges01.count() == 40


def test_simple_path_fixture_values(edges01):
    p = {r.removed: r.conversion_probability for r in M.simple_path_probability(edges01).collect()}
    expected = {
        None: 0.300955,
        "Affiliates": 0.213321,
        "Email": 0.212643,
        "Google Display Network": 0.214325,
        "Search Engine Marketing": 0.215461,
        "Social Network": 0.213548,
    }
    for k, v in expected.items():
        assert p[k] == pytest.approx(v, abs=5e-7)


def test_absorbing_baseline_is_conversion_rate(spark, edges01):
    p = {r.removed: r.conversion_probability for r in M.absorbing_probability(edges01).collect()}
    assert p[None] == pytest.approx(1981 / 5157, abs=1e-9)
    simple = {r.removed: r.conversion_probability for r in M.simple_path_probability(edges01).collect()}
    assert all(simple[k] <= p[k] + 1e-12 for k in p)


@pytest.mark.parametrize("sf,expected", [(SF001, 0.236934), (SF01, 0.240504)])
def test_memo_dfs_matches_reference_order(spark, sf, expected):
    p = {r.removed: r.conversion_probability for r in M.memo_dfs_probability(M.edge_table(load_touches(spark, sf))).collect()}
    assert p[None] == pytest.approx(expected, abs=5e-7)


def test_credit_unchanged_under_repartitioning(spark):
    t = load_touches(spark, SF001)
    a = sorted(M.transition_matrix(M.transitions(t)).collect())
    b = sorted(M.transition_matrix(M.transitions(t.repartition(5, "channel"))).collect())
    assert a == b


def test_no_conversions_gives_null_effects(spark):
    edges = spark.createDataFrame(
        [("Start", "A", 1.0), ("A", "Null", 1.0)], "start_state string, end_state string, transition_probability double"
    )
    effects = M.removal_effects(M.simple_path_probability(edges)).collect()
    assert [(r.channel, r.removal_effect) for r in effects] == [("A", None)]


def _random_graph(spark, channels, seed):
    import random

    rnd = random.Random(seed)
    names = [f"ch{i:02d}" for i in range(channels)]
    rows = []
    for s in ["Start", *names]:
        targets = names if s == "Start" else [*names, "Conversion", "Null"]
        w = [rnd.random() for _ in targets]
        rows += [(s, t, x / sum(w)) for t, x in zip(targets, w)]
    return spark.createDataFrame(rows, "start_state string, end_state string, transition_probability double")


def _enumerated(rows, removed=None):
    """Sum over loop-free paths, one by one."""
    out = {}
    for s, e, p in rows:
        out.setdefault(s, []).append((e, p))

    def below(state, used):
        total = 0.0
        for e, p in out.get(state, []):
            if e == "Conversion":
                total += p
            elif e != "Null" and e != removed and e not in used:
                total += p * below(e, used | {e})
        return total

    return below("Start", frozenset())


def test_merged_paths_equal_enumerated(spark):
    g = _random_graph(spark, 6, seed=4)
    rows = [tuple(r) for r in g.collect()]
    merged = {r.removed: r.conversion_probability for r in M.simple_path_probability(g).collect()}
    assert len(merged) == 7
    assert all(abs(v - _enumerated(rows, k)) < 1e-12 for k, v in merged.items())


def _recursion(rows, removed=None):
    """The memoised recursion, written as the text describes it."""
    out, memo = {}, {}
    for s, e, p in sorted(rows, key=lambda r: r[1], reverse=True):
        if s != removed:
            out.setdefault(s, []).append(("Null" if e == removed else e, p))

    def value(state, used):
        if state in ("Conversion", "Null") or state in used:
            return float(state == "Conversion")
        if state not in memo:
            memo[state] = sum(p * value(e, used | {state}) for e, p in out.get(state, []))
        return memo[state]

    return value("Start", frozenset())


@pytest.mark.parametrize("seed", [1, 2])
def test_recursion_as_joins(spark, seed):
    g = _random_graph(spark, 7, seed)
    rows = [tuple(r) for r in g.filter("transition_probability > 0.05").collect()]
    kept = spark.createDataFrame(rows, g.schema)
    p = {r.removed: r.conversion_probability for r in M.memo_dfs_probability(kept).collect()}
    assert all(abs(v - _recursion(rows, k)) < 1e-12 for k, v in p.items())


def test_thirty_channels_and_no_python(spark):
    g = _random_graph(spark, 30, seed=3)
    rows = [tuple(r) for r in g.collect()]
    p = {r.removed: r.conversion_probability for r in M.conversion_probability(g).collect()}
    assert len(p) == 31
    assert all(abs(p[k] - _recursion(rows, k)) < 1e-12 for k in (None, "ch00", "ch17"))
    a = {r.removed: r.conversion_probability for r in M.absorbing_probability(g).collect()}
    assert all(0 <= a[k] <= 1 + 1e-9 for k in a)


def test_pivot_columns_come_from_the_data(spark):
    t = load_touches(spark, SF001)
    more = t.withColumn("channel", F.when(F.col("event_id") % 7 == 0, F.lit("Podcast")).otherwise(F.col("channel")))
    pivot = M.matrix_pivot(M.edge_table(more))
    assert "Podcast" in pivot.columns and pivot.filter("start_state = 'Start'").first()["Podcast"] > 0


def test_many_channels_complete(spark):
    g = _random_graph(spark, 9, seed=5)
    p = {r.removed: r.conversion_probability for r in M.simple_path_probability(g).collect()}
    a = {r.removed: r.conversion_probability for r in M.absorbing_probability(g).collect()}
    assert len(p) == 10 and all(0 <= p[k] <= a[k] + 1e-12 for k in p)
