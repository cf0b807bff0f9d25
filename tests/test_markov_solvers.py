"""Removal effects of random chains against plain linear algebra and enumeration;
path text against neighbouring rows."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pathcredit.plans import journeys as J
from pathcredit.plans import markov as M


def chain(seed, channels):
    """Edges of a random chain with loops; every state can leave."""
    rng = random.Random(seed)
    names = [f"c{i}" for i in range(channels)]
    edges = []
    for s in ["Start", *names]:
        ends = rng.sample(names, rng.randint(1, channels)) + rng.sample(["Conversion", "Null"], 1 if s == "Start" else rng.randint(1, 2))
        weight = [rng.randint(1, 9) for _ in ends]
        edges += [(s, e, w / sum(weight)) for e, w in zip(ends, weight)]
    return edges


def absorbed(edges, removed):
    states = sorted({s for s, _, _ in edges})
    a, b = np.eye(len(states)), np.zeros(len(states))
    for s, e, p in edges:
        if s == removed or e == removed:
            continue
        if e == "Conversion":
            b[states.index(s)] += p
        elif e in states:
            a[states.index(s), states.index(e)] -= p
    return np.linalg.solve(a, b)[states.index("Start")]


def walked(edges, removed):
    p = {(s, e): q for s, e, q in edges}
    names = [s for s in {s for s, _, _ in edges} if s not in ("Start", removed)]
    total = 0.0
    for n in range(len(names) + 1):
        for path in itertools.permutations(names, n):
            full = ["Start", *path, "Conversion"]
            total += np.prod([p.get(x, 0.0) for x in zip(full, full[1:])])
    return total


SCHEMA = "start_state string, end_state string, transition_probability double"


@pytest.mark.parametrize("seed, channels", [(1, 2), (2, 5), (3, 12)])
def test_absorbing_by_one_elimination(spark, seed, channels):
    edges = chain(seed, channels)
    got = {r.removed: r.conversion_probability for r in M.absorbing_probability(spark.createDataFrame(edges, SCHEMA)).collect()}
    assert set(got) == {None, *(s for s, _, _ in edges if s != "Start")}
    assert all(abs(v - absorbed(edges, r)) < 1e-9 for r, v in got.items())


def test_absorbing_odd_chains(spark):
    def run(edges):
        return {r.removed: r.conversion_probability for r in M.absorbing_probability(spark.createDataFrame(edges, SCHEMA)).collect()}

    assert run([("Start", "Conversion", 0.5), ("Start", "Null", 0.5)]) == {None: 0.5}
    assert run([("Start", "a", 0.5), ("Start", "Conversion", 0.5), ("a", "a", 1.0)]) == {None: 0.5, "a": 0.5}  # a never leaves
    assert run([]) == {}


@pytest.mark.parametrize("seed, channels", [(4, 3), (5, 6)])
def test_recursive_and_merged_paths_agree(spark, seed, channels):
    edges = chain(seed, channels)
    matrix = spark.createDataFrame(edges, SCHEMA).checkpoint()
    got = {r.removed: r.conversion_probability for r in M.simple_path_probability(matrix).collect()}
    assert all(abs(v - walked(edges, r)) < 1e-9 for r, v in got.items())
    sums = [
        {tuple(sorted(r.channels)): r.p for r in paths.groupBy(F.array_sort("channels").alias("channels")).agg(F.sum("prob").alias("p")).collect()}
        for paths in (M.listed_paths(matrix), M.merged_paths(matrix, channels))
    ]
    assert sums[0].keys() == sums[1].keys() and all(abs(sums[0][k] - sums[1][k]) < 1e-12 for k in sums[0])


def test_path_text_and_neighbours_agree(spark):
    """Also over journeys that are cut into several rows."""
    rng = random.Random(8)
    rows = [(f"u{u}", t, i, rng.choice(["A", "B", "C"]), 0) for u in range(30) for i, t in enumerate(range(rng.randint(1, 12)))]
    touches = spark.createDataFrame(rows, "uid string, time int, event_id int, channel string, conversion int")
    expected = sorted(map(tuple, M.transitions(touches).groupBy("start_state", "end_state").agg(F.sum("cnt")).collect()))
    for cut in (1, 4, 1000):
        got = sorted(map(tuple, M.path_transitions(J.user_journeys(touches, segment_touches=cut)).collect()))
        assert got == expected
