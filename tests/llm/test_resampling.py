import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from pathcredit.llm import resampling


def brute(rows, target):
    def features(text):
        w = [x for x in re.split(r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
        return len(w), [" ".join(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]

    def bucket(f):
        return zlib.crc32(f.encode()) % 10000

    rows = [(i, *features(t)) for i, t in rows if i is not None]
    s, t = Counter(bucket(f) for *_, fs in rows for f in fs), Counter(bucket(f) for x in target for f in features(x)[1])
    S, T = sum(s.values()), sum(t.values())
    out = []
    for i, n, fs in rows:
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in map(bucket, fs))
        h = int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n >= 20))
    able = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0], r[1], r[2]))
    place = {}
    for rank, r in enumerate(able[: 5 * len(able) // 100], 1):
        place.setdefault(r[:4], []).append(rank)
    return sorted((*r[:4], place[r[:4]].pop(0) if place.get(r[:4]) else 0) for r in out)


def result(df):
    return sorted((*r[:4], r[4] or 0) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect())


@pytest.fixture(scope="module")
def targets(rows):
    return ["the end of it all", None, "", rows[3][1], rows[31][1] + " Aa-bB 7é\tß", "x" * 300 + " y " + "z" * 130]


def test_matches_brute_force(spark, docs, rows, targets):
    target = spark.createDataFrame([(i, t) for i, t in enumerate(targets)], "item_id long, text string")
    assert result(resampling.resampled(docs, target)) == brute(rows, targets)


def test_draws_over_many_partitions(spark):
    rows = [(i, " ".join(f"w{(i * j) % 97}" for j in range(i % 40))) for i in range(900)] + [(5, "twice " * 30)] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    got = result(resampling.resampled(df, spark.createDataFrame([("w3 w5 w8",)], "text string")))
    assert got == brute(rows, ["w3 w5 w8"])
    drawn = sorted(r[4] for r in got if r[4])
    assert drawn == list(range(1, len(drawn) + 1)) and drawn


def test_empty(spark, empty, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert resampling.resampled(empty, none).collect() == []
    assert resampling.resampled(docs, none).count() == docs.filter("doc_id is not null").count()


def test_crc_of_joined_bytes():
    a, b = [b"", b"abc", b"x" * 70], [b"tail", b"y" * 200, b"z" * 64]
    got = resampling.shifted(np.array([zlib.crc32(x) for x in a], np.uint32), np.array([len(x) for x in b])) ^ np.array([zlib.crc32(x) for x in b], np.uint32)
    assert got.tolist() == [zlib.crc32(x + y) for x, y in zip(a, b)]
