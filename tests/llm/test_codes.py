import hashlib
import math
import random

import numpy as np
import pytest

from pathcredit.llm import codes


def brute(rows, rounds=4):
    """rows: (vec_id, vector, label)."""
    kept = [(i, v, l) for i, v, l in rows if i is not None and v and len(v) % 4 == 0 and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    width = len(min(kept, key=lambda r: (r[0], len(r[1])))[1])
    kept = [(i, [math.floor(1024 * x) for x in v], l, v) for i, v, l in kept if len(v) == width]
    first = sorted(kept, key=lambda r: (r[0], r[3]))[:256]
    size = width // 4

    def cut(v):
        return [np.array(v[p * size : (p + 1) * size], dtype=object) for p in range(4)]

    books = [[cut(r[1])[p] for r in first] for p in range(4)]
    parts = [cut(r[1]) for r in kept]

    def near(x, book):
        return min((int(((x - c) ** 2).sum()), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p in range(4):
            own = [near(x[p], books[p])[1] for x in parts]
            for e in range(len(books[p])):
                mine = [x[p] for x, o in zip(parts, own) if o == e]
                if mine:
                    books[p][e] = np.array([s // len(mine) for s in sum(mine)], dtype=object)
    digest = hashlib.sha256(",".join(str(n) for b in books for c in b for n in c).encode()).hexdigest()
    out = []
    for (i, _, label, _), x in zip(kept, parts):
        found = [near(x[p], books[p]) for p in range(4)]
        out.append((i, label, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)))
    total = {}
    for _, label, _, d in out:
        total[label] = total.get(label, 0) + d
    return sorted((i, c, d, total[label], digest) for i, label, c, d in out)


def result(df):
    return sorted(tuple(r) for r in df.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect())


def sample(seed, n, width, spread=0.3):
    rng = random.Random(seed)
    centres = [[rng.uniform(-1, 1) for _ in range(width)] for _ in range(12)]
    rows = []
    for i in range(n):
        c = rng.choice(centres)
        rows.append((i * 3 % (n + 7), [float(np.float32(x + rng.gauss(0, spread))) for x in c], rng.choice([1, 2, 2, 2, None])))
    return rows


KIND = "vec_id long, embedding array<float>, label int"


def test_matches_brute_force(spark):
    rows = sample(1, 700, 12)
    assert result(codes.compressed(spark.createDataFrame(rows, KIND).repartition(5))) == brute(rows)


def test_odd_rows(spark):
    rows = sample(2, 60, 8)
    rows += [(900, None, 1), (901, [], 1), (902, [1.0, None] * 4, 1), (903, [float("nan")] * 8, 2), (904, [float("inf")] * 8, 2)]
    rows += [(905, [1.0] * 4, 1), (906, [1.0] * 7, 1), (None, [1.0] * 8, 1), (907, [0.5] * 8, None), (907, [0.5] * 8, None), (0, [0.0] * 8, 7)]
    df = spark.createDataFrame([(*r, "z", None) for r in rows], KIND + ", code string, slot string").repartition(4)
    assert result(codes.compressed(df)) == brute(rows)


def test_wide_numbers(spark):
    rng = random.Random(4)
    rows = [(i, [float(np.float32(rng.uniform(-30000, 30000))) for _ in range(8)], i % 3) for i in range(300)]
    assert result(codes.compressed(spark.createDataFrame(rows, KIND))) == brute(rows)


def test_empty(spark):
    none = codes.compressed(spark.createDataFrame([(1, None, 2)], KIND))
    assert none.collect() == [] and none.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


@pytest.mark.parametrize("seed", range(4))
def test_bounds_never_change_a_code(seed):
    """Parts under bounds get the codes of a full scan, with few scans."""
    rng = np.random.default_rng(seed)
    x = (rng.normal(size=(40, 5)) * 900)[np.arange(600) % 40].astype(np.int64) + rng.integers(-60, 60, (600, 5))
    book, books, state, scans = x[:40].copy(), [], None, []
    for _ in range(7):
        books.append(book[None])
        state, n = codes.assign(x, codes.History(books), 0, state)
        scans.append(n)
        assert (state["code"] == codes.squared(x, book).argmin(1)).all()
        book = np.array([x[state["code"] == e].sum(0) // max(1, (state["code"] == e).sum()) if (state["code"] == e).any() else book[e] for e in range(40)])
    assert scans[0] == 600 and scans[-1] < 60


def test_net_displacement_is_the_norm_of_the_sum():
    """An entry that moved and came back has not moved."""
    books = [np.array([[[0, 0], [9, 9]]]), np.array([[[50, 0], [9, 9]]]), np.array([[[0, 0], [9, 9]]])]
    assert codes.History(books).moved[0, 0].tolist() == [0, 0] and codes.History(books).moved[1, 0].tolist() == [50, 0]
