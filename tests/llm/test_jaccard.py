import random

import numpy as np
import pyarrow as pa
import pytest

from pathcredit.llm import jaccard
from pathcredit.llm.common import content_hashes
from tests.llm import brute


def pairs(df):
    return sorted(tuple(r) for r in df.collect())


def expected(rows, percent=80):
    return sorted((i, n, c) for i, (n, c, _) in brute.near_duplicates(rows, percent).items())


@pytest.mark.parametrize("percent", [80, 60])
def test_matches_brute_force(docs, rows, percent):
    got = jaccard.joined(docs, percent)
    assert pairs(got.distinct()) == expected(rows, percent)
    assert got.filter("doc_id = 63").count() == 2


def chains(rng, groups, length, words):
    """Groups in which each text changes one word of the one before: neighbours link,
    the ends do not."""
    out = []
    for g in range(groups):
        text = [f"g{g}w{rng.randrange(30)}" for _ in range(words)]
        for _ in range(length):
            text = list(text)
            text[rng.randrange(words)] = f"n{rng.randrange(10**9)}"
            out.append(" ".join(text))
    return list(enumerate(out))


@pytest.mark.parametrize("block_rows, centre_rounds", [(2, 0), (3, 1), (1024, 2)])
def test_chains_are_whole_with_any_blocks(spark, block_rows, centre_rounds):
    rows = chains(random.Random(3), 6, 12, 60)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert pairs(jaccard.joined(df, 80, block_rows=block_rows, centre_rounds=centre_rounds)) == expected(rows)


def test_hot_shingles_are_counted_apart(docs, rows):
    assert pairs(jaccard.joined(docs, hot_rows=2).distinct()) == expected(rows)


def test_frequent_tokens():
    rng, frequent = np.random.default_rng(2), jaccard.Frequent(20)
    for _ in range(30):
        frequent.add(np.concatenate([rng.integers(100, 1 << 60, 500), np.repeat(np.arange(5), 40)]).astype(np.uint64))
    found = dict(zip(frequent.tokens.tolist(), frequent.rows.tolist()))
    assert all(found[t] >= 1100 for t in range(5)) and len(found) <= 20


def test_one_id_with_two_texts(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(40))
    df = spark.createDataFrame([(5, a), (5, b), (3, b + " c"), (9, a)], "doc_id long, text string")
    assert pairs(jaccard.joined(df)) == [(3, 37, 3), (5, 26, 5), (5, 36, 3), (9, 26, 5)]


def test_empty(empty):
    assert jaccard.joined(empty).collect() == []


def test_no_hash_of_structure():
    """Words over two letters that a power sum modulo 2^64 cannot tell apart."""
    for size in (1024, 2048, 4096):
        word = "a"
        while len(word) < size:
            word += word.translate(str.maketrans("ab", "ba"))
        both = np.frombuffer((word + word.translate(str.maketrans("ab", "ba"))).encode(), np.uint8)
        one, two = content_hashes(both, np.array([0, size]), np.array([size, 2 * size]))
        assert one != two
        sets, first = jaccard.shingle_sets(pa.array([both[:size].tobytes().decode(), both[size:].tobytes().decode()]), 5)
        assert first.tolist() == [0, 1, 2] and sets[0] != sets[1]


def test_content_hashes_read_their_span_alone():
    data = np.frombuffer(b"abcdefghijk abcdefghijk abcdefgh abcdefgh" + b"x" * 1200, np.uint8)
    h = content_hashes(data, np.array([0, 12, 24, 33, 41, 641, 5]), np.array([11, 23, 32, 41, 641, 1241, 5]))
    assert h[0] == h[1] and h[2] == h[3] and h[0] != h[2] and h[4] == h[5] and h[6] != h[0]
