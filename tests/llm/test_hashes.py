"""Texts of two letters whose power sums modulo 2^64 agree are told apart."""

import pyarrow as pa
import pytest

from pathcredit.llm import lines, minhash, quality, substrings, suffixes
from pathcredit.llm.common import likely_among
from tests.llm import brute


def couple(size):
    word = "a"
    while len(word) < size:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("size", [1024, 2048, 4096])
def test_one_word_documents_do_not_link(spark, size):
    df = spark.createDataFrame(list(enumerate(couple(size))), "doc_id long, text string")
    assert sorted(map(tuple, minhash.near_duplicates(df).collect())) == [(0, 1, 0, True), (1, 1, 1, True)]


@pytest.mark.parametrize("size", [1024, 2048, 4096])
def test_lines_and_words_are_distinct(size):
    one, two = couple(size)
    found = lines.Lines([one + "\n" + two + "\n" + one.upper()])
    assert found.id[0] != found.id[1] and found.id[0] == found.id[2]
    counts = dict(zip(quality._SCHEMA.names[1:], [x.tolist() for x in quality.statistics_of(pa.array([one + "\n" + two]))]))
    assert counts["n_dup_lines"] == [0] and counts["n_words"] == [2]
    assert [x for k, x in counts.items() if "distinct" in k] == [[2]]


@pytest.mark.parametrize("size", [1024, 4096])
def test_windows_of_such_words_are_distinct(spark, size):
    one, two = couple(size)
    rest = " ".join(f"w{i}" for i in range(19))
    rows = [(1, f"{one} {rest}"), (2, f"{two} {rest}"), (3, f"{two} {rest}")]
    got = substrings.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id, r.n_removed) for r in got.collect()) == [(1, 0), (2, 0), (3, 20)]


def test_byte_windows_of_such_texts(spark):
    one, two = couple(4096)
    rows = [(1, one), (2, two), (3, one[:150] + two[150:1024])]
    got = suffixes.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).drop("kept")
    assert sorted(map(tuple, got.collect())) == brute.suffixes(rows)


def test_rows_of_other_keys_stay_behind(spark):
    rows = spark.range(-50, 20_000).selectExpr("id as doc_id", "repeat('x', 3) as text").unionByName(spark.createDataFrame([(7, "again"), (None, "no id")], "doc_id long, text string"))
    keys = spark.createDataFrame([(i,) for i in (-50, -1, 0, 7, 7, 19_999, 40_000)], "doc_id long")
    got = likely_among(rows, "doc_id", keys)
    assert got.columns == rows.columns
    found = sorted(tuple(r) for r in got.collect())
    assert set(found) >= {(i, "xxx") for i in (-50, -1, 0, 7, 19_999)} | {(7, "again")}
    assert len(found) < 100
    assert likely_among(rows, "doc_id", keys.limit(0)).collect() == []
