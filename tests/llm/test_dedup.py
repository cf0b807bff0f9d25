import glob
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from pathcredit.llm import lines, lsh, minhash, substrings, suffixes
from pathcredit.llm.bwt import repeated
from pathcredit.llm.common import content_hashes, mix, shared_dir, steps
from pathcredit.llm.components import components
from pathcredit.llm.lsh import Near, _could_link, mixed_bands
from tests.llm import brute


def pairs(df):
    return sorted(tuple(r) for r in df.collect())


def test_minhash_matches_brute_force(docs, rows):
    got = minhash.near_duplicates(docs)
    assert pairs(got.distinct()) == sorted((i, *v) for i, v in brute.near_duplicates(rows).items())
    assert got.filter("doc_id = 63").count() == 2


def test_minhash_blocks_and_salts(docs, rows):
    """Tiny blocks and centre groups find the same components."""
    got = minhash.near_duplicates(docs, Near(70, shingle=5, bands=64, rows=2, centre_rows=2, block_rows=2))
    assert pairs(got.distinct()) == sorted((i, *v) for i, v in brute.near_duplicates(rows, 70).items())


def test_minhash_empty(empty):
    assert minhash.near_duplicates(empty).collect() == []


def test_super_min_hash_estimates_similarity():
    rng = np.random.default_rng(1)
    shared, other = rng.integers(0, 1 << 48, 400, dtype=np.uint64), rng.integers(0, 1 << 48, (2, 100), dtype=np.uint64)
    sets = [np.unique(np.concatenate([shared, o])) for o in other]
    found = minhash.super_min_hash(np.concatenate(sets), np.cumsum([0, *map(len, sets)]), 128)
    assert abs((found[0] == found[1]).mean() - 400 / 600) < 0.15


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (3, 7), (20, 20), (12, 9)]
    got = components(spark.createDataFrame(links, "u long, v long"))
    assert pairs(got.distinct()) == [(1, 1), (2, 1), (3, 1), (7, 1), (8, 8), (9, 8), (12, 8)]
    chain = spark.range(1, 200).selectExpr("id as u", "id + 1 as v")
    assert components(chain).select("component").distinct().collect()[0][0] == 1


def test_lines_match_brute_force(docs, rows):
    got = {(r.doc_id, r.line_no): ((r.first_doc, r.first_line), r.kept) for r in lines.judged_lines(docs).collect()}
    assert got == brute.judged_lines(rows)


def test_lines_with_a_changed_character_are_similar(spark):
    """79 characters with one inner change: 64 of 80 shingles of eight in common."""
    line = "".join(random.Random(4).choices("abcdefghijklmnopqrstuvwxyz ", k=79))
    rows = [(1, line), (2, line[:40] + "#" + line[41:]), (3, line[:20] + "#" + line[21:60] + "#" + line[61:])]
    got = {r.doc_id: r.kept for r in lines.judged_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: True, 2: False, 3: True}


def test_two_texts_of_one_document(spark):
    """A line is read from the text that holds it."""
    base = "".join(random.Random(1).choices("abcdefgh ", k=200))
    rows = [(1, "short"), (1, "other\n" + base), (2, base[:100] + "#" + base[101:]), (3, "nothing\nmore")]
    got = lines.judged_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert pairs(got.filter("not kept")) == [(2, 0, 1, 1, False)]


def test_short_sets_meet_whatever_their_estimate():
    """Four against five shingles, a band in common, the estimate under the least."""
    near, rng = lines.LINES, np.random.default_rng(5)
    while True:
        five = rng.integers(0, 1 << 48, 5, dtype=np.uint64)
        registers = lines.one_hash(np.concatenate([five[:4], five]), np.array([0, 4, 9]), near.registers)
        bands = mixed_bands(registers, near)
        if (bands[0] == bands[1]).any() and (registers[0] == registers[1]).mean() < near.least_estimate - 0.05:
            break
    sketch = [(r & np.uint64(255)).astype(np.uint8).tobytes() for r in registers]
    row = {"key": [1, 1], "lo": [0, 0], "hi": [0, 0], "rep": [1, 2], "component": [1, 2], "block": [0, 0], "size": [4, 5]}
    first = int(np.flatnonzero(bands[0] == bands[1])[0])
    got = _could_link(near)(pa.table({**row, "band": [first, first], "sketch": sketch, "bands": pa.array(bands.view(np.int64).tolist())}))
    assert got.column("rep").to_pylist() == [1, 2]


def test_lines_are_taken_out(docs, rows, empty):
    got = lines.deduplicated(docs)
    assert got.columns == docs.columns
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=key) == sorted(brute.line_dedup(rows), key=key)
    assert lines.deduplicated(empty).collect() == []


def test_many_lines_of_one_text_are_taken_out_in_one_pass(spark):
    rows = [(1, "the first text has this line"), (2, "\n".join(["the first text has this line", "another line that stays"] * 50_000)), (2, None)]
    got = lines.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted([(1, rows[0][1]), (2, "another line that stays"), (2, None)], key=str)


def test_substrings_match_brute_force(docs, rows, empty):
    got = substrings.deduplicated(docs).drop("kept_text")
    assert pairs(got) == brute.substrings(rows)
    assert substrings.deduplicated(empty).collect() == []


def test_substrings_with_many_surroundings(spark):
    """Texts of two or three words: matches are extended through many classes."""
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(10, 120)))) for i in range(60)]
    passages = [" ".join(rng.choice("abcdefgh") for _ in range(30)) for _ in range(3)]
    around = lambda: " ".join(rng.choice("ab") for _ in range(4))
    rows += [(100 + i, f"{around()} {rng.choice(passages)} {around()}") for i in range(80)]
    got = substrings.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"))
    assert pairs(got.drop("kept_text")) == brute.substrings(rows)


@pytest.mark.parametrize("hot", [128, 1])
def test_suffixes_match_brute_force(docs, rows, hot):
    """hot = 1: segments with a shared anchor are cut to single windows."""
    assert pairs(suffixes.deduplicated(docs, hot=hot).drop("kept")) == brute.suffixes(rows)


@pytest.mark.parametrize("hot", [128, 3, 0])
def test_suffixes_of_a_passage_in_many_surroundings(spark, monkeypatch, hot):
    """Few rows go to the comparison, not one a window."""
    rng, rows, made, table = random.Random(8), [], {}, suffixes.table
    noise = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    passage, ends = noise(185), [noise(60) for _ in range(4)]
    for i in range(60):
        rows.append((i, (noise(60) if i % 3 else ends[i % 4]) + passage + (noise(60) if i % 4 else ends[i % 3])))

    def counted(df, name):
        out = table(df, name)
        made[name] = out.count()
        return out

    monkeypatch.setattr(suffixes, "table", counted)
    assert pairs(suffixes.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"), hot=hot).drop("kept")) == brute.suffixes(rows)
    assert 0 < made["parts"] <= 6 * made["segments"]


def test_a_step_over_hot_segments_holds_little():
    """Four MB of text in one batch, all of it hot: cut in steps of bounded memory."""
    rng = np.random.default_rng(4)
    texts = [rng.integers(97, 123, 40_000, dtype=np.uint8).tobytes().decode() for _ in range(100)]
    segments = [{"anchor": 5, "start": 80 * i, "n": 80, "copies": 1, "hot": True} for i in range(490)]
    batch = pa.record_batch([pa.array(range(100)), pa.array(texts), pa.array([segments] * 100)], ["doc_id", "text", "parts"])
    cut = lambda x: suffixes._cut(x, suffixes.BYTES)
    cut(batch.slice(0, 1))
    tracemalloc.start()
    made = [cut(x).num_rows for x in steps([batch], suffixes.BYTES.step_bytes)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(made) > 100 * 490 and peak < 60e6


def test_suffixes_empty(empty):
    assert suffixes.deduplicated(empty).collect() == []


@pytest.mark.parametrize("shards", [1, 2, 5])
def test_merged_transforms_find_repeats(shards):
    rng = np.random.default_rng(shards)
    base = rng.integers(0, 3, 500).astype(np.uint8)
    texts = [base[a : a + n].tobytes() for a, n in zip(rng.integers(0, 300, 9), rng.integers(1, 200, 9))]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    windows = [t[i : i + 32] if i + 32 <= len(t) else None for t in texts for i in range(len(t))]
    assert repeated(data, offsets, 32, shards).tolist() == [w is not None and windows.count(w) > 1 for w in windows]


def test_a_step_over_lines_holds_little():
    """Four MB of text in one batch are read in steps of bounded memory."""
    rng = np.random.default_rng(4)
    texts = ["\n".join(rng.integers(97, 123, (20, 200), dtype=np.uint8).view("S200").ravel().astype(str)) for _ in range(1000)]
    batch = pa.record_batch([pa.array(range(1000)), pa.array(texts)], ["doc_id", "text"])

    class Docs:
        def mapInArrow(self, run, ddl):
            return run

    run = lines.lines_of(Docs(), lines.LINES)
    list(run(iter([batch.slice(0, 1)])))
    tracemalloc.start()
    found = [x.num_rows for x in run(iter([batch]))]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(found) == 20_000 and peak < 50e6


def test_content_hashes_chain_eight_bytes_a_step():
    def chained(x):
        out = mix(np.array([len(x)], np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        for i in range(0, len(x), 8):
            out = mix((out ^ np.uint64(int.from_bytes(x[i : i + 8], "little"))) + np.uint64(0x9E3779B97F4A7C15))
        return int(out[0])

    rng = np.random.default_rng(6)
    for longest in (5, 16, 17, 64, 512):
        parts = [rng.integers(0, 256, n, dtype=np.uint8).tobytes() for n in [*rng.integers(0, longest + 1, 60), longest, 0]]
        end = np.cumsum([len(x) for x in parts])
        start = end - [len(x) for x in parts]
        assert content_hashes(np.frombuffer(b"".join(parts), np.uint8), start, end).tolist() == [chained(x) for x in parts]


@pytest.fixture
def wide(spark):
    """Every shuffle has all its partitions, as over large tables."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield spark
    spark.conf.set(key, before)


def written(spark, name):
    """Files of every work table of that name."""
    base = shared_dir(spark).removeprefix("file://").removeprefix("file:")
    return {d: len(glob.glob(f"{d}/part-*")) for d in glob.glob(f"{base}/llm-work/{name}-*")}


def test_a_round_over_few_links_writes_one_file(wide):
    links = wide.createDataFrame([(i, i + 1) for i in range(100)], "u long, v long")
    before = written(wide, "links")
    assert pairs(components(links)) == [(i, 0) for i in range(101)]
    rounds = sorted(n for d, n in written(wide, "links").items() if d not in before)
    assert len(rounds) > 3 and set(rounds[:-1]) == {1}


def test_few_centres_of_matches_are_one_file(wide, docs, rows):
    before = written(wide, "centres")
    assert pairs(substrings.deduplicated(docs).drop("kept_text")) == brute.substrings(rows)
    assert {n for d, n in written(wide, "centres").items() if d not in before} == {1}


@pytest.mark.parametrize(("sets", "kinds", "most", "lists"), [(12, 30, 40, False), (40, 20_000, 40, False), (400, 4_000, 200, True)])
def test_intersections_of_a_group_by_products_and_by_lists(sets, kinds, most, lists, monkeypatch):
    """Every set's elements were looked up in lists, one set after another."""
    monkeypatch.setattr(lsh, "_COLUMNS", 16)
    rng = np.random.default_rng(sets)
    groups = [np.unique(rng.integers(0, kinds, rng.integers(0, most))).astype(np.uint64) for _ in range(sets)]
    groups[3] = groups[5] = np.arange(25, dtype=np.uint64)
    both = lsh._intersections(np.concatenate(groups), np.cumsum([0] + [len(g) for g in groups]))
    assert (both.__name__ == "looked_up") == lists
    for i in range(0, sets, 7):
        expected = [len(np.intersect1d(groups[i], g)) for g in groups]
        assert both(i).tolist() == expected
    assert lsh._intersections(np.zeros(0, np.uint64), np.zeros(3, np.int64))(1).tolist() == [0, 0]
