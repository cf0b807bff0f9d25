import base64
import hashlib
import itertools
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from pathcredit.llm import attention, counts, decontamination, packing, personal, quality, scoring, tokens
from pathcredit.llm.tokens import Encoder, encoder
from tests.llm import brute


def public_ids(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    bpe = public_ids.__dict__.setdefault("bpe", Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")))
    return bpe.encode(text or "", add_special_tokens=False).ids


# ------------------------------------------------------------------ packing


def test_ids_are_those_of_the_public_tokenizer(rows):
    texts = [t or "" for _, t in rows] + ["<|endoftext|> x", "a <|endoftext|><|endoftext|>\n b<|endoftext|", "<|endoftext|>", " a\n \n b", "\n\n x  y", "a   b", " ", "  "]
    got = [np.frombuffer(x, "<u4").tolist() for x in Encoder("byte_bpe_50k").encode_all(texts)]
    assert got == [public_ids(t) for t in texts]


def test_encoder_keeps_nothing_of_texts_with_many_words():
    """Rare words were kept in a table, which was filled and emptied for every step."""
    bpe = Encoder("byte_bpe_50k")
    text = " ".join(np.random.default_rng(4).integers(1 << 40, 1 << 44, 20_000).astype(str).tolist())
    tracemalloc.start()
    ids = bpe.encode(text)
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert held < 2 * len(ids)
    assert np.frombuffer(ids, "<u4").tolist() == public_ids(text)


def test_embedding_gradients_are_sums_over_slots():
    """They were added row by row; the order of the sums is the same."""
    rng = np.random.default_rng(6)
    slots, values = rng.integers(0, 40, 500), rng.standard_normal((500, attention.WIDTH)).astype(np.float32)
    slots[:100] = 7
    expected = np.zeros((attention.SYMBOLS, attention.WIDTH), np.float32)
    np.add.at(expected, slots, values)
    assert np.array_equal(attention._summed(slots, values, attention.SYMBOLS), expected)
    assert not attention._summed(slots[:0], values[:0], 9).any()


def test_long_texts_are_cut_where_no_piece_reaches_across(monkeypatch):
    monkeypatch.setattr(tokens, "_LONG", 3)
    texts = ["ab  cd e\u00a0f  g\n h i", "x " * 9, " a b  c\t d", "it's a b's  \u3000 c", "abc <|endoftext|> d e  f g", "\U0001f600 \U0001f600 a"]
    got = [np.frombuffer(x, "<u4").tolist() for x in Encoder("byte_bpe_50k").encode_all(texts)]
    assert got == [public_ids(t) for t in texts]


def check_packed(pieces, rows):
    """Every id lies in one piece; sequences are gapless and at most 1024 long."""
    by_doc, by_sequence = {}, {}
    for r in pieces:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == {i for i, _ in rows if i is not None}
    for i in by_doc:
        own = [t for j, t in rows if j == i]
        ids = np.array(public_ids(own[0]) + [0], "<u4")
        found = sorted((r.start, r.length, r.ids_crc32) for r in by_doc[i])
        expected = [(s, len(p), zlib.crc32(p.tobytes())) for s in range(0, len(ids), 1024) for p in [ids[s : s + 1024]]]
        assert found == sorted(expected * len(own))
        assert {r.doc_tokens for r in by_doc[i]} == {len(ids)}
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024


def test_packing_round_trip(docs, rows, empty):
    check_packed(packing.packed(docs).collect(), rows)
    check_packed(packing.packed(docs, group_documents=7).collect(), rows)
    assert packing.packed(empty).collect() == []


def test_repeated_rows_are_dealt_to_many_groups(spark):
    same = spark.createDataFrame([(7, "one text")] * 600, "doc_id long, text string")
    got = packing.packed(same, group_documents=30).collect()
    check_packed(got, [(7, "one text")] * 600)
    groups = [r.sequence_id >> 32 for r in got]
    assert max(groups.count(g) for g in set(groups)) < 80


def test_first_fit_decreasing_matches_a_scan():
    rng = random.Random(3)
    lengths = [rng.randint(1, 100) for _ in range(300)]
    bins, offsets = packing.first_fit_decreasing(lengths, 100)
    room, expected = [], [None] * 300
    for i in sorted(range(300), key=lambda i: -lengths[i]):
        b = next((k for k, r in enumerate(room) if r >= lengths[i]), len(room))
        if b == len(room):
            room.append(100)
        expected[i] = (b, 100 - room[b])
        room[b] -= lengths[i]
    assert list(zip(bins.tolist(), offsets.tolist())) == expected


# ------------------------------------------------------------------ token counts


def test_token_counts_match_brute_force(docs, rows, empty):
    import public_tokenizers

    model = counts.Unigram.public("byte_bpe_50k")
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranked = sorted((int(b), base64.b64decode(a)) for a, b in map(bytes.split, f))
    total = float((1.0 / np.arange(1, len(ranked) + 2)).sum())
    score = {p: int(round(-np.log((r + 1) * total) * (1 << 20))) for r, (_, p) in enumerate(ranked)}
    small = docs.filter("doc_id not in (58)")
    got = sorted((r.doc_id, r.n_pretokens, r.n_tokens, round(r.log_score, 6)) for r in counts.token_counts(small).collect())
    expected = []
    for i, t in rows:
        if i is None or i == 58:
            continue
        best = [brute.best_segmentation(b" " + w, score, model.unknown, model.longest) for w in brute.words(t)]
        expected.append((i, len(best), sum(n for _, n in best), round(sum(s for s, _ in best) / (1 << 20), 6)))
    assert got == sorted(expected)
    assert counts.token_counts(empty).collect() == []


def test_token_counts_of_unknown_bytes_and_ties():
    model = counts.Unigram([b"a", b"ab", b"b"])
    text = np.frombuffer(b"abz", np.uint8)
    tokens, _ = model.counts(text, np.array([0, 0]), np.array([2, 3]))
    assert tokens.tolist() == [1, 2]


# ------------------------------------------------------------------ decontamination

ITEMS = [(1, " ".join(f"w{k}" for k in range(40))), (2, "too short to seed"), (3, None), (None, "x " * 30), (4, " ".join(f"W{k}" for k in range(12)))]


def test_overlaps_match_brute_force(spark, docs, rows, empty):
    rng = random.Random(2)
    leak = ITEMS[0][1].split()
    changed = [x if rng.random() > 0.12 else "other" for x in leak]
    planted = [(100, "before " + " ".join(leak) + " after"), (101, " ".join(changed)), (102, " ".join(leak[20:])), (103, " ".join(leak[:9])), (104, " ".join(leak[30:] + leak[:30]))]
    extra = spark.createDataFrame(planted, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    table = docs.select("doc_id", "text").unionByName(extra)
    got = {tuple(r) for r in decontamination.overlaps(table, items).collect()}
    assert got == brute.overlaps(rows + planted, ITEMS, decontamination.MASKS)
    assert {100, 101, 102} <= {r[0] for r in got} and 103 not in {r[0] for r in got}
    assert decontamination.overlaps(empty, items).collect() == []
    assert decontamination.overlaps(table, items.limit(0)).collect() == []
    kept = decontamination.decontaminated(docs, items)
    assert kept.columns == docs.columns and kept.count() == docs.count()


def test_no_python_on_the_native_path(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    plan = decontamination.overlaps(docs, items)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# ------------------------------------------------------------------ quality


def test_counts_match_brute_force(docs, rows, spark, empty):
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0), (999, 0)], "doc_id long, quality int")
    got = quality.judged(docs, labels).collect()
    expected = sorted((i, *(c := brute.counts(t)), c[0] < 20 or 100 * c[4] > 30 * c[0]) for i, t in rows if i is not None)
    assert sorted(tuple(r)[:7] for r in got) == expected
    assert all(r.kept == (not r.base_failed) for r in got)  # no bad label: an empty list
    assert quality.judged(empty, labels).collect() == []
    assert quality.judged(docs, labels.limit(0)).count() == len(expected)


def test_learned_list_recovers_thresholds():
    rng = np.random.default_rng(4)
    x = rng.random((3000, len(quality.FEATURES)))
    bad = (x[:, 2] > 0.8) | ((x[:, 5] < 0.2) & (x[:, 0] > 0.5))
    rules = quality.learn(x[:2000], bad[:2000])
    found = np.any([quality.covers(r, x[2000:]) for r in rules], axis=0)
    assert (found == bad[2000:]).mean() > 0.97


def test_verdict_is_the_list(spark):
    rows = [(i, *[float(v) for v in np.random.default_rng(i).integers(0, 50, 10)]) for i in range(60)]
    table = spark.createDataFrame(rows, "doc_id long, " + ", ".join(f"{c} double" for c in quality.COUNTS + quality._FURTHER))
    rules = [(quality.Condition(0, True, 30.0), quality.Condition(2, False, 1.0)), (quality.Condition(5, True, 2.0),)]
    got = table.select(quality.verdict(rules).alias("kept"), *[quality.feature(f).alias(f) for f in quality.FEATURES]).toPandas()
    x = got[list(quality.FEATURES)].to_numpy()
    assert (got["kept"].to_numpy() == ~np.any([quality.covers(r, x) for r in rules], axis=0)).all()


def test_held_out_quality(spark):
    """Learned on half of the labels of a generated table, right on the rest."""
    from tests.conftest import SF01

    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    half = labels.filter("doc_id % 2 = 0")
    got = quality.judged(spark.read.parquet(f"{SF01}/documents.parquet"), half).join(labels.filter("doc_id % 2 = 1"), "doc_id").filter("not base_failed").toPandas()
    assert (got["kept"] == (got["quality"] == 1)).mean() > 0.97


# ------------------------------------------------------------------ personal data


def test_base_spans_match_the_patterns(docs, rows, empty):
    got = personal.personal_data(docs).withColumn("spans", personal._digest("base")).select("doc_id", "spans").collect()
    assert sorted(map(tuple, got)) == sorted((i, brute.base_spans(t)) for i, t in rows if i is not None)
    assert personal.personal_data(empty).collect() == []


@pytest.mark.parametrize("text", ["a@b", "a@b.c@d.e", "..@x.y", "x@-.-", "1.2.3.4.5.6.7.8", "0000001.2.3.4", "4539 1488 0343 6467-", "+1 +12 345 678 9012 3", "@@a@b.c.", "9" * 40, "é@ü.de a@é.b"])
def test_base_spans_of_odd_texts(text):
    assert ",".join(f"{personal.KINDS[k]}:{a}:{b}" for a, k, b in personal.base_spans(text)) == brute.base_spans(text)


@pytest.mark.parametrize("text", ["0" * 5000 + ".1.1.1", "1" * 5000 + ".1.1.1 2.2.2.2", "1." * 3000 + "4", "1.2.3.256.7.8.9", "1" * 300_000])
def test_long_runs_of_digits(text):
    if len(text) > 100_000:  # read in one pass
        assert personal.base_spans(text) == []
    else:
        expected = [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(len(x.lstrip("0")) <= 3 and int(x[-3:]) <= 255 for x in m[0].split("."))]
        assert [s for s in personal.base_spans(text) if s[1] == 1] == expected


def test_op8_counts_each_kind(spark, tmp_path):
    rows = [(1, "1.2.3.4 then +1 (415) 555-2671, a@b.c and x@y.zz"), (2, "a@b.c a@b.d 1.2.3.4"), (3, None), (4, "x 4539 1488 0343 6467"), (5, "0" * 5000 + ".1.1.1")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in personal.op8_personal(spark, str(tmp_path)).collect()}
    for i, text in rows[:4]:
        base = brute.base_spans(text)
        kinds = [x.split(":")[0] for x in base.split(",")]
        assert tuple(got[i][f"n_{k}"] for k in personal.KINDS) == tuple(kinds.count(k) for k in personal.KINDS)
        assert got[i].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
    assert [got[5][f"n_{k}"] for k in personal.KINDS] == [0, 1, 0, 0]


def test_context_discovers_unseen_identifiers(spark):
    rows = [(i, f"please dial +1 (202) 555-{1000 + i} now and {i} more words {'x' * i}") for i in range(60)]
    rows += [(100, "please dial 202.555.0143 now"), (101, "we saw 202.555.0199 there"), (102, None)]
    got = {r.doc_id: r.spans for r in personal.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [(s.start, s.kind, s.end) for s in got[100]] == [(12, 3, 24)]
    assert got[101] == [] and got[102] == [] and len(got[5]) == 1


# ------------------------------------------------------------------ scoring


@pytest.mark.parametrize("hot", [1 << 16, 0, 5])
def test_base_scores_match_brute_force(docs, rows, monkeypatch, hot):
    monkeypatch.setattr(scoring, "HOT_WORDS", hot)
    got = sorted(tuple(r) for r in scoring.scored(docs).collect())
    expected = sorted(brute.base_scores(rows))
    assert [g[:5] for g in got] == [e[:5] for e in expected]
    assert np.allclose([g[5] for g in got], [e[5] for e in expected], rtol=1e-9)
    assert all(np.isfinite(g[6]) and g[6] < 0 for g in got)


def test_scoring_empty(empty):
    assert scoring.scored(empty).collect() == []


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(0)
    p = attention.start(rng, rng.integers(1, 99, attention.SYMBOLS))
    known = attention.Vocabulary.of(rng.integers(0, 50, 3000))
    inputs = np.tile(np.array([5, 9, 2, 7], np.int32), attention.CONTEXT // 4)
    total = 0.0
    for i in range(3000):
        targets = np.full(attention.CONTEXT, known.symbol[i], np.int32)
        total += 10 ** (attention.log_probabilities(p, inputs, np.array([True]), targets)[7] / np.log(10) + known.share[i])
    assert abs(total - 1) < 1e-3


def test_windows_score_like_whole_sequences():
    """Scores depend on the last CONTEXT positions only, wherever windows fall."""
    rng = np.random.default_rng(1)
    p = attention.start(rng, rng.integers(1, 99, attention.SYMBOLS))
    ids = rng.integers(0, attention.SYMBOLS, 70).astype(np.int32)
    first = np.array([0, 50, 70])
    inputs, opening, place = attention.windows(ids, first)
    targets = np.zeros(len(inputs), np.int32)
    targets[place] = np.roll(ids, -1)
    got = attention.log_probabilities(p, inputs, opening, targets)[place]
    q, k, v = (p["embed"][ids] @ p[x] for x in ("query", "key", "value"))
    for i in (0, 7, 33, 49, 50, 69):
        lo = max(0 if i < 50 else 50, i - attention.CONTEXT + 1)
        s = q[i] @ k[lo : i + 1].T * attention.WIDTH**-0.5 + p["distance"][np.arange(i - lo, -1, -1)]
        a = np.exp(s - s.max())
        h = np.tanh(p["embed"][ids[i]] @ p["own"] + (a / a.sum()) @ v[lo : i + 1] @ p["mixed"] + p["bias"])
        y = np.roll(ids, -1)[i]
        c, m = h @ p["class"] + p["class_bias"], h @ p["member"][y // 32] + p["member_bias"][y // 32]
        expected = c[y // 32] - np.log(np.exp(c).sum()) + m[y % 32] - np.log(np.exp(m).sum())
        assert abs(got[i] - expected) < 1e-3


def test_training_lowers_held_out_loss(spark):
    rng = random.Random(8)
    texts = [" ".join(rng.choice(["the cat sat", "on a mat", "and then it", "ran away"]) for _ in range(60)) for _ in range(40)]
    ids, first = scoring.subwords(__import__("pyarrow").array(texts[30:]), "byte_bpe_50k")
    score = []
    for passes in (0, 1, 100):
        known, model = scoring.fitted_on(spark.createDataFrame([(t,) for t in texts[:30]], "text string").coalesce(2), "byte_bpe_50k", passes)
        inputs, opening, targets, place = scoring._laid(ids, first, known)
        score.append(attention.log_probabilities(model, inputs, opening, targets)[place].mean())
    assert score[0] < score[1] < score[2] and score[2] > score[0] + 1


def test_fitting_reads_the_whole_fold(spark):
    """One word in the documents past any thousand: counted, and trained on."""
    rows = [(i, "the cat sat on a mat " * 3) for i in range(1200)] + [(2000 + i, "zebra quartz " * 12) for i in range(8)]
    texts = spark.createDataFrame(rows, "doc_id long, text string").repartitionByRange(2, "doc_id")
    known, model = scoring.fitted_on(texts, "byte_bpe_50k", 8)
    ids, first = scoring.subwords(pa.array([t for _, t in rows]), "byte_bpe_50k")
    whole = attention.Vocabulary.of(np.bincount(ids, minlength=scoring.VOCABULARY_SIZE))
    assert (known.symbol == whole.symbol).all() and (known.share == whole.share).all()
    start = attention.start(np.random.default_rng(9), np.bincount(known.symbol[ids], minlength=attention.SYMBOLS))
    ids, first = scoring.subwords(pa.array([rows[-1][1]]), "byte_bpe_50k")
    inputs, opening, targets, place = scoring._laid(ids, first, known)
    before, after = (attention.log_probabilities(p, inputs, opening, targets)[place].mean() for p in (start, model))
    assert after > before + 0.3


def test_texts_are_encoded_once(docs, monkeypatch, tmp_path):
    """Training encoded its texts, and scoring encoded them again."""
    real, note = scoring.subwords, str(tmp_path / "encoded")

    def noted(texts, vocabulary):
        with open(note, "a") as f:
            f.write(f"{len(texts)}\n")
        return real(texts, vocabulary)

    monkeypatch.setattr(scoring, "subwords", noted)
    got = scoring.scored(docs).collect()
    with open(note) as f:
        assert sum(map(int, f)) == len(got) == docs.filter("doc_id is not null").count()


def batch_of_windows(windows=9):
    rng = np.random.default_rng(3)
    p = attention.start(rng, rng.integers(1, 99, attention.SYMBOLS))
    p["distance"] += rng.standard_normal(attention.CONTEXT).astype(np.float32)
    p["embed"] *= 8  # all parameters matter
    p["class"] *= 10
    p["member"] *= 10
    ids = rng.integers(0, 50, (windows, 2 * attention.CONTEXT)).astype(np.int32)
    targets = rng.integers(0, 5 * attention.MEMBERS, (windows, attention.CONTEXT)).astype(np.int32)
    weight = (rng.random(targets.shape) < 0.8).astype(np.float32)
    return p, ids, np.arange(windows) % 3 == 1, targets, weight


def test_gradients_are_slopes_of_the_loss():
    p, *batch = batch_of_windows()
    _, g = attention.gradients(p, *batch)
    assert not g["member"][5:].any() and not g["member_bias"][5:].any()  # classes that no target is of
    for k, slope in g.items():
        size = float(np.linalg.norm(slope))
        step = slope * np.float32(0.02 / size)
        up, down = (attention.gradients(p | {k: p[k] + s * step}, *batch)[0] for s in (1, -1))
        assert abs((up - down) / 0.04 - size) < 0.03 * size, k


def test_gradients_leave_nothing_of_an_earlier_batch():
    p, *batch = batch_of_windows()
    loss, g = attention.gradients(p, *batch)
    used = {k: np.full_like(v, 9) for k, v in p.items()}
    assert attention.gradients(p, *batch, used)[0] == loss
    assert all(np.array_equal(g[k], used[k]) for k in g)


def test_exponentials_are_those_of_seen_slots():
    """Half of the exponentials were of slots that no position sees."""
    p, _, opening, _, _ = batch_of_windows()
    s = np.random.default_rng(5).standard_normal((len(opening), attention.CONTEXT, 2 * attention.CONTEXT)).astype(np.float32)
    expected = np.zeros_like(s)
    for w, i in itertools.product(range(len(s)), range(attention.CONTEXT)):
        seen = np.arange(attention.CONTEXT if opening[w] else i + 1, attention.CONTEXT + i + 1)
        x = s[w, i, seen] + p["distance"][attention.CONTEXT + i - seen]
        expected[w, i, seen] = np.exp(x - x.max())
    assert np.array_equal(attention._exponentials(s, p["distance"], opening), expected)


def test_adam_steps_all_parameters_alike():
    p, *batch = batch_of_windows()
    adam, expected = attention.Adam(p), {k: v.copy() for k, v in p.items()}
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
    for t in (1, 2, 3):
        _, g = attention.gradients(expected, *batch)
        attention.gradients(adam.p, *batch, adam.g)
        adam.step(1e-2)
        for k, (mean, square) in moments.items():
            mean += 0.1 * (g[k] - mean)
            square += 0.01 * (g[k] ** 2 - square)
            expected[k] -= 1e-2 * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.99**t)) + 1e-8)
    assert all(np.allclose(adam.p[k], expected[k], atol=1e-5) for k in p)
    assert all(np.array_equal(x, adam.p[k]) for k, x in attention.shaped(adam.values, p).items())


def test_encoder_is_kept():
    assert encoder() is encoder()


# ------------------------------------------------------------------ decontamination: every pattern


def all_diagonals(docs, items, window=20, percent=80):
    """:func:`brute.overlaps` over all diagonals, without seeds."""
    out = set()
    for d, t in docs:
        w = t.lower().split()
        for b, text in items:
            item = text.lower().split()
            for shift in range(-len(item) + 1, len(w)):
                df, bf, size = max(shift, 0), max(-shift, 0), min(window, len(item))
                same = [x == y for x, y in zip(w[df:], item[bf:])]
                good = [i for i in range(len(same) - size + 1) if sum(same[i : i + size]) * 100 >= size * percent]
                if good:
                    end = good[-1] + size
                    out.add((d, b, df + good[0], bf + good[0], end - good[0], sum(same[good[0] : end])))
    return out


@pytest.mark.parametrize("size", range(1, 24))
def test_masks_hit_every_pattern(size):
    masks = next(m for least, m in decontamination.FAMILIES if size >= least)
    n = min(size, decontamination.OVERLAP_WORDS)
    windows = [{i + o for o in m} for m in masks for i in range(n - m[-1])]
    for changed in itertools.combinations(range(n), n * (100 - decontamination.PERCENT) // 100):
        assert any(w.isdisjoint(changed) for w in windows), changed


def test_overlaps_match_all_diagonals(spark):
    rng = random.Random(6)
    items = [(n, " ".join(f"i{n}w{k}" for k in range(n))) for n in (1, 2, 3, 4, 5, 6, 7, 9, 10, 11, 12, 15, 16, 19, 20, 30)]
    docs = []
    for n, text in items:
        for k in range(20):
            w = text.split()
            for at in rng.sample(range(n), min(n, min(n, 20) // 5 + (k == 0))):
                w[at] = f"x{k}"
            docs.append((100 * n + k, " ".join([f"a{k}"] * (k % 3) + w + [f"b{k}"] * (k % 2))))
    expected = all_diagonals(docs, items)
    got = decontamination.overlaps(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {tuple(r) for r in got.collect()} == expected and len(expected) > 19 * len(items) - 20
