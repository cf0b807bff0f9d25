"""Substring deduplication by seed and extend.

Documents are joined on winnowed anchors of six words.  A segment is an anchor
with the words around it that its candidate windows hold; equal segments collapse
to their earliest place first.  Then matches are extended, round by round: the
earliest segment of a class (at first, all segments of an anchor) is its centre,
every other member is compared with it word by word, to the left of the anchor and
to the right, and the match is the longest stretch both hold.  The twenty-word
windows inside a match start earlier, in the centre.  A member's windows that reach
beyond its match go on: those beyond its left end to the members that left the
centre at the same word with the same next word, the others likewise on the right.
Two members that share a window the centre lacks always go on to the same class,
so no repeat is lost and no pair of members is listed: a member meets one centre a
round, and every round holds one more word of context fixed, so there are at most
29.  The windows of the centres start nowhere earlier; all other windows mark their
words, and marked words go.

Words are named by 64-bit hashes of their bytes, and matches compare those names
alone: the classes' own hashes only bring members together.

Cases: null text has no words; documents with fewer words than a window keep
all; a null ``doc_id`` is left out; equal rows that share a
``doc_id`` are judged alike, as one place; an empty table gives no row; further columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathcredit.llm.common import documents, kept_words_digest, longs, mix, record_batch, steps, table
from pathcredit.llm.repeats import Seeds, Sequences, Windows, covered, prepared, surveyed, words_digest

WINDOW_WORDS = 20
SEED_WORDS = 6
WORDS = Windows("words", WINDOW_WORDS, SEED_WORDS, 8)

#: A segment in a class: its anchor's place, the windows in question (they start
#: ``lo`` to ``hi`` words before the anchor) and the words these hold.
_MEMBER = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()), ("ids", pa.list_(pa.int64()))])
_MEMBER_DDL = "key long, doc_id long, at long, lo int, hi int, ids array<long>"


def _lists(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> pa.Array:
    """A list column of stretches of ``values``."""
    edge = np.append(0, np.cumsum(size))
    at = np.arange(edge[-1]) + np.repeat(start - edge[:-1], size)
    return pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(values[at])).cast(_MEMBER.field(5).type)


def _cut(cfg: Windows):
    def run(batches):
        """The wanted segments of some texts."""
        for batch in steps(batches):
            seq = Sequences(batch.column(1), cfg.units)
            found = Seeds(seq, cfg)
            parts = batch.column(2)
            owner = np.repeat(np.arange(len(parts)), parts.value_lengths().to_numpy(zero_copy_only=False))
            key, start, n = (x.to_numpy() for x in parts.flatten().flatten())
            begin = start + seq.first[owner]
            hi = found.anchor[begin] - begin
            ids = _lists(seq.symbols.view(np.int64), begin, n + cfg.length - 1)
            yield record_batch(_MEMBER, key, longs(batch.column(0))[owner], start + hi, (hi - n + 1).astype(np.int32), hi.astype(np.int32), ids)

    return run


def _agreeing(a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray, limit: np.ndarray, step: int) -> np.ndarray:
    """How many words agree, one after another, from ``a[i]`` and ``b[j]`` on in
    direction ``step``, at most ``limit``."""
    out, live = np.zeros(len(i), np.int64), np.flatnonzero(limit > 0)
    while len(live):
        live = live[a[i[live] + step * out[live]] == b[j[live] + step * out[live]]]
        out[live] += 1
        live = live[out[live] < limit[live]]
    return out


def _extended(cfg: Windows):
    def run(batches):
        """Members (with their class's centre) to the classes they go on to."""
        for batch in batches:
            key, doc, at, lo, hi = (batch.column(i).to_numpy() for i in range(5))
            centre_lo, centre_hi = (batch.column(i).to_numpy().astype(np.int64) for i in (6, 7))
            lo, hi = lo.astype(np.int64), hi.astype(np.int64)
            (ids, anchor), (centre, centre_anchor) = (
                (c.flatten().to_numpy(), np.cumsum(size := c.value_lengths().to_numpy().astype(np.int64)) - size + h) for c, h in ((batch.column(5), hi), (batch.column(8), centre_hi))
            )
            # the match: words in common before the anchor's start and from it on
            left = _agreeing(ids, anchor - 1, centre, centre_anchor - 1, np.minimum(hi, centre_hi), -1)
            right = _agreeing(ids, anchor, centre, centre_anchor, cfg.length - np.maximum(lo, centre_lo), 1)
            # windows that start before the match, and those that only end behind it
            before = np.flatnonzero(hi > left)
            last = np.minimum(np.minimum(hi, left), cfg.length - right - 1)
            behind = np.flatnonzero(last >= lo)
            rows = np.concatenate([before, behind])
            new_lo = np.concatenate([np.maximum(lo, left + 1)[before], lo[behind]])
            new_hi = np.concatenate([hi[before], last[behind]])
            word = np.concatenate([ids[(anchor - 1 - left)[before]], ids[(anchor + right)[behind]]])
            turn = np.concatenate([2 * left[before], 2 * right[behind] + 1])
            class_ = mix(mix(key[rows].view(np.uint64) + turn.astype(np.uint64)) ^ word.view(np.uint64)).view(np.int64)
            held = _lists(ids, anchor[rows] - new_hi, new_hi - new_lo + cfg.length)
            yield record_batch(_MEMBER, class_, doc[rows], at[rows], new_lo.astype(np.int32), new_hi.astype(np.int32), held)

    return run


def first_places(seen: DataFrame, cfg: Windows) -> DataFrame:
    """(doc_id, start, n): the windows that start nowhere earlier, as ranges."""
    rows = seen.select("doc_id", F.inline("segments"))
    place = F.min(F.struct("doc_id", "start")).alias("p")
    earliest = table(rows.groupBy("anchor", "segment", "n").agg(place).select("anchor", "segment", "n", "p.*"), "segments")
    mixed = earliest.groupBy("anchor").count().filter("count > 1").select("anchor")
    first = earliest.join(mixed, "anchor", "left_anti").select("doc_id", "start", F.col("n").cast("long").alias("n"))
    wanted = earliest.join(mixed, "anchor", "left_semi").groupBy("doc_id").agg(F.collect_list(F.struct("anchor", "start", "n")).alias("parts"))
    texts = seen.filter("text is not null").select("doc_id", "text").join(wanted, "doc_id")
    members = table(texts.mapInArrow(_cut(cfg), _MEMBER_DDL), "members")
    while count := members.count():
        least = F.min(F.struct("doc_id", "at", "lo", "hi", "ids")).alias("c")
        centres = table(members.groupBy("key").agg(least, F.count("*").alias("n")), "centres", count)
        first = first.unionByName(centres.select("c.doc_id", (F.col("c.at") - F.col("c.hi")).alias("start"), (F.col("c.hi") - F.col("c.lo") + 1).cast("long").alias("n")))
        met = members.join(centres.filter("n > 1").select("key", "c"), "key").filter("doc_id <> c.doc_id or at <> c.at or lo <> c.lo or hi <> c.hi")
        pairs = met.select(*_MEMBER.names, F.col("c.lo").alias("centre_lo"), F.col("c.hi").alias("centre_hi"), F.col("c.ids").alias("centre_ids"))
        members = table(pairs.mapInArrow(_extended(cfg), _MEMBER_DDL), "members")
    return first


def deduplicated(docs: DataFrame, cfg: Windows = WORDS) -> DataFrame:
    """Per document: its words, how many go, the text that stays (its words
    joined by one space; null where nothing goes) and its digest."""
    seen = surveyed(prepared(docs), cfg, words_digest)
    first = first_places(seen, cfg).groupBy("doc_id").agg(F.collect_list(F.struct("start", "n")).alias("first"))
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string()), ("kept_sha256", pa.string())])

    def remove(batches):
        for batch in steps(batches):
            seq = Sequences(batch.column(1), cfg.units)
            drop = np.zeros(len(seq.symbols), bool)
            for d, (own, but) in enumerate(zip(batch.column(2), batch.column(3))):
                lo, hi = seq.first[d], seq.first[d + 1]
                start, n = (own.values.field(i).to_numpy().astype(np.int64) for i in (2, 3))
                b = (np.zeros(0, np.int64),) * 2 if but.values is None else tuple(but.values.field(i).to_numpy() for i in (0, 1))
                drop[lo:hi] = covered(start, n, hi - lo, cfg.length, b)
            gone = np.add.reduceat(np.append(drop, 0), seq.first[:-1]) * (seq.sizes() > 0)
            raw = seq.data.tobytes()
            texts = [
                b" ".join([raw[seq.starts[i] : seq.ends[i]] for i in np.flatnonzero(~drop[a:b]) + a]).decode() if g else None
                for a, b, g in zip(seq.first[:-1], seq.first[1:], gone)
            ]
            yield record_batch(schema, batch.column(0), seq.sizes(), gone, pa.array(texts, pa.string()), kept_words_digest(seq.data, seq.starts, seq.ends, ~drop, seq.first))

    closed = seen.filter("text is null").select("doc_id", F.col("size").alias("n_words"), F.lit(0).cast("long").alias("n_removed"), F.lit(None).cast("string").alias("kept_text"), F.col("digest").alias("kept_sha256"))
    opened = seen.filter("text is not null").select("doc_id", "text", "segments").join(first, "doc_id", "left").select("doc_id", "text", "segments", "first")
    return closed.unionByName(opened.mapInArrow(remove, "doc_id long, n_words long, n_removed long, kept_text string, kept_sha256 string"))


def op4_substrings(spark, sf_dir):
    return deduplicated(documents(spark, sf_dir)).drop("kept_text")


OP4_SQL = f"""
WITH tokens AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents WHERE doc_id IS NOT NULL
), spots AS (
  SELECT doc_id, unnest(range(0, len(w) - {WINDOW_WORDS - 1})) AS i,
         unnest(list_transform(range(0, len(w) - {WINDOW_WORDS - 1}), lambda i: array_to_string(w[i + 1 : i + {WINDOW_WORDS}], ' '))) AS s
  FROM tokens WHERE len(w) >= {WINDOW_WORDS}
), ranked AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS place FROM spots
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + {WINDOW_WORDS})) AS p FROM ranked WHERE place > 1
), placed AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS p FROM tokens
), stays AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n FROM placed ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT t.doc_id, CAST(len(t.w) AS BIGINT) AS n_words, CAST(len(t.w) - coalesce(s.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(s.text, '')) AS kept_sha256
FROM tokens t LEFT JOIN stays s ON s.doc_id = t.doc_id
"""
