"""Candidate windows for repeat search over whole texts.

A window is ``length`` consecutive units (words or bytes) of one document.  A
seed is the hash of ``gram`` units; a window's anchor is its smallest seed
(winnowing), and every seed under a fixed threshold is kept as well.  Equal
windows hold the same seeds, so a window can only recur if its anchor and all
its kept seeds recur.  Seeds are counted over the whole corpus (partial sums
before the shuffle), and only documents with such windows go on, with their
text, to the exact step.

Neighbouring candidate windows with one anchor form a segment of bounded
length, with a hash of its whole content: equal segments collapse before any
comparison, so a passage that stands in a third of all documents is one row
there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathcredit.llm.common import STEP_BYTES, Spans, content_hashes, grams, ids_of, kept_words_digest, longs, mix, record_batch, ship, steps, table, utf8, words, _SYMBOL


@dataclass(frozen=True)
class Windows:
    """units: ``words`` or ``bytes``; seeds under ``2^64 / sparse`` are kept."""

    units: str
    length: int
    gram: int
    sparse: int

    @property
    def seeds(self) -> int:
        """Seeds in one window."""
        return self.length - self.gram + 1

    @property
    def step_bytes(self) -> int:
        """Text that one step holds: a byte has a symbol, a seed and an anchor of
        eight bytes each and more while they are made, a word has them only once."""
        return STEP_BYTES // 4 if self.units == "bytes" else STEP_BYTES


class Sequences:
    """The unit sequences of one batch of texts."""

    def __init__(self, column: pa.Array, units: str):
        self.data, self.offsets = utf8(column)
        if units == "words":
            self.starts, self.ends, self.first = words(self.data, self.offsets)
            self.symbols = content_hashes(self.data, self.starts, self.ends)
        else:
            self.starts = self.ends = None
            self.first = self.offsets
            self.symbols = _SYMBOL[self.data]

    def sizes(self) -> np.ndarray:
        return np.diff(self.first)


def _smallest(packed: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` neighbours."""
    span = 1
    while span * 2 <= width:
        packed = np.minimum(packed[:-span], packed[span:])  # of twice as many
        span *= 2
    if width > span:
        packed = np.minimum(packed[: len(packed) - (width - span)], packed[width - span :])
    return packed


class Seeds:
    """Seeds, anchors and windows of one batch; positions are unit indexes in
    the batch."""

    def __init__(self, seq: Sequences, cfg: Windows):
        n, first = len(seq.symbols), seq.first
        self.spans = Spans(seq.symbols)
        self.hash = self.spans.every(cfg.gram)
        count = len(self.hash)
        whole = np.ones(count, bool)  # seeds within one document
        self.inside = np.ones(max(0, n - cfg.length + 1), bool)  # windows within one document
        # starts less than a seed's (window's) length before a document's end reach beyond it
        for begin, end in zip(first[:-2].tolist(), first[1:-1].tolist()):
            whole[max(begin, end - cfg.gram + 1) : end] = False
            self.inside[max(begin, end - cfg.length + 1) : end] = False
        self.kept = self.hash < np.uint64((1 << 64) // cfg.sparse)
        self.kept &= whole
        bits = np.uint64(max(22, n.bit_length()))
        low = (np.uint64(1) << bits) - np.uint64(1)
        packed = self.hash & ~low
        packed |= np.arange(count, dtype=np.uint64)
        packed[~whole] = ~np.uint64(0)
        best = _smallest(packed, cfg.seeds) if len(self.inside) else packed[:0]
        best &= low
        self.anchor = best.view(np.int64)  # of every window
        inside = self.inside
        chosen = self.kept.copy()
        chosen[self.anchor[inside]] = True
        self.at = np.flatnonzero(chosen)
        self.first = np.searchsorted(self.at, first)  # per document: its first seed (n + 1)

    def candidates(self, again: np.ndarray, cfg: Windows) -> np.ndarray:
        """Windows whose anchor and kept seeds all recur; ``again``: which of
        ``at`` recur."""
        if not len(self.inside):
            return self.inside
        recurs = np.zeros(len(self.hash), bool)
        recurs[self.at[again]] = True
        lone = np.zeros(len(self.hash) + 1, np.int32)
        np.cumsum(self.kept & ~recurs, out=lone[1:])
        w = len(self.inside)
        return self.inside & (lone[cfg.seeds : cfg.seeds + w] == lone[:w]) & recurs[self.anchor * self.inside]


_SEEDS = pa.schema([("seed", pa.int64()), ("doc_id", pa.int64()), ("place", pa.int32())])


def seeds(docs: DataFrame, cfg: Windows) -> DataFrame:
    """(seed, doc_id, place): place counts a document's seeds."""

    def run(batches):
        for batch in steps(batches, cfg.step_bytes):
            found = Seeds(Sequences(batch.column(1), cfg.units), cfg)
            owner = ids_of(found.first)
            place = np.arange(len(owner)) - found.first[owner]
            yield record_batch(_SEEDS, found.hash[found.at].view(np.int64), longs(batch.column(0))[owner], place.astype(np.int32))

    return docs.mapInArrow(run, "seed long, doc_id long, place int")


def recurring(docs: DataFrame, cfg: Windows) -> DataFrame:
    """(doc_id, places): each document's seeds that stand at two places or more
    in the corpus."""
    found = seeds(docs, cfg)
    # written, so that the join has a shuffle of its own on either side and a hot seed can be split
    again = table(found.groupBy("seed").count().filter("count > 1").select("seed"), "again")
    return found.join(again, "seed", "left_semi").groupBy("doc_id").agg(F.collect_set("place").alias("places"))


_SEGMENT = pa.struct([("anchor", pa.int64()), ("segment", pa.int64()), ("start", pa.int64()), ("n", pa.int32())])
_SEGMENT_DDL = "array<struct<anchor:long,segment:long,start:long,n:int>>"


def segments(found: Seeds, seq: Sequences, again: np.ndarray, cfg: Windows):
    """Runs of candidate windows with one anchor: (anchor hash, segment hash,
    first window, number of windows)."""
    at = np.flatnonzero(found.candidates(again, cfg))
    if not len(at):
        none = np.zeros(0, np.int64)
        return none.view(np.uint64), none.view(np.uint64), none, none
    anchor = found.anchor[at]
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) != 1) | (np.diff(anchor) != 0)
    head = np.flatnonzero(new)
    start, n = at[head], np.diff(np.append(head, len(at)))
    anchor = anchor[head]
    content = found.spans.hash(start, start + n + cfg.length - 1)
    return found.hash[anchor], mix(content + (anchor - start).astype(np.uint64)), start, n


def surveyed(docs: DataFrame, cfg: Windows, digest: Callable[[Sequences, np.ndarray], list[str]]) -> DataFrame:
    """One row a document: its size in units, and either the digest of the whole
    text (no candidate window) or its text and segments."""
    schema = pa.schema([("doc_id", pa.int64()), ("size", pa.int64()), ("text", pa.string()), ("digest", pa.string()), ("segments", pa.list_(_SEGMENT))])

    def run(batches):
        for batch in steps(batches, cfg.step_bytes):
            seq = Sequences(batch.column(1), cfg.units)
            found = Seeds(seq, cfg)
            again = np.zeros(len(found.at), bool)
            places = batch.column(2)
            if len(flat := places.flatten()):
                lists = places.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                again[np.repeat(found.first[:-1], lists) + flat.to_numpy()] = True
            anchor, content, start, n = segments(found, seq, again, cfg)
            first = np.searchsorted(start, seq.first)
            owner = ids_of(first)
            open_ = np.diff(first) > 0
            rows = pa.StructArray.from_arrays([pa.array(anchor.view(np.int64)), pa.array(content.view(np.int64)), pa.array(start - seq.first[owner]), pa.array(n.astype(np.int32))], fields=list(_SEGMENT))
            done = digest(seq, ~open_)
            yield record_batch(
                schema,
                batch.column(0),
                seq.sizes(),
                pa.array([x if o else None for x, o in zip(batch.column(1).to_pylist(), open_)], pa.string()),
                done,
                pa.ListArray.from_arrays(pa.array(first, pa.int32()), rows).cast(schema.field(4).type),
            )

    whole = docs.join(recurring(docs, cfg), "doc_id", "left").select("doc_id", "text", "places")
    return table(whole.mapInArrow(run, f"doc_id long, size long, text string, digest string, segments {_SEGMENT_DDL}"), f"surveyed-{cfg.units}")


def prepared(docs: DataFrame) -> DataFrame:
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).filter("doc_id is not null")


def words_digest(seq: Sequences, wanted: np.ndarray) -> list[str | None]:
    out = kept_words_digest(seq.data, seq.starts, seq.ends, wanted[ids_of(seq.first)], seq.first)
    return [x if w else None for x, w in zip(out, wanted)]


def bytes_digest(seq: Sequences, wanted: np.ndarray) -> list[str | None]:
    raw = memoryview(seq.data)
    return [hashlib.sha256(raw[a:b]).hexdigest() if w else None for a, b, w in zip(seq.offsets[:-1].tolist(), seq.offsets[1:].tolist(), wanted)]


def covered(starts: np.ndarray, n: np.ndarray, size: int, length: int, but: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Units covered by the windows of ranges (first window, count), without the
    windows of the ranges ``but``."""
    marks = np.zeros(size + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + n, -1)
    hit = np.cumsum(marks[:size]) > 0
    marks[:] = 0
    np.add.at(marks, but[0], 1)
    np.add.at(marks, but[0] + but[1], -1)
    at = np.flatnonzero(hit & (np.cumsum(marks[:size]) == 0))
    marks[:] = 0
    np.add.at(marks, at, 1)
    np.add.at(marks, at + length, -1)
    return np.cumsum(marks[:size]) > 0
