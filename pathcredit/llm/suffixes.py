"""Exact substring deduplication on bytes, by merged suffix orders.

Every byte that a 200-byte string covers goes if that string also starts
anywhere else in the corpus.  Candidate windows (:mod:`repeats`) are cut into
segments; equal segments collapse to one with a count.  Distinct segments that
share an anchor can still hold equal windows: they are dealt to groups by their
anchor, each group's shards are sorted alone and their Burrows-Wheeler
transforms merged (:mod:`bwt`); intervals with 200 bytes in common recur.
Segments of an anchor with more than ``HOT_SEGMENTS`` distinct surroundings are
cut to stretches of ``STRETCH`` windows at fixed distances from the anchor, named
by what all windows of the stretch hold: at least 169 of their 200 bytes, so
equal windows have one name and few others share it.  Equal stretches collapse,
and the others of one name are compared as segments are.  Only where a name still
has more than ``HOT_SEGMENTS`` distinct stretches, they are cut to single windows,
counted by name and a hash of 64 bits, so no group grows with the data.

Cases: null text is empty; texts under 200 bytes keep all; a null ``doc_id`` is
left out; equal rows that share a ``doc_id`` are places of their own; an empty table gives no row; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathcredit.llm.bwt import repeated
from pathcredit.llm.common import Spans, documents, longs, mix, record_batch, steps, table, utf8, _SYMBOL
from pathcredit.llm.repeats import Seeds, Sequences, Windows, bytes_digest, covered, prepared, surveyed

LENGTH = 200
BYTES = Windows("bytes", LENGTH, 32, 64)
HOT_SEGMENTS = 128
STRETCH = 32
GROUP_BYTES = 48 << 10

_PARTS = pa.schema([("anchor", pa.int64()), ("copies", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("content", pa.binary()), ("hash", pa.int64())])
_PARTS_DDL = "anchor long, copies long, doc_id long, start long, content binary, hash long"
_SINGLE = pa.schema([(c, pa.int64()) for c in ("anchor", "copies", "doc_id", "start", "hash")])
_SINGLE_DDL = "anchor long, copies long, doc_id long, start long, hash long"
_RANGE_DDL = "doc_id long, start long, n long"


def _stretches(found: Seeds, begin: np.ndarray, n: np.ndarray, cfg: Windows):
    """(segment, first window, windows, name) of the stretches of some segments: runs
    of windows whose distances to their anchor lie between the same multiples of
    ``STRETCH``.  The name is a hash of the units that all windows of such a distance
    share, whatever part of the stretch a segment holds."""
    part = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(part)) + np.repeat(begin - (np.cumsum(n) - n), n)
    anchor = found.anchor[at]
    kind = (anchor - at) // STRETCH
    head = np.flatnonzero(np.append(True, (part[1:] != part[:-1]) | (kind[1:] != kind[:-1]))) if len(part) else np.zeros(0, np.int64)
    size = np.diff(np.append(head, len(part)))
    part, at, anchor, kind = part[head], at[head], anchor[head], kind[head]
    far = np.minimum((kind + 1) * STRETCH, cfg.seeds) - 1  # the largest distance
    name = found.spans.hash(anchor - kind * STRETCH, anchor - far + cfg.length)
    return part, at, size, mix(name + kind.astype(np.uint64))


def _lone(group: pa.Table) -> pa.Table:
    """Windows of one group's segments that stand nowhere else, as ranges."""
    group = group.combine_chunks()
    content = pa.concat_arrays(group.column("content").chunks)
    data, offsets = utf8(content)
    again = repeated(data, offsets, LENGTH)
    once = np.flatnonzero(group.column("copies").to_numpy() == 1)
    doc, start = group.column("doc_id").to_numpy(), group.column("start").to_numpy()
    out: list[list[int]] = [[], [], []]
    for i in once.tolist():
        lone = ~again[offsets[i] : offsets[i + 1] - LENGTH + 1]
        edge = np.flatnonzero(np.diff(np.concatenate([[0], lone.astype(np.int8), [0]])))
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
            out[0].append(int(doc[i]))
            out[1].append(int(start[i]) + a)
            out[2].append(b - a)
    return pa.table([pa.array(x, pa.int64()) for x in out], ["doc_id", "start", "n"])


def _cut(batch: pa.RecordBatch, cfg: Windows) -> pa.RecordBatch:
    """The segments that ``parts`` of some documents names, with their bytes; hot ones
    as stretches, with a hash."""
    seq = Sequences(batch.column(1), cfg.units)
    found = Seeds(seq, cfg)
    parts = batch.column(2)
    owner = np.repeat(np.arange(len(parts)), parts.value_lengths().to_numpy(zero_copy_only=False))
    anchor, start, n, copies, split = (x.to_numpy(zero_copy_only=False) for x in parts.flatten().flatten())
    n, doc = n.astype(np.int64), longs(batch.column(0))
    begin = start + seq.first[owner]
    hash_ = np.zeros(len(n), np.int64)
    if split.any():
        hot_ = np.flatnonzero(split)
        part, at, size, name = _stretches(found, begin[hot_], n[hot_], cfg)
        part = hot_[part]
        content = found.spans.hash(at, at + size + cfg.length - 1).view(np.int64)
        cold = np.flatnonzero(~split)
        take = np.append(cold, part)
        anchor, hash_ = np.append(anchor[cold], name.view(np.int64)), np.append(hash_[cold], content)
        begin, n, owner, copies, split = np.append(begin[cold], at), np.append(n[cold], size), owner[take], copies[take], np.arange(len(take)) >= len(cold)
    raw = seq.data.tobytes()
    texts = [raw[a:b] for a, b in zip(begin.tolist(), (begin + n + cfg.length - 1).tolist())]
    return record_batch(_PARTS, anchor, copies, doc[owner], begin - seq.first[owner], pa.array(texts, pa.binary()), pa.array(hash_, pa.int64(), mask=~split))


def lone_windows(seen: DataFrame, cfg: Windows, hot: int = HOT_SEGMENTS) -> DataFrame:
    """(doc_id, start, n): candidate windows that do not recur, as ranges."""
    rows = seen.select("doc_id", F.inline("segments"))
    distinct = rows.groupBy("anchor", "segment", "n").agg(F.min(F.struct("doc_id", "start")).alias("p"), F.count("*").alias("copies"))
    distinct = table(distinct.select("anchor", "n", "copies", "p.*"), "segments")
    kinds = distinct.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("copies").alias("least"))
    judged = distinct.join(kinds.filter("least = 1"), "anchor")
    alone = judged.filter("kinds = 1").select("doc_id", "start", F.col("n").cast("long").alias("n"))
    wanted = judged.filter("kinds > 1").groupBy("doc_id").agg(F.collect_list(F.struct("anchor", "start", "n", "copies", (F.col("kinds") > hot).alias("hot"))).alias("parts"))

    def cut(batches):
        for batch in steps(batches, cfg.step_bytes):
            yield _cut(batch, cfg)

    def single(batches):
        for batch in steps(batches, cfg.step_bytes, "content"):
            data, offsets = utf8(batch.column(4))
            n = np.diff(offsets) - cfg.length + 1
            part = np.repeat(np.arange(len(n)), n)
            inner = np.arange(len(part)) - np.repeat(np.cumsum(n) - n, n)
            at = offsets[part] + inner
            anchor, copies, doc, start = (batch.column(i).to_numpy() for i in range(4))
            yield record_batch(_SINGLE, anchor[part], copies[part], doc[part], start[part] + inner, Spans(_SYMBOL[data]).hash(at, at + cfg.length).view(np.int64))

    texts = seen.filter("text is not null").select("doc_id", "text").join(wanted, "doc_id")
    parts = table(texts.mapInArrow(cut, _PARTS_DDL), "parts")
    segment = ["anchor", "copies", "doc_id", "start", "content"]
    stretches = parts.filter("hash is not null").groupBy("anchor", "hash").agg(F.sum("copies").alias("copies"), F.min(F.struct("doc_id", "start", "content")).alias("p"))
    stretches = table(stretches.select("anchor", "copies", "p.*"), "stretches")
    kinds = stretches.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("copies").alias("least"))
    judged = stretches.join(kinds.filter("least = 1"), "anchor")
    alone = alone.unionByName(judged.filter("kinds = 1").select("doc_id", "start", (F.length("content") - cfg.length + 1).cast("long").alias("n")))
    compared = parts.filter("hash is null").select(segment).unionByName(judged.filter(f"kinds > 1 and kinds <= {hot}").select(segment))
    size = compared.agg(F.sum(F.length("content"))).first()[0] or 0
    groups = max(1, size // GROUP_BYTES)
    merged = compared.withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(groups))).groupBy("bucket").applyInArrow(_lone, _RANGE_DDL)
    windows = judged.filter(f"kinds > 1 and kinds > {hot}").select(segment).mapInArrow(single, _SINGLE_DDL)
    once = windows.groupBy("anchor", "hash").agg(F.sum("copies").alias("copies"), F.min(F.struct("doc_id", "start")).alias("p")).filter("copies = 1").select("p.*", F.lit(1).cast("long").alias("n"))
    return alone.unionByName(merged).unionByName(once)


def deduplicated(docs: DataFrame, cfg: Windows = BYTES, hot: int = HOT_SEGMENTS) -> DataFrame:
    """Per document: its bytes, how many go in how many runs, the bytes that stay
    (null where nothing goes) and their digest."""
    seen = surveyed(prepared(docs), cfg, bytes_digest)
    lone = lone_windows(seen, cfg, hot).groupBy("doc_id").agg(F.collect_list(F.struct("start", "n")).alias("lone"))
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary()), ("kept_sha256", pa.string())])

    def remove(batches):
        for batch in steps(batches):
            data, offsets = utf8(batch.column(1))
            gone, runs, kept, digests = [], [], [], []
            for d, (own, but) in enumerate(zip(batch.column(2), batch.column(3))):
                text = data[offsets[d] : offsets[d + 1]]
                start, n = (own.values.field(i).to_numpy().astype(np.int64) for i in (2, 3))
                b = (np.zeros(0, np.int64),) * 2 if but.values is None else tuple(but.values.field(i).to_numpy() for i in (0, 1))
                drop = covered(start, n, len(text), cfg.length, b)
                stays = text[~drop].tobytes()
                gone.append(int(drop.sum()))
                runs.append(int((np.diff(np.concatenate([[0], drop.astype(np.int8)])) == 1).sum()))
                kept.append(stays if gone[-1] else None)
                digests.append(hashlib.sha256(stays).hexdigest())
            yield record_batch(schema, batch.column(0), np.diff(offsets), gone, runs, pa.array(kept, pa.binary()), digests)

    zero = F.lit(0).cast("long")
    closed = seen.filter("text is null").select("doc_id", F.col("size").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), F.lit(None).cast("binary").alias("kept"), F.col("digest").alias("kept_sha256"))
    opened = seen.filter("text is not null").select("doc_id", "text", "segments").join(lone, "doc_id", "left").select("doc_id", "text", "segments", "lone")
    return closed.unionByName(opened.mapInArrow(remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"))


def op2_suffixes(spark, sf_dir):
    return deduplicated(documents(spark, sf_dir)).drop("kept")


OP2_SQL = f"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents WHERE doc_id IS NOT NULL
), blocks AS (
  SELECT r, h, unnest(range(0, len(h) // 2 - {LENGTH - 1}, {LENGTH})) AS b FROM texts WHERE len(h) // 2 >= {LENGTH}
), parts AS (
  SELECT r, b, substr(h, 2 * b + 1, {4 * LENGTH - 2}) AS h FROM blocks
), spots AS (
  SELECT r, b, h, unnest(range(0, least({LENGTH}, len(h) // 2 - {LENGTH - 1}))) AS i FROM parts
), named AS (
  SELECT r, b + i AS i, md5_number(substr(h, 2 * i + 1, {2 * LENGTH})) AS s FROM spots
), again AS (
  SELECT s FROM named GROUP BY s HAVING count(*) > 1
), hits AS (
  SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM named SEMI JOIN again USING (s)
), runs AS (
  SELECT r, i, sum(CASE WHEN before IS NULL OR before + {LENGTH} < i THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i) AS run FROM hits
), spans AS (
  SELECT r, run, min(i) AS a, max(i) + {LENGTH} AS b FROM runs GROUP BY r, run
), gaps AS (
  SELECT r, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS a, a AS b FROM spans
  UNION ALL
  SELECT t.r, coalesce(max(s.b), 0), len(any_value(t.h)) // 2 FROM texts t LEFT JOIN spans s ON s.r = t.r GROUP BY t.r
), stays AS (
  SELECT g.r, string_agg(substr(t.h, CAST(2 * g.a + 1 AS BIGINT), CAST(2 * (g.b - g.a) AS BIGINT)), '' ORDER BY g.a) AS h
  FROM gaps g JOIN texts t ON t.r = g.r GROUP BY g.r
), counted AS (
  SELECT r, count(*) AS n FROM spans GROUP BY r
)
SELECT t.doc_id, CAST(len(t.h) // 2 AS BIGINT) AS n_bytes, CAST((len(t.h) - len(k.h)) // 2 AS BIGINT) AS n_removed,
       CAST(coalesce(c.n, 0) AS BIGINT) AS n_spans, sha256(unhex(k.h)) AS kept_sha256
FROM texts t JOIN stays k ON k.r = t.r LEFT JOIN counted c ON c.r = t.r
"""
