"""Near-duplicate documents by SuperMinHash, banding, verification and union-find.

A document is the set of its distinct five-word shingles (A-Z lower-cased).
SuperMinHash draws, for every element, one random value for each rank of a
random permutation of the registers: rank r contributes ``r + uniform`` to the
register the permutation names, registers keep minima, and the ranks stop as
soon as no register can still fall.  Documents with equal sets collapse first;
:mod:`lsh` finds and confirms the links between different sets, and
:mod:`components` groups them.

Cases: null or empty text has an empty set and links with nothing; under five
words the whole sequence is one shingle; a null ``doc_id`` is left out; rows
that share a ``doc_id`` share their links, one result row each; an empty table
gives no row; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathcredit.llm.common import Spans, binary_array, content_hashes, documents, ids_of, lower, mix, record_batch, ship, steps, table, utf8, words
from pathcredit.llm.components import components
from pathcredit.llm.lsh import BITS, Near, mixed_bands, packed, similar_sets

_STEP = 0x9E3779B97F4A7C15
_FULL = (1 << 64) - 1

#: Contract of the registered query: 85 of 100.
CONTRACT = Near(85, shingle=5, bands=25, rows=5)
#: Pipeline: 80 of 100.
CORPUS = Near(80, shingle=5, bands=32, rows=4)


def shingle_sets(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(elements, first): the distinct shingle hashes of every document, sorted."""
    data, offsets = utf8(column)
    data = lower(data)
    starts, ends, first = words(data, offsets)
    spans = Spans(content_hashes(data, starts, ends))
    count = np.diff(first)
    n = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    base = np.cumsum(n) - n
    at = np.arange(n.sum()) - np.repeat(base - first[:-1], n)
    size = np.repeat(np.minimum(count, k), n)
    owner = np.repeat(np.arange(len(n), dtype=np.uint64), n)
    keys = np.sort((owner << np.uint64(BITS)) | (spans.hash(at, at + size) >> np.uint64(64 - BITS)))
    keys = keys[np.append(True, keys[1:] != keys[:-1])] if len(keys) else keys
    return keys & np.uint64((1 << BITS) - 1), np.searchsorted(keys, np.arange(len(n) + 1, dtype=np.uint64) << np.uint64(BITS))


def super_min_hash(elements: np.ndarray, first: np.ndarray, registers: int) -> np.ndarray:
    """(documents, registers): a hash of each register's rank * 2^32 + uniform;
    documents without elements keep the largest value."""
    docs = len(first) - 1
    out = np.full(docs * registers, ~np.uint64(0))
    seeds, owner = mix(elements + np.uint64(_STEP)), ids_of(first)
    ranks = np.tile(np.arange(registers, dtype=np.uint8 if registers <= 256 else np.int32), (len(elements), 1))
    live = np.arange(len(elements))
    for r in range(registers):
        draw = mix(seeds[live] + np.uint64((r + 1) * _STEP & _FULL))
        pick = r + ((draw >> np.uint64(32)) % np.uint64(registers - r)).astype(np.int64)
        name = ranks[live, pick]
        ranks[live, pick] = ranks[live, r]
        value = np.uint64(r << 32) | (draw & np.uint64(0xFFFFFFFF))
        np.minimum.at(out, owner[live] * registers + name, value)
        if r + 1 < registers:  # a document all of whose registers hold rank r or less is done
            settled = out.reshape(docs, registers).max(1) < np.uint64((r + 1) << 32)
            live = live[~settled[owner[live]]]
            if not len(live):
                break
    return mix(out.reshape(docs, registers))


_SIGNED = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("set_a", pa.int64()), ("set_b", pa.int64()), ("bands", pa.list_(pa.int64()))])
_SIGNED_DDL = "doc_id long, n long, set_a long, set_b long, bands array<long>"


def signatures(docs: DataFrame, near: Near) -> DataFrame:
    """One row a document: set size, 128-bit hash of the set, and band values."""

    def run(batches):
        for batch in steps(batches, 1 << 20):
            for at in range(0, len(batch), 2000):
                part = batch.slice(at, 2000)
                elements, first = shingle_sets(part.column(1), near.shingle)
                sums = [np.concatenate([[np.uint64(0)], np.cumsum(mix(elements ^ np.uint64(salt)), dtype=np.uint64)]) for salt in (0x5BD1E995, 0xC2B2AE35)]
                set_a, set_b = ((s[first[1:]] - s[first[:-1]]).view(np.int64) for s in sums)
                keys = mixed_bands(super_min_hash(elements, first, near.registers), near).view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(first)) * near.bands, pa.int32()), pa.array(keys.ravel()))
                yield record_batch(_SIGNED, part.column(0), np.diff(first), set_a, set_b, lists.cast(_SIGNED.field(4).type))

    return docs.mapInArrow(run, _SIGNED_DDL)


def full_sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(rep, elements, roles) of the documents that ``wanted`` (rep, roles) names."""
    roles = wanted.schema["roles"].dataType.simpleString()

    def run(batches):
        for batch in steps(batches):
            elements, first = shingle_sets(batch.column(1), k)
            yield pa.RecordBatch.from_arrays([batch.column(0), binary_array(packed(elements), first * (BITS // 8)), batch.column(2)], ["rep", "elements", "roles"])

    texts = docs.join(wanted.withColumnRenamed("rep", "doc_id"), "doc_id").select("doc_id", "text", "roles")
    return texts.mapInArrow(run, f"rep long, elements binary, roles {roles}")


def near_duplicates(docs: DataFrame, near: Near = CONTRACT) -> DataFrame:
    """Per document: set size, component (its smallest document) and whether it
    is the one that stays."""
    ship(docs.sparkSession)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null")
    signed = table(signatures(own, near), "signed")
    sets = table(signed.filter("n > 0").groupBy("set_a", "set_b", "n").agg(F.min("doc_id").alias("rep")), "distinct-sets")
    classes = table(signed.join(sets, ["set_a", "set_b", "n"], "left").select("doc_id", "n", "rep"), "classes")
    reps = classes.filter("doc_id = rep").select("rep").distinct()
    values = signed.join(reps, signed.doc_id == reps.rep, "left_semi").select(F.col("doc_id").alias("rep"), F.posexplode("bands").alias("band", "key"))
    links = similar_sets(values, lambda wanted: full_sets(own, wanted, near.shingle), super_min_hash, near)
    label = components(links)
    found = F.coalesce("component", "rep", "doc_id").alias("component_id")
    joined = classes.join(label, classes.rep == label.node, "left").select("doc_id", F.col("n").alias("n_shingles"), found)
    return joined.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def op1_minhash(spark, sf_dir):
    return near_duplicates(documents(spark, sf_dir))


OP1_SQL = f"""
WITH RECURSIVE tokens AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents WHERE doc_id IS NOT NULL
), spots AS (
  SELECT doc_id, w, unnest(range(0, greatest(1, len(w) - 4))) AS i FROM tokens WHERE len(w) > 0
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i + 1 : i + 5], ' ') AS s FROM spots
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT u, v FROM pairs p JOIN sizes a ON a.doc_id = u JOIN sizes b ON b.doc_id = v
  WHERE 100 * p.n >= {CONTRACT.percent} * (a.n + b.n - p.n)
), both_ways AS (
  SELECT u, v FROM links UNION ALL SELECT v, u FROM links
), reach(u, v) AS (
  SELECT u, v FROM both_ways UNION SELECT r.u, b.v FROM reach r JOIN both_ways b ON b.u = r.v
), lowest AS (
  SELECT u, min(v) AS v FROM reach GROUP BY u
)
SELECT t.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, least(t.doc_id, coalesce(l.v, t.doc_id)) AS component_id,
       t.doc_id <= coalesce(l.v, t.doc_id) AS kept
FROM tokens t LEFT JOIN sizes s ON s.doc_id = t.doc_id LEFT JOIN lowest l ON l.u = t.doc_id
"""
