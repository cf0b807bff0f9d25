"""Importance resampling of documents towards a target distribution.

Words (A-Z lower-cased, letters, digits and all beyond ASCII) form runs of one to
three; a run's bucket is the CRC-32 of its bytes, modulo 10,000.  A bucket's gain is
the logarithm of its smoothed share in the target texts over that in the corpus;
a document's weight sums the gains of all its runs.  Gumbel noise from a hash of
the ``doc_id`` makes the highest scores a draw without replacement.

Texts are cut by Arrow kernels (``ascii_lower``, ``split_pattern_regex``,
``list_flatten``, ``dictionary_encode``).  A run is its shorter run and the next
word: shifted dictionary indices form pairs, each distinct pair gets its CRC once,
from the CRCs of its halves, and gains are taken by index and summed by segment.

Corpus counts come from one pass over all texts, weights from a second; the 10,000
gains are all that the driver sees and sends.  Ranks come from a range-partitioned
sort and the sizes of its partitions.

Cases: null text has no words, weight 0 and is never drawn; a null ``doc_id`` is
left out and counts nowhere; repeated rows are scored and ranked each; equal scores
go by ``doc_id``, then by ``n_features`` and ``weight``; an empty corpus gives no
row, an empty target a smoothed one; further columns are ignored.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pathcredit.llm.common import documents, partitions, ship, steps, table

BUCKETS = 10_000
LONGEST_RUN = 3
LEAST_WORDS = 20
DRAWN_PERCENT = 5
SEED = 42

# What parts words (all ASCII but letters and digits), and the CRC-32
# polynomial, its bits reversed.
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_POLYNOMIAL = 0xEDB88320

_SHIFTS = 64  # bytes that one table lookup moves a CRC at most
_SPACE = np.uint32(zlib.crc32(b" "))
_tables: list[np.ndarray] = []


def _shift_tables() -> np.ndarray:
    """(shift, byte, value): what a CRC's byte becomes when ``shift`` zero bytes follow."""
    if not _tables:
        step = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            step = np.where(step & 1, (step >> 1) ^ np.uint32(_POLYNOMIAL), step >> 1)
        at = np.arange(256, dtype=np.uint32) << (np.arange(4, dtype=np.uint32) * 8)[:, None]
        rows = [at]
        for _ in range(_SHIFTS):
            rows.append(at := step[at & 255] ^ (at >> 8))
        _tables.append(np.stack(rows))
    return _tables[0]


def shifted(crc: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The CRCs' share in those of the same bytes followed by ``size`` others."""
    rows = _shift_tables()

    def move(c, n):
        return rows[n, 0, c & 255] ^ rows[n, 1, (c >> 8) & 255] ^ rows[n, 2, (c >> 16) & 255] ^ rows[n, 3, c >> 24]

    out, left = move(crc, np.minimum(size, _SHIFTS)), size - np.minimum(size, _SHIFTS)
    while (more := np.flatnonzero(left)).size:  # words of over 64 bytes
        n = np.minimum(left[more], _SHIFTS)
        out[more] = move(out[more], n)
        left[more] -= n
    return out


def words(column: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """(words, documents): all words of a column, and the row of each."""
    lists = pc.split_pattern_regex(pc.ascii_lower(column.fill_null("")), _BETWEEN)
    flat, owner = pc.list_flatten(lists), pc.list_parent_indices(lists)
    solid = pc.not_equal(pc.binary_length(flat), 0)
    return pc.dictionary_encode(flat.filter(solid)), owner.filter(solid).to_numpy()


def runs(column: pa.Array, longest: int = LONGEST_RUN):
    """For runs of one word, two, and so on: (bucket of every distinct run, its index
    at every place, the row of every place)."""
    encoded, owner = words(column)
    spelled = encoded.dictionary
    at = encoded.indices.to_numpy().astype(np.int64)
    size = pc.binary_length(spelled).to_numpy().astype(np.int64)
    crc = np.fromiter((zlib.crc32(w.as_buffer()) for w in spelled), np.uint32, len(spelled))
    kinds, run, run_crc, last = len(spelled), at, crc, np.arange(len(at))
    yield (crc % BUCKETS).astype(np.int64), at, owner
    for _ in range(1, longest):
        inside = last + 1 < len(at)
        run, last = run[inside], last[inside]
        inside = owner[last] == owner[last + 1]
        run, last = run[inside], last[inside] + 1
        pairs = pc.dictionary_encode(pa.array(run * kinds + at[last]))
        head, word = np.divmod(pairs.dictionary.to_numpy(), max(1, kinds))
        run_crc = shifted(shifted(run_crc[head], np.ones(len(head), np.int64)) ^ _SPACE, size[word]) ^ crc[word]
        run = pairs.indices.to_numpy().astype(np.int64)
        yield (run_crc % BUCKETS).astype(np.int64), run, owner[last]


def bucket_counts(texts: DataFrame) -> dict[int, int]:
    """Runs in each bucket, over all rows of (text)."""

    def count(batches):
        held = np.zeros(BUCKETS, np.int64)
        for batch in steps(batches):
            for bucket, run, _ in runs(batch.column(0)):
                np.add.at(held, bucket, np.bincount(run, minlength=len(bucket)))
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(held[some])], ["bucket", "n"])

    sums = texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    return {r[0]: r[1] for r in sums.collect()}  # at most BUCKETS rows


def gains(corpus: dict[int, int], target: dict[int, int]) -> np.ndarray:
    every, wanted = float(sum(corpus.values()) + BUCKETS), float(sum(target.values()) + BUCKETS)
    ratio = [(target.get(b, 0) + 1.0) * every / ((corpus.get(b, 0) + 1.0) * wanted) for b in range(BUCKETS)]
    return np.array([math.floor(1000 * math.log(x)) for x in ratio], np.int64)


def weighted(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight)"""
    values = pa.array(gain)

    def weigh(batches):
        for batch in steps(batches):
            n, features, weight = (np.zeros(len(batch), np.int64) for _ in range(3))
            for i, (bucket, run, owner) in enumerate(runs(batch.column(1))):
                found = pc.take(values, pa.array(bucket[run])).to_numpy()
                edge = np.searchsorted(owner, np.arange(len(batch) + 1))
                weight += np.diff(np.concatenate([[0], np.cumsum(found)])[edge])
                features += np.diff(edge)
                if i == 0:
                    n += np.diff(edge)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(features), pa.array(weight)], ["doc_id", "n_words", "n_features", "weight"])

    return docs.select("doc_id", "text").mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: F.Column, seed: int) -> F.Column:
    """A standard Gumbel draw in thousandths, from a hash of the id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def with_rank(rows: DataFrame, order: list[F.Column]) -> DataFrame:
    """``rows`` with ``rank``, their place in a total order: a sort by ranges, written
    once (its bounds are sampled), and the sizes of the ranges."""
    ranged = rows.repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
    placed = table(ranged.withColumn("part", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), "ranked")
    sizes = placed.groupBy("part").agg(F.count("*").alias("rows"))  # a row a partition
    before = sizes.select("part", (F.sum("rows").over(Window.orderBy("part")) - F.col("rows")).alias("before"))
    return placed.join(F.broadcast(before), "part").withColumn("rank", F.col("before") + F.col("place") + 1).drop("part", "place", "before")


def resampled(docs: DataFrame, target: DataFrame, percent: int = DRAWN_PERCENT, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank); ``rank`` of the drawn documents only."""
    ship(docs.sparkSession)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null")
    gain = gains(bucket_counts(own), bucket_counts(target))
    scored = table(weighted(own, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "scored")
    able = scored.filter(F.col("n_words") >= LEAST_WORDS)
    drawn = percent * able.count() // 100
    names = ["doc_id", "n_features", "weight", "score"]
    order = [F.col("score").desc(), F.col("doc_id"), F.col("n_features"), F.col("weight")]
    ranked = with_rank(able.select(*names), order).withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    others = scored.filter(F.col("n_words") < LEAST_WORDS).select(*names, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*names, "rank").unionByName(others)


def op12_resampling(spark, sf_dir):
    return resampled(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
