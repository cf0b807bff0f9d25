"""Shared pieces of the corpus operators: work tables on the cluster's shared
folder, shipping the package to the workers, and vectorised text primitives
(words, n-grams and span hashes over whole Arrow batches, no per-word Python).

All hashes are 64-bit and computed from the bytes alone, so equal byte strings
hash alike in every task, on every machine and in every run.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid
import zipfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathcredit.session import shuffle_partitions

#: Text bytes that one vectorised step holds at most (one document at least):
#: bounds a worker's memory whatever the Arrow batch size.
STEP_BYTES = 2 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SYMBOL = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_powers: dict[int, np.ndarray] = {}


# ------------------------------------------------------------------ session


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and work tables: the cluster's
    ``spark.checkpoint.dir``; set here only where it is unset and the master is
    this machine (tests)."""
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = sc.getCheckpointDir() or tempfile.mkdtemp(prefix="llm-checkpoints-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, which need not have it on their
    path (once a session)."""
    sc = spark.sparkContext
    if getattr(sc, "_llm_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="ship-"), f"{os.path.basename(root)}_ship.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    sc._llm_shipped = True


#: Rows that a file holds at least, where a table's size is known.
_FILE_ROWS = 1 << 17


def table(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table: lineage
    ends there, and a lost executor costs its own tasks only.

    ``rows``: of an aggregate (evenly dealt) of at most so many rows; it gets no
    more files than these need.  On a plain local file system every file costs its
    executor three commands, which set the modes of its folder, of itself and of its checksum."""
    spark = df.sparkSession
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // _FILE_ROWS)))
    path = f"{shared_dir(spark)}/llm-work/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return shuffle_partitions(spark)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def smallest_hashes(df: DataFrame, key: str, rows: int) -> DataFrame:
    """At most ``rows`` rows: those with the smallest hashes of ``key``.  A bound on
    the hash, from a count, thins the rows in their tasks first, so that all tasks
    together send the driver little more than ``rows``."""
    total = df.count()
    share = min(1.0, (rows + 4 * rows**0.5) / max(1, total))
    place = F.pmod(F.xxhash64(key, F.lit(7)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return df.withColumn("_place", place).filter(F.col("_place") < share).orderBy("_place", key).limit(rows).drop("_place")


#: Bits of :func:`likely_among`'s map: 4 MB, whatever the number of keys.
_KEY_BITS = 1 << 25


def likely_among(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The rows of ``df`` whose ``key`` is in ``keys``, and some others: rows of keys
    whose hash has no bit in a map of fixed size are left out before they travel
    to an exact join."""

    def place(frame):
        return F.pmod(F.xxhash64(frame[key].cast("long")), F.lit(_KEY_BITS))

    at = keys.select(place(keys).alias("at"))
    maps = at.groupBy(F.bitmap_bucket_number("at").alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("_bits"))
    rows = df.withColumn("_place", F.bitmap_bit_position(place(df))).withColumn("_bucket", F.bitmap_bucket_number(place(df)))
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (F.floor(F.col("_place") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    met = rows.join(F.broadcast(maps), "_bucket")
    return met.filter(F.getbit(byte, (F.col("_place") % 8).cast("int")) == 1).select(*df.columns)


# ------------------------------------------------------------------ arrays


def steps(batches, limit: int = STEP_BYTES, column: str = "text"):
    """Cut record batches so that each holds at most ``limit`` bytes of text,
    one row at least."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(column))
        if not len(col):
            continue
        sizes = np.diff(_offsets(col))
        if sizes.sum() <= limit:
            yield batch
            continue
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        yield batch.slice(start)


def _offsets(col: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else np.int32
    buf = col.buffers()[1]
    if buf is None or not len(col):
        return np.zeros(len(col) + 1, np.int64)
    return np.frombuffer(buf, kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column, nulls as empty."""
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    off = _offsets(col)
    data = col.buffers()[2]
    if data is None or off[-1] == off[0]:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[off[0] : off[-1]], off - off[0]


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, other bytes as they are."""
    return _LOWER[data]


def longs(col: pa.Array) -> np.ndarray:
    return col.cast(pa.int64()).to_numpy(zero_copy_only=False)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _mixed(x: np.ndarray) -> np.ndarray:
    """:func:`mix` in place."""
    spare = x >> np.uint64(30)
    x ^= spare
    x *= np.uint64(0xBF58476D1CE4E5B9)
    np.right_shift(x, np.uint64(27), out=spare)
    x ^= spare
    x *= np.uint64(0x94D049BB133111EB)
    np.right_shift(x, np.uint64(31), out=spare)
    x ^= spare
    return x


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        p = np.full(size, base, np.uint64)
        p[0] = 1
        have = _powers[base] = np.cumprod(p, dtype=np.uint64)
        if size > 1 << 23:  # one very long document: do not keep it
            del _powers[base]
    return have[:n]


class Spans:
    """Hash of any span of a symbol sequence in O(1): prefix sums of
    ``symbol * base^i``, shifted back by the inverse power."""

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(symbols * _power(_BASE, n), dtype=np.uint64, out=self.sums[1:])
        self.back = _power(_INVERSE, n + 1)

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))

    def every(self, size: int) -> np.ndarray:
        """``hash`` of every span of ``size`` symbols, in order."""
        n = max(0, len(self.sums) - size)
        out = self.sums[size:] - self.sums[:n]
        out *= self.back[:n]
        out += np.uint64(size)
        return _mixed(out)


#: Longer spans are hashed one by one.
_CHAINED_BYTES = 512


def content_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of byte spans, eight bytes a step: every step mixes the bytes into all
    that came before, so no two strings agree for a reason of their structure."""
    size = (ends - starts).astype(np.int64)
    out = mix(size.astype(np.uint64) + np.uint64(_BASE))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    window = np.ndarray((len(data) + 1,), np.dtype("<u8"), padded, strides=(1,))
    live = np.flatnonzero((size > 0) & (size <= _CHAINED_BYTES))
    # the longest first: those that reach a step stand in front, those that end with it behind them
    if len(live) and int(size[live].max()) > 16:
        live = live[np.argsort(-size[live].astype(np.int16), kind="stable")]
        at, left = starts[live].astype(np.int64), size[live]
        state, steps_ = out[live], np.arange(0, int(left[0]), 8)
        reach = np.searchsorted(-left, -steps_, "left").tolist()  # longer than the bytes before
        whole = np.searchsorted(-left, -(steps_ + 8), "right").tolist()  # with eight bytes more
        for step, n, m in zip(steps_.tolist(), reach, whole):
            part = window[at[:n] + step]
            part[m:] &= (np.uint64(1) << ((left[m:n] - step) * 8).astype(np.uint64)) - np.uint64(1)
            part ^= state[:n]
            part += np.uint64(_BASE)
            state[:n] = _mixed(part)
        out[live] = state
    else:
        at, left = starts[live].astype(np.int64), size[live]
        while len(live):
            part = window[at]
            short = left < 8
            part[short] &= (np.uint64(1) << (left[short] * 8).astype(np.uint64)) - np.uint64(1)
            out[live] = mix((out[live] ^ part) + np.uint64(_BASE))
            more = left > 8
            live, at, left = live[more], at[more] + 8, left[more] - 8
    for i in np.flatnonzero(size > _CHAINED_BYTES).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    return out


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of every document: byte starts, byte ends
    (exclusive) and, per document, the index of its first word (n + 1)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    solid = ~_SPACE[data]
    fresh = np.ones(len(data), bool)
    np.logical_not(solid[:-1], out=fresh[1:])
    inner = offsets[1:-1]
    fresh[inner[inner < len(data)]] = True
    starts = np.flatnonzero(solid & fresh)
    last = np.ones(len(data), bool)
    np.logical_not(solid[1:], out=last[:-1])
    last[inner[inner > 0] - 1] = True
    ends = np.flatnonzero(solid & last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive symbols (also across documents: callers mask)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out *= np.uint64(_BASE)
        out += hashes[j : j + n]
    return mix(out)


def ids_of(first: np.ndarray) -> np.ndarray:
    """Group number of every element, from the groups' first indexes (n + 1)."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def record_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def binary_array(data: bytes | np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary column from its bytes and offsets."""
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def kept_words_digest(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, keep: np.ndarray, first: np.ndarray) -> list[str]:
    """Per document: sha256 of its kept words joined by one space."""
    out, raw = [], data.tobytes()
    for d in range(len(first) - 1):
        lo, hi = first[d], first[d + 1]
        k = keep[lo:hi]
        s, e = starts[lo:hi][k].tolist(), ends[lo:hi][k].tolist()
        out.append(hashlib.sha256(b" ".join([raw[a:b] for a, b in zip(s, e)])).hexdigest())
    return out
