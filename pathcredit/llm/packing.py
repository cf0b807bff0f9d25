"""Pack documents into fixed-length training sequences.

Every document's ids (byte-level BPE, then one end id) are cut into full
sequences and one remainder.  Pieces are dealt to groups at random (by a hash
of their own id, start, task and place in it, so neither a hot
source nor repeated rows meet in one group; they are written first, so a place
is drawn once), and in each group first-fit decreasing places them: the bins' free
room stands in the leaves of a tournament tree whose inner nodes hold the
larger child, so the first bin with room is found by one descent.  Groups are
independent tasks of bounded size; their number follows the number of rows.

Cases: null or empty text packs its end id alone; a null ``doc_id`` is left
out; repeated rows are packed once each; an empty table gives no piece; further
columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathcredit.llm.common import documents, record_batch, ship, steps, table
from pathcredit.llm.tokens import VOCABULARY, encoder

SEQUENCE = 1024
END_ID = 0
GROUP_DOCUMENTS = 4000

_PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())])
_PIECES_DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
_PLACED = _PIECES.append(pa.field("place", pa.int64()))


def pieces(docs: DataFrame, sequence: int = SEQUENCE, vocabulary: str = VOCABULARY) -> DataFrame:
    """Cut every document's ids into pieces of at most ``sequence`` ids; ``place``
    numbers them by task and piece."""
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches):
        bpe, seen = encoder(vocabulary), TaskContext.get().partitionId() << 33
        for batch in steps(batches, 4 << 20):
            rows: list[list[int]] = [[], [], [], [], []]
            for doc, ids in zip(batch.column(0).to_pylist(), bpe.encode_all([t or "" for t in batch.column(1).to_pylist()])):
                ids = memoryview(ids + end)
                total = len(ids) // 4
                for start in range(0, total, sequence):
                    part = ids[4 * start : 4 * (start + sequence)]
                    for col, v in zip(rows, (doc, start, len(part) // 4, zlib.crc32(part), total)):
                        col.append(v)
            yield record_batch(_PLACED, *rows, np.arange(seen, seen + len(rows[0])))
            seen += len(rows[0])

    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").filter("doc_id is not null").mapInArrow(run, f"{_PIECES_DDL}, place long")


class Bins:
    """Free room of the bins, as a tournament tree."""

    def __init__(self, most: int, room: int):
        self.leaves = 1 << max(0, most - 1).bit_length()
        self.tree = [room] * (2 * self.leaves)

    def place(self, length: int) -> int:
        """The first bin with room for ``length``; its room shrinks."""
        tree, at = self.tree, 1
        while at < self.leaves:
            at *= 2
            if tree[at] < length:
                at += 1
        found = at - self.leaves
        tree[at] -= length
        while at > 1:
            at //= 2
            left, right = tree[2 * at], tree[2 * at + 1]
            room = left if left >= right else right
            if tree[at] == room:
                break
            tree[at] = room
        return found


def first_fit_decreasing(lengths, room: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of every length; ties keep their order."""
    lengths = np.asarray(lengths, np.int64)
    bins, used = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    tree, fill = Bins(len(lengths), room), [0] * len(lengths)
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        b = tree.place(n)
        bins[i], used[i] = b, fill[b]
        fill[b] += n
    return bins, used


def pack(parts: DataFrame, groups: int, sequence: int = SEQUENCE) -> DataFrame:
    """Place pieces in sequences, each group on its own.  Adds ``sequence_id``
    (group number times 2^32, plus the bin) and ``offset``."""

    def run(batch: pa.Table) -> pa.Table:
        batch = batch.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending")])
        bins, offset = first_fit_decreasing(batch.column("length").to_numpy(), sequence)
        group = batch.column("bin_group").to_numpy().astype(np.int64)
        batch = batch.drop_columns(["place", "bin_group"])
        return batch.append_column("sequence_id", pa.array((group << 32) + bins)).append_column("offset", pa.array(offset))

    group = F.pmod(F.xxhash64("doc_id", "start", "place"), F.lit(groups)).cast("long")
    return parts.withColumn("bin_group", group).groupBy("bin_group").applyInArrow(run, f"{_PIECES_DDL}, sequence_id long, offset long")


def packed(docs: DataFrame, sequence: int = SEQUENCE, group_documents: int = GROUP_DOCUMENTS) -> DataFrame:
    """All documents, packed."""
    groups = -(-docs.count() // group_documents) or 1
    return pack(table(pieces(docs, sequence), "pieces"), groups, sequence)


def op5_packing(spark, sf_dir):
    return packed(documents(spark, sf_dir))
