"""Compression of vectors to four bytes, one a part: Lloyd rounds under
norm-of-sum bounds.

A component becomes ``floor(1024 x)``; a vector is cut into four equal parts, each
coded by its nearest entry in the part's codebook (ties to the lower index).  Each
round replaces an entry by the floored mean of its parts.

Every part keeps two bounds with the round they were measured in: the distance to
its entry, and that to the nearest other one.  The history of the codebooks stays
at hand, so in a later round a bound is moved by the net displacement of an entry
between the two rounds, the norm of the sum of its moves, which is never more than
the sum of their norms.  While the upper bound stays under the lower one, the entry
is the same; else the distance to it is measured, and only if that does not decide
are all entries scanned.

A round is one pass in Spark: a task writes its parts with their bounds and, last,
the sums of the parts that changed their entry; the driver adds up at most one row
per entry and position.

Cases: a vector that is null, or holds null or non-finite components, is left out;
so is one whose length is not a positive multiple of four or is not that of the
smallest kept ``vec_id``, and one without ``vec_id``.  Repeated rows count each, and
the smallest ``vec_id`` values start the codebook row by row, ties by their
components.  Scaled components beyond 2^25 count as 2^25.  With fewer than 256
vectors the codebook is as short; an empty table gives no row; further columns are
ignored, and without a ``label`` all labels are null.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathcredit.llm.common import ship, table

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
_MOST = 1 << 25
#: Vectors that one vectorised step holds.
_STEP_ROWS = 2048


def whole_numbers(vectors: pa.Array, width: int) -> np.ndarray:
    """(rows, width) of floor(SCALE x)."""
    x = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
    return np.clip(np.floor(x * SCALE), -_MOST, _MOST).astype(np.int64)


def _packed(numbers: np.ndarray) -> pa.Array:
    """Rows of whole numbers as bytes, two a number where all fit."""
    small = not len(numbers) or np.abs(numbers).max() < 1 << 15
    data = np.ascontiguousarray(numbers.astype("<i2" if small else "<i4"))
    return _rows(data)


def _rows(data: np.ndarray) -> pa.Array:
    data = np.ascontiguousarray(data)
    size = data.shape[1] * data.itemsize
    return pa.Array.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(np.arange(len(data) + 1, dtype=np.int32) * size), pa.py_buffer(data)])


def _column(column: pa.Array, kind: str) -> np.ndarray:
    """Rows of equally long bytes as an array; a copy, so it can be changed."""
    return np.array([np.frombuffer(x, kind) for x in column.to_pylist()])


def _unpacked(column: pa.Array, width: int) -> np.ndarray:
    """All rows of a step were packed alike, but a batch may hold several steps."""
    out = np.empty((len(column), width), np.int64)
    for i, x in enumerate(column.to_pylist()):
        out[i] = np.frombuffer(x, "<i2" if len(x) == 2 * width else "<i4")
    return out


def squared(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """(rows, entries) of squared distances, exact."""
    most = max(np.abs(x).max(initial=0), np.abs(book).max(initial=0))
    if 4 * int(most) ** 2 * x.shape[1] < 1 << 53:  # whole numbers that doubles hold exactly
        a, b = x.astype(np.float64), book.astype(np.float64)
        return (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)
    out = np.zeros((len(x), len(book)), np.int64)
    for p in range(x.shape[1]):
        out += (x[:, p, None] - book[:, p]) ** 2
    return out


def to_entry(x: np.ndarray, book: np.ndarray, code: np.ndarray) -> np.ndarray:
    return ((x - book[code]) ** 2).sum(1)


class History:
    """The codebooks of all rounds, and how far every entry moved between two of them."""

    def __init__(self, books: list[np.ndarray]):
        self.books = books  # each (parts, entries, width / parts)
        now = books[-1].astype(np.float64)
        self.moved = np.stack([np.sqrt(((now - b) ** 2).sum(2)) for b in books])  # (round, part, entry)
        order = np.argsort(self.moved, axis=2)
        self.farthest = order[:, :, -1]
        most = np.take_along_axis(self.moved, order, 2)
        self.most, self.second = most[:, :, -1], most[:, :, -2] if most.shape[2] > 1 else np.zeros(most.shape[:2])

    @property
    def turn(self) -> int:
        return len(self.books) - 1

    def others(self, stamp: np.ndarray, part: int, code: np.ndarray) -> np.ndarray:
        """The largest net move since ``stamp`` among entries other than ``code``."""
        same = self.farthest[stamp, part] == code
        return np.where(same, self.second[stamp, part], self.most[stamp, part])


_SLACK = 1e-9  # relative; bounds are rounded away from each other beyond it


def assign(x: np.ndarray, history: History, part: int, state: dict | None) -> tuple[dict, int]:
    """State (code, upper, lower, up_round, low_round) of one part of some vectors under
    the newest codebook, from their earlier state; and how many were scanned."""
    book, turn, n = history.books[-1][part], history.turn, len(x)
    if state is None:
        scan = np.arange(n)
        new = {"code": np.zeros(n, np.uint8), "upper": np.zeros(n, np.float32), "lower": np.zeros(n, np.float32), "up_round": np.zeros(n, np.uint8), "low_round": np.zeros(n, np.uint8)}
    else:
        new = {k: v.copy() for k, v in state.items()}
        code = new["code"].astype(np.int64)
        low = new["lower"].astype(np.float64) - history.others(new["low_round"], part, code)
        high = new["upper"].astype(np.float64) + history.moved[new["up_round"], part, code]
        scan = np.flatnonzero(high * (1 + _SLACK) >= low * (1 - _SLACK))
        if len(scan):
            exact = np.sqrt(to_entry(x[scan], book, code[scan]).astype(np.float64))
            new["upper"][scan] = np.nextafter(exact.astype(np.float32), np.float32(np.inf))
            new["up_round"][scan] = turn
            scan = scan[exact * (1 + _SLACK) >= low[scan] * (1 - _SLACK)]
    if len(scan):
        d = squared(x[scan], book)
        code = d.argmin(1)
        near = d[np.arange(len(scan)), code]
        other = d.copy()
        other[np.arange(len(scan)), code] = np.iinfo(np.int64).max if other.dtype.kind == "i" else np.inf
        next_ = np.sqrt(other.min(1).astype(np.float64))
        new["code"][scan] = code
        new["upper"][scan] = np.nextafter(np.sqrt(near.astype(np.float64)).astype(np.float32), np.float32(np.inf))
        new["lower"][scan] = np.nextafter(np.minimum(next_, 3e38).astype(np.float32), np.float32(0))
        new["up_round"][scan] = new["low_round"][scan] = turn
    return new, len(scan)


_STATE = {"code": "u1", "upper": "<f4", "lower": "<f4", "up_round": "u1", "low_round": "u1"}
_ROUND_DDL = "vec_id long, label {label}, vector binary, " + ", ".join(f"{k} binary" for k in _STATE) + ", slot long, value long"


def _steps(batches):
    for batch in batches:
        for at in range(0, len(batch), _STEP_ROWS):
            yield batch.slice(at, _STEP_ROWS)


def one_round(rows: DataFrame, books: list[np.ndarray], width: int, label: str) -> DataFrame:
    """The rows under the newest codebook, then (slot, value): the change of the sums
    and counts of entries.  ``rows``: the last round's, or (vec_id, label, embedding)."""
    start, size = "embedding" in rows.columns, width // PARTS

    def run(batches):
        history, change = History(books), np.zeros((PARTS, books[0].shape[1], size + 1), np.int64)
        schema = None
        for batch in _steps(batches):
            schema = batch.schema.field(1).type
            x = whole_numbers(batch.column(2), width) if start else _unpacked(batch.column(2), width)
            old = None if start else {k: _column(batch.column(3 + i), kind) for i, (k, kind) in enumerate(_STATE.items())}
            new = []
            for p in range(PARTS):
                own = x[:, p * size : (p + 1) * size]
                now, _ = assign(own, history, p, None if start else {k: v[:, p] for k, v in old.items()})
                new.append(now)
                counted = np.concatenate([own, np.ones((len(own), 1), np.int64)], axis=1)
                if start:
                    np.add.at(change[p], now["code"], counted)
                else:
                    left = now["code"] != old["code"][:, p]
                    np.add.at(change[p], now["code"][left], counted[left])
                    np.subtract.at(change[p], old["code"][left, p], counted[left])
            none = pa.nulls(len(x), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _packed(x)] + [_rows(np.stack([s[k] for s in new], 1)) for k in _STATE] + [none, none], [*("vec_id", "label", "vector"), *_STATE, "slot", "value"])
        flat = change.ravel()
        some = np.flatnonzero(flat)
        if len(some):
            empty = pa.nulls(len(some), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.nulls(len(some), pa.int64()), pa.nulls(len(some), schema), empty] + [empty for _ in _STATE] + [pa.array(some), pa.array(flat[some])], [*("vec_id", "label", "vector"), *_STATE, "slot", "value"])

    return rows.mapInArrow(run, _ROUND_DDL.format(label=label))


def final_codes(rows: DataFrame, books: list[np.ndarray], width: int, label: str) -> DataFrame:
    """(vec_id, label, code, error) under the last codebook."""
    size = width // PARTS

    def run(batches):
        history = History(books)
        for batch in _steps(batches):
            x = _unpacked(batch.column(2), width)
            old = {k: _column(batch.column(3 + i), kind) for i, (k, kind) in enumerate(_STATE.items())}
            codes, error = np.zeros((len(x), PARTS), np.uint8), np.zeros(len(x), np.int64)
            for p in range(PARTS):
                own = x[:, p * size : (p + 1) * size]
                codes[:, p] = assign(own, history, p, {k: v[:, p] for k, v in old.items()})[0]["code"]
                error += to_entry(own, books[-1][p], codes[:, p].astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(error)], ["vec_id", "label", "code", "error"])

    return rows.mapInArrow(run, f"vec_id long, label {label}, code string, error long")


def kept_vectors(vectors: DataFrame) -> tuple[DataFrame, list]:
    """The usable rows (vec_id, label, embedding), and the first ones."""
    label = F.col("label") if "label" in vectors.columns else F.lit(None).cast("int").alias("label")
    finite = F.forall("embedding", lambda v: F.coalesce(F.abs(v.cast("double")) < F.lit(float("inf")), F.lit(False)))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), label, "embedding").filter("vec_id is not null and size(embedding) > 0")
    rows = rows.filter((F.size("embedding") % PARTS == 0) & finite)
    lowest = rows.select("vec_id", F.size("embedding").alias("n")).orderBy("vec_id", "n").limit(1).collect()
    if not lowest:
        return rows, []
    rows = rows.filter(F.size("embedding") == lowest[0]["n"])
    return rows, [r[0] for r in rows.orderBy("vec_id", "embedding").limit(ENTRIES).select("embedding").collect()]


def compressed(vectors: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256)"""
    spark = vectors.sparkSession
    ship(spark)
    rows, first = kept_vectors(vectors)
    label = rows.schema["label"].dataType.simpleString()
    if not first:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    width = len(first[0])
    size = width // PARTS
    begin = whole_numbers(pa.array(first, pa.list_(pa.float64())), width)
    books = [begin.reshape(len(first), PARTS, size).transpose(1, 0, 2).copy()]
    sums = np.zeros((PARTS, len(first), size + 1), np.int64)
    for _ in range(rounds):
        done = table(one_round(rows, books, width, label), "codes")
        changed = done.filter("slot is not null").groupBy("slot").agg(F.sum("value").alias("value")).collect()
        for slot, value in changed:  # at most one row an entry and position
            sums.ravel()[slot] += value
        count = sums[:, :, -1:]
        books.append(np.where(count > 0, sums[:, :, :-1] // np.maximum(count, 1), books[-1]))
        rows = done.filter("slot is null").drop("slot", "value")
    coded = table(final_codes(rows, books, width, label), "final-codes")
    by_label = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of_label")
    digest = hashlib.sha256(",".join(map(str, books[-1].ravel().tolist())).encode()).hexdigest()
    joined = coded.join(by_label, coded.label.eqNullSafe(by_label.of_label))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def op13_codes(spark, sf_dir):
    return compressed(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _op13_sql() -> str:
    """Rounds as a chain of table expressions: parts, then nearest entries and means."""
    dot = "list_inner_product"
    steps = [
        f"""vectors AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
  SELECT vec_id, label, p, v[p * (len(v) // {PARTS}) + 1 : (p + 1) * (len(v) // {PARTS})] AS x FROM vectors, range({PARTS}) t(p)
), book0 AS (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c FROM parts
  QUALIFY row_number() OVER (PARTITION BY p ORDER BY vec_id) <= {ENTRIES}
)"""
    ]
    for r in range(ROUNDS + 1):
        steps.append(
            f"""near{r} AS MATERIALIZED (
  SELECT vec_id, p, CAST(min(struct_pack(d := {dot}(x, x) - 2 * {dot}(x, c) + {dot}(c, c), e := e)).e AS BIGINT) AS e,
         CAST(min({dot}(x, x) - 2 * {dot}(x, c) + {dot}(c, c)) AS BIGINT) AS d
  FROM parts JOIN book{r} USING (p) GROUP BY vec_id, p
)"""
        )
        if r < ROUNDS:
            steps.append(
                f"""book{r + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM book{r} b LEFT JOIN (
    SELECT p, e, list(mean ORDER BY i) AS c FROM (
      SELECT n.p, n.e, i, floor(sum(x[i]) / count(*)) AS mean FROM near{r} n JOIN parts q ON q.vec_id = n.vec_id AND q.p = n.p, unnest(range(1, len(x) + 1)) u(i) GROUP BY ALL
    ) GROUP BY p, e
  ) m ON m.p = b.p AND m.e = b.e
)"""
            )
    last = ROUNDS
    steps.append(
        f"""coded AS (
  SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM near{last} GROUP BY vec_id
), digest AS (
  SELECT sha256(string_agg(CAST(CAST(c[i] AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, i)) AS h FROM book{last}, unnest(range(1, len(c) + 1)) u(i)
)"""
    )
    return "WITH " + ", ".join(steps) + """
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM coded JOIN vectors USING (vec_id), digest
"""


OP13_SQL = _op13_sql()
