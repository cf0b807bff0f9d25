"""Fuzzy line deduplication by MinHash.

A line is what stands between two newlines of a text; its set is its distinct
eight-character shingles (A-Z lower-cased; a shorter line is one shingle).  One
hash of every shingle names a register and competes for its minimum there, and
empty registers borrow from the next filled one, so a signature costs one pass
over the characters.  Bands, confirmation on the full shingle sets and
distributed union-find are those of :mod:`lsh` and :mod:`components`; equal
lines collapse first.  Of every component the first line stays (smallest
document, then line number); the others go.

Lines without a character other than white space are no lines to compare: they
stay.  Cases: null text stays null and has no line; a null ``doc_id`` is left
as it is; rows that share a ``doc_id`` share their removed line numbers; an
empty table gives no row; further columns pass through.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathcredit.llm.common import Spans, _mixed, content_hashes, documents, ids_of, longs, lower, mix, record_batch, ship, steps, table
from pathcredit.llm.components import components
from pathcredit.llm.lsh import BITS, Near, mixed_bands, similar_sets

#: A pair at the threshold shares no band once in 11,000 times (0.488 ** 13).
#: Under 78 shingles many of the 39 registers are borrowed: no estimate then.
LINES = Near(80, shingle=8, bands=13, rows=3, few=78)
_NEWLINE = 10
_table: list[np.ndarray] = []
_LINES_AT_ONCE = 4000
#: Text that one step holds: a character takes up to a hundred bytes in its arrays.
_STEP_BYTES = 1 << 18
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32, 0xA0]] = True
_SEEN_LINES = 200_000


def _symbols(codes: np.ndarray) -> np.ndarray:
    """A 64-bit symbol for every character, A-Z as a-z."""
    if not _table:
        t = np.random.default_rng(21).integers(1, 1 << 63, 0x110000, dtype=np.uint64) | np.uint64(1)
        t[65:91] = t[97:123]
        _table.append(t)
    return _table[0][codes]


def _content_ids(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The ids of lines: hashes of their bytes in UTF-8, A-Z as a-z."""
    return content_hashes(lower(data), start, end).view(np.int64)


def _line_ids(lines: list[bytes]) -> np.ndarray:
    size = np.array([len(x) for x in lines], np.int64)
    return _content_ids(np.frombuffer(b"".join(lines), np.uint8), np.cumsum(size) - size, np.cumsum(size))


class Lines:
    """The lines of some texts, as characters."""

    def __init__(self, texts: list[str | None]):
        joined = "\n".join([t or "" for t in texts])
        data = np.frombuffer(joined.encode("utf-8", "surrogatepass"), np.uint8)
        one_byte = len(data) == len(joined)  # a byte is a character
        codes = data if one_byte else np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        breaks = np.flatnonzero(codes == _NEWLINE)
        self.start = np.append(0, breaks + 1)
        self.end = np.append(breaks, len(codes))
        count = np.array([(t or "").count("\n") + 1 for t in texts], np.int64)
        self.first = np.append(0, np.cumsum(count))
        self.doc = ids_of(self.first)
        self.number = np.arange(len(self.doc)) - self.first[self.doc]
        null = np.array([t is None for t in texts], bool)
        self.null = null[self.doc]
        self.data, self.codes = data, codes
        self.spans = Spans(_symbols(codes))
        self.every: tuple[int, np.ndarray] | None = None

    @cached_property
    def id(self) -> np.ndarray:
        edges = np.flatnonzero(self.data == _NEWLINE)
        return _content_ids(self.data, np.append(0, edges + 1), np.append(edges, len(self.data)))

    @cached_property
    def filled(self) -> np.ndarray:
        """Lines with a character other than white space."""
        solid = np.zeros(len(self.codes) + 1, np.int64)
        np.cumsum(~_BLANK[np.minimum(self.codes, 255)], out=solid[1:])
        return solid[self.end] > solid[self.start]

    def shingles(self, lines: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, line) of every shingle of some lines."""
        size = self.end[lines] - self.start[lines]
        n = np.maximum(1, size - k + 1)
        edge = np.cumsum(n) - n
        at = np.repeat(self.start[lines] - edge, n) + np.arange(n.sum())
        if self.every is None or self.every[0] != k:
            # the shingle at every character; the last characters begin none
            self.every = (k, np.append(self.spans.every(k), np.zeros(k, np.uint64)))
        out = self.every[1][at]
        short = np.flatnonzero(size < k)
        out[edge[short]] = self.spans.hash(self.start[lines[short]], self.end[lines[short]])
        out >>= np.uint64(64 - BITS)
        return out, np.repeat(np.arange(len(lines)), n)


def one_hash(elements: np.ndarray, first: np.ndarray, registers: int) -> np.ndarray:
    """(sets, registers): of each set, the least hash that fell into a register;
    an empty register takes the next filled one's, marked with the distance."""
    return _least(elements, ids_of(first), len(first) - 1, registers)


def _least(elements: np.ndarray, owner: np.ndarray, sets: int, registers: int) -> np.ndarray:
    h = _mixed(elements ^ np.uint64(0x2545F4914F6CDD1D))
    place = h >> np.uint64(32)
    place *= np.uint64(registers)
    place >>= np.uint64(32)
    place = place.view(np.int64)
    place += owner * registers
    h &= np.uint64(0xFFFFFFFF)
    out = np.full(sets * registers, 1 << 32, np.int64)
    np.minimum.at(out, place, h.view(np.int64))
    out = out.reshape(sets, registers)
    twice = np.concatenate([out, out], 1)
    place = np.where(twice < 1 << 32, np.arange(2 * registers), 4 * registers)
    place = np.minimum.accumulate(place[:, ::-1], 1)[:, ::-1][:, :registers]
    distance = place - np.arange(registers)
    value = np.take_along_axis(twice, np.minimum(place, 2 * registers - 1), 1)
    return mix(value.astype(np.uint64) + (distance.astype(np.uint64) << np.uint64(33)))


def _own(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null")


_LINES = pa.schema([("doc_id", pa.int64()), ("line_no", pa.int64()), ("id", pa.int64()), ("keys", pa.list_(pa.int64()))])


def lines_of(docs: DataFrame, near: Near) -> DataFrame:
    """(doc_id, line_no, id, keys): every line in one pass over the texts.  ``id``
    is a hash of its characters, null for a blank line; ``keys`` are its band
    values, null where the task met the line before."""

    def run(batches):
        seen: set[int] = set()
        for batch in steps(batches, _STEP_BYTES):
            lines = Lines(batch.column(1).to_pylist())
            _, some = np.unique(lines.id, return_index=True)
            some = np.sort(some[lines.filled[some]])
            new = np.array([i not in seen for i in lines.id[some].tolist()], bool)
            some = some[new]
            if len(seen) > _SEEN_LINES:
                seen.clear()
            seen.update(lines.id[some].tolist())
            keys = [np.zeros((0, near.bands), np.uint64)]
            for at in range(0, len(some), _LINES_AT_ONCE):
                part = some[at : at + _LINES_AT_ONCE]
                elements, owner = lines.shingles(part, near.shingle)
                keys.append(mixed_bands(_least(elements, owner, len(part), near.registers), near))
            has = np.zeros(len(lines.id), bool)
            has[some] = True
            keep = np.flatnonzero(~lines.null)
            ids = pa.array(lines.id[keep], pa.int64(), mask=~lines.filled[keep])
            edge = np.append(0, np.cumsum(has[keep])) * near.bands
            values = pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(np.concatenate(keys).view(np.int64).ravel()), mask=pa.array(~has[keep]))
            yield record_batch(_LINES, longs(batch.column(0))[lines.doc[keep]], lines.number[keep], ids, values.cast(_LINES.field(3).type))

    return docs.mapInArrow(run, "doc_id long, line_no long, id long, keys array<long>")


def full_lines(docs: DataFrame, found: DataFrame, wanted: DataFrame) -> DataFrame:
    """(rep, elements, roles) of the lines that ``wanted`` (rep, roles) names, each
    read at one of its places; elements: the line itself, shorter than its set."""
    roles = wanted.schema["roles"].dataType.simpleString()
    one = found.groupBy("id").agg(F.min(F.struct("doc_id", "line_no")).alias("p"))
    asked = wanted.join(one, wanted.rep == one.id).groupBy("p.doc_id").agg(F.collect_list(F.struct("p.line_no", "rep", "roles")).alias("asked"))

    def run(batches):
        for batch in steps(batches, _STEP_BYTES):
            lists = batch.column(1)
            number, rep, role = lists.flatten().flatten()
            owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
            texts = [t.split("\n") for t in batch.column(0).to_pylist()]
            lines = [(texts[i][n] if n < len(texts[i]) else "").encode("utf-8", "surrogatepass") for i, n in zip(owner.tolist(), number.to_pylist())]
            # another text of the same doc_id may hold another line there
            right = pa.array(_line_ids(lines) == rep.to_numpy())
            yield pa.RecordBatch.from_arrays([rep.filter(right), pa.array(lines, pa.binary()).filter(right), role.filter(right)], ["rep", "elements", "roles"])

    texts = docs.filter("text is not null").join(asked, "doc_id").select("text", "asked")
    return texts.mapInArrow(run, f"rep long, elements binary, roles {roles}")


def line_sets(k: int):
    """The distinct shingles of every line of a binary column, sorted."""

    def read(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        lines, parts, first = Lines([x.decode() for x in column.to_pylist()]), [], [np.zeros(1, np.int64)]
        for at in range(0, len(column), _LINES_AT_ONCE):  # a line's number stands above its elements' bits
            some = np.arange(at, min(at + _LINES_AT_ONCE, len(column)))
            elements, owner = lines.shingles(some, k)
            keys = np.sort((owner.astype(np.uint64) << np.uint64(BITS)) | elements)
            keys = keys[np.append(True, keys[1:] != keys[:-1])]
            parts.append(keys & np.uint64((1 << BITS) - 1))
            first.append(first[-1][-1] + np.searchsorted(keys, np.arange(1, len(some) + 1, dtype=np.uint64) << np.uint64(BITS)))
        return np.concatenate(parts or [np.zeros(0, np.uint64)]), np.concatenate(first)

    return read


def judged_lines(docs: DataFrame, near: Near = LINES) -> DataFrame:
    """Per line: (doc_id, line_no, first_doc, first_line, kept); the first place of
    its component is the line that stays."""
    ship(docs.sparkSession)
    own = _own(docs)
    found = table(lines_of(own, near), "lines")
    values = found.filter("keys is not null").select(F.col("id").alias("rep"), F.posexplode("keys").alias("band", "key"))
    found = found.drop("keys")
    links = similar_sets(values, lambda wanted: full_lines(own, found, wanted), one_hash, near, line_sets(near.shingle))
    label = components(links)
    kinds = found.filter("id is not null").groupBy("id").agg(F.min(F.struct("doc_id", "line_no")).alias("p"))
    kinds = table(kinds.join(label, kinds.id == label.node, "left").select("id", F.coalesce("component", "id").alias("component"), "p"), "kinds")
    heads = kinds.groupBy("component").agg(F.min("p").alias("head"))
    heads = kinds.join(heads, "component").select("id", "head")
    place = F.struct("doc_id", "line_no")
    joined = found.join(heads, "id", "left").withColumn("head", F.coalesce("head", place))
    return joined.select("doc_id", "line_no", F.col("head.doc_id").alias("first_doc"), F.col("head.line_no").alias("first_line"), (place == F.col("head")).alias("kept"))


def deduplicated(docs: DataFrame, near: Near = LINES) -> DataFrame:
    """The documents, with the lines that go taken out of ``text``."""
    gone = judged_lines(docs, near).filter("not kept").groupBy("doc_id").agg(F.collect_set("line_no").alias("numbers")).withColumnRenamed("doc_id", "of_doc")
    text, numbers = docs["text"], gone["numbers"]

    @F.pandas_udf("string")
    def left(texts: pd.Series, numbers: pd.Series) -> pd.Series:
        out: list[str | None] = []
        for t, n in zip(texts, numbers):
            drop = set() if t is None else set(n.tolist())
            out.append(None if t is None else "\n".join([line for i, line in enumerate(t.split("\n")) if i not in drop]))
        return pd.Series(out, dtype=object)

    joined = docs.join(gone, docs["doc_id"].cast("long") == gone["of_doc"], "left")
    # texts that lose no line do not travel to Python
    new = F.when(numbers.isNotNull(), left(F.when(numbers.isNotNull(), text), numbers)).otherwise(text).alias("text")
    return joined.select(*[new if c == "text" else docs[c] for c in docs.columns])


def op6_lines(spark, sf_dir):
    return judged_lines(documents(spark, sf_dir))


OP6_SQL = f"""
WITH RECURSIVE places AS (
  SELECT doc_id, unnest(range(0, len(string_split(text, chr(10))))) AS line_no,
         unnest(string_split(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), chr(10))) AS line
  FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL
), firsts AS (
  SELECT row_number() OVER (ORDER BY min(struct_pack(d := doc_id, l := line_no))) AS id, line, min(struct_pack(d := doc_id, l := line_no)) AS p
  FROM places WHERE regexp_matches(line, '[^\\x09-\\x0D\\x20\\xA0]') GROUP BY line
), shingles AS (
  SELECT DISTINCT id, s FROM (
    SELECT id, unnest(list_transform(range(0, greatest(1, length(line) - {LINES.shingle - 1})), lambda i: substr(line, i + 1, {LINES.shingle}))) AS s FROM firsts)
), weighed AS (
  SELECT id, s, row_number() OVER (PARTITION BY id ORDER BY f, s) AS place, count(*) OVER (PARTITION BY id) AS n
  FROM (SELECT id, s, count(*) OVER (PARTITION BY s) AS f FROM shingles)
), prefixes AS (
  SELECT id, s, n FROM weighed WHERE 100 * (place - 1) <= {100 - LINES.percent} * n
), candidates AS (
  SELECT DISTINCT a.id AS u, b.id AS v, a.n AS m, b.n AS n FROM prefixes a JOIN prefixes b ON a.s = b.s AND a.id < b.id
  WHERE 100 * least(a.n, b.n) >= {LINES.percent} * greatest(a.n, b.n)
), links AS (
  SELECT c.u, c.v FROM candidates c JOIN shingles a ON a.id = c.u JOIN shingles b ON b.id = c.v AND b.s = a.s
  GROUP BY c.u, c.v, c.m, c.n HAVING 100 * count(*) >= {LINES.percent} * (c.m + c.n - count(*))
), both_ways AS (
  SELECT u, v FROM links UNION ALL SELECT v, u FROM links
), reach(u, v) AS (
  SELECT u, v FROM both_ways UNION SELECT r.u, b.v FROM reach r JOIN both_ways b ON b.u = r.v
), lowest AS (
  SELECT u, min(v) AS v FROM reach GROUP BY u
), heads AS (
  SELECT f.line, h.p FROM firsts f LEFT JOIN lowest l ON l.u = f.id JOIN firsts h ON h.id = least(f.id, coalesce(l.v, f.id))
)
SELECT p.doc_id, CAST(p.line_no AS BIGINT) AS line_no, CAST(coalesce(h.p.d, p.doc_id) AS BIGINT) AS first_doc,
       CAST(coalesce(h.p.l, p.line_no) AS BIGINT) AS first_line,
       coalesce(h.p.d = p.doc_id AND h.p.l = p.line_no, true) AS kept
FROM places p LEFT JOIN heads h ON h.line = p.line
"""
