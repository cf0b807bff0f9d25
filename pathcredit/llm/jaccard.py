"""N-gram Jaccard join: rare-first prefix filtering.

A document is the set of its distinct five-word shingles (A-Z lower-cased).
Documents with equal sets collapse to one.  A fixed share of all shingles, larger
than a prefix, is counted over the documents; a set is ordered by (count, shingle),
rare ones first, and by shingle beyond that share.  Two sets that link share a
shingle among their first ``n - ceil(t n) + 1`` (the prefix), so only those are
joined.  Counted shingles that one document holds alone lead the order and meet
nobody: a set with more of them than ``n - ceil(t n)`` leaves the search.  Of prefix
shingles that the same sets hold, the first one stands for all.  A pair that meets is
dropped by

* length: the smaller set has at least ``t`` times the larger one's elements,
* position: what follows the common shingle on either side is long enough,
* suffix: the classes of the shingles that follow overlap enough;

the others are verified once a pair, on the full sets.

Prefix shingles that many sets share do not spell out their pairs: first every
set meets the centre (the set with most shared shingles) of the shingle that it
shares most of; a shingle whose sets are then in one component is settled, since
further links change nothing.  In all others, sets of different components meet
block by block: the filters pick those that could link, and full sets give the
links that join components.  Shingles in very many sets are listed by counters that
every task keeps, and counted apart, so no task holds all their rows.

Cases: null or empty text, or text without words, has an empty set and links
with nothing; under five words the whole sequence is one shingle; a null
``doc_id`` is left out; rows that share a ``doc_id`` are compared each with its
own text and answer one row each; an empty table gives no row; further columns
are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pathcredit.llm.common import content_hashes, documents, likely_among, lower, mix, partitions, ship, steps, table, utf8, words
from pathcredit.llm.components import components

PERCENT = 80
SHINGLE = 5
#: Sets that one block of a shared shingle, or one copy of a centre, meets.
BLOCK_ROWS = 1024
#: Rounds in which sets meet centres before blocks meet.
CENTRE_ROUNDS = 1
#: Share of all shingles, by their hash, that are counted and so ordered rare-first;
#: the others follow in the order.  A prefix is a fifth of a set.
COUNTED = 5 / 16
#: Rows of one shingle that are never too many for a task.
HOT_ROWS = 1_000_000
#: Classes of shingles that the suffix filter counts.
CLASSES = 8

_CHAIN = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(elements, first): the distinct shingle hashes of every document, sorted."""
    data, offsets = utf8(column)
    data = lower(data)
    starts, ends, first = words(data, offsets)
    hashes = content_hashes(data, starts, ends)
    count = np.diff(first)
    n = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    edge = np.concatenate([[0], np.cumsum(n)])
    at = np.arange(edge[-1]) - np.repeat(edge[:-1] - first[:-1], n)
    size = np.repeat(np.minimum(count, k), n)
    out = mix(size.astype(np.uint64) + _CHAIN)
    for j in range(k):
        if j and (size <= j).any():
            some = size > j
            out[some] = mix((out[some] ^ hashes[at[some] + j]) + _CHAIN)
        else:
            out = mix((out ^ hashes[at + j]) + _CHAIN)
    fresh = np.ones(len(out), bool)
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
        out[a:b].sort()
    fresh[1:] = out[1:] != out[:-1]
    fresh[edge[:-1][n > 0]] = True
    return out[fresh], np.concatenate([[0], np.cumsum(fresh)])[edge]


def _digests(elements: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit names of every set."""
    sums = [np.concatenate([[np.uint64(0)], np.cumsum(mix(elements ^ np.uint64(salt)), dtype=np.uint64)]) for salt in (0x5BD1E995, 0xC2B2AE35)]
    return [(s[first[1:]] - s[first[:-1]]).view(np.int64) for s in sums]


class Frequent:
    """Tokens that a task meets often: the mergeable counters of Misra and Gries over
    those that a step holds more than once."""

    def __init__(self, most: int = 4096):
        self.most, self.tokens, self.rows = most, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, elements: np.ndarray) -> None:
        values = np.sort(elements.view(np.int64))
        edge = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1], [True]])) if len(values) else np.zeros(1, np.int64)
        count = np.diff(edge)
        often = count > 1
        tokens, at = np.unique(np.concatenate([self.tokens, values[edge[:-1][often]]]), return_inverse=True)
        rows = np.bincount(at, np.concatenate([self.rows, count[often]]), len(tokens)).astype(np.int64)
        if len(rows) > self.most:
            rows -= np.partition(rows, -self.most - 1)[-self.most - 1]
        self.tokens, self.rows = tokens[rows > 0], rows[rows > 0]


_MARKS = pa.schema([(c, pa.int64()) for c in ("doc_id", "n", "counted", "set_a", "set_b", "token", "rows")])


def _counted(elements: np.ndarray) -> np.ndarray:
    """Whether a shingle is among those that are counted: a fixed share by its hash."""
    return elements < np.uint64(int(COUNTED * 2**64))


def _sums(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[first])


def marked_sets(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n, counted, set_a, set_b) of every document, 128 bits that name its set;
    and (token, rows) of the counted tokens that a task meets often."""

    def run(batches):
        frequent = Frequent()
        for batch in steps(batches):
            elements, first = shingle_sets(batch.column(1), k)
            counted = _counted(elements)
            frequent.add(elements[counted])
            none = pa.nulls(len(batch), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(first)), pa.array(_sums(counted, first)), *map(pa.array, _digests(elements, first)), none, none], schema=_MARKS)
        none = pa.nulls(len(frequent.tokens), pa.int64())
        yield pa.RecordBatch.from_arrays([none] * 5 + [pa.array(frequent.tokens), pa.array(frequent.rows)], schema=_MARKS)

    return docs.mapInArrow(run, "doc_id long, n long, counted long, set_a long, set_b long, token long, rows long")


def counted_tokens(docs: DataFrame, k: int) -> DataFrame:
    """(token, doc_id) of the counted shingles of all documents."""

    def run(batches):
        for batch in steps(batches):
            elements, first = shingle_sets(batch.column(1), k)
            counted = _counted(elements)
            edge = np.concatenate([[0], np.cumsum(counted)])[first]
            lists = pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(elements[counted].view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["doc_id", "elements"])

    return docs.mapInArrow(run, "doc_id long, elements array<long>").select(F.explode("elements").alias("token"), "doc_id")


def with_frequency(tokens: DataFrame, hot: list[int]) -> DataFrame:
    """(token, doc_id, sets): rows of tokens that several documents hold, once each, with
    how many.  Those of ``hot`` tokens are counted by partial sums; the others meet on the
    token."""
    by_token = Window.partitionBy("token")
    fresh = tokens.filter(~F.col("token").isin(hot)) if hot else tokens
    fresh = fresh.withColumn("fresh", ~F.lag("doc_id").over(by_token.orderBy("doc_id")).eqNullSafe(F.col("doc_id"))).filter("fresh").drop("fresh")
    out = fresh.withColumn("sets", F.count("*").over(by_token))
    if hot:
        some = tokens.filter(F.col("token").isin(hot)).distinct()
        out = out.unionByName(some.join(F.broadcast(some.groupBy("token").agg(F.count("*").alias("sets"))), "token"))
    return out.filter("sets > 1")


def hot_tokens(marks: DataFrame, hot_rows: int) -> list[int]:
    """Tokens of more rows than a task's share; at most as many as there are shuffle
    partitions.  A token that is listed wrongly or missed gets the same result."""
    total = marks.agg(F.sum("counted")).first()[0] or 0
    least = max(hot_rows, -(-total // partitions(marks.sparkSession)))
    often = marks.filter("token is not null").groupBy("token").agg(F.sum("rows").alias("rows")).filter(F.col("rows") > least)
    return [r[0] for r in often.select("token").collect()]


def least_overlap(n: F.Column, percent: int) -> F.Column:
    """ceil(t n)"""
    return F.floor((n * percent + 99) / 100).cast("long")


_SKETCH = 256


def _sketch(core: np.ndarray) -> bytes:
    """How many shingles each of finer classes holds, a byte each; all 255 where one does
    not fit."""
    held = np.bincount((mix(core.view(np.uint64).copy()) & np.uint64(_SKETCH - 1)).astype(np.int64), minlength=_SKETCH)
    return b"\xff" * _SKETCH if held.max() > 254 else held.astype(np.uint8).tobytes()


def ordered_sets(docs: DataFrame, wanted: DataFrame, k: int, percent: int) -> DataFrame:
    """(rep, n, core, sketch) of the sets that ``wanted`` (rep, doc_id, set_a, set_b, shared)
    names: their shingles in the order of the join, without counted ones that one
    document holds alone."""

    def run(batches):
        done = set()
        for batch in steps(batches):
            elements, first = shingle_sets(batch.column(1), k)
            a, b = _digests(elements, first)
            own = (a == batch.column(3).to_numpy()) & (b == batch.column(4).to_numpy())  # another text may have the same id
            reps, shared = batch.column(2).to_pylist(), batch.column(5)
            out = []
            for i in np.flatnonzero(own).tolist():
                if reps[i] in done:
                    continue
                done.add(reps[i])
                held = elements[first[i] : first[i + 1]]
                counted = int(_counted(held).sum())
                rare = np.array(shared[i].as_py() or [], np.int64).view(np.uint64)
                at = np.minimum(np.searchsorted(held, rare), len(held) - 1)
                rare = rare[held[at] == rare]
                if counted - len(rare) <= len(held) - (percent * len(held) + 99) // 100:
                    out.append((reps[i], len(held), np.concatenate([rare, held[counted:]]).view(np.int64)))
            if out:
                rep, n, core = zip(*out)
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, core)]), pa.int32()), pa.array(np.concatenate(core)))
                yield pa.RecordBatch.from_arrays([pa.array(rep), pa.array(n), lists, pa.array(map(_sketch, core), pa.binary())], ["rep", "n", "core", "sketch"])

    texts = likely_among(docs, "doc_id", wanted).join(wanted, "doc_id").select("doc_id", "text", "rep", "set_a", "set_b", "shared")
    return texts.mapInArrow(run, "rep long, n long, core array<long>, sketch binary")


_POSTINGS = pa.schema([("token", pa.int64()), ("rep", pa.int64()), ("n", pa.int64()), ("shared", pa.int64()), ("rest", pa.int64()), *[(f"c{c}", pa.int32()) for c in range(CLASSES)]])
_POSTINGS_DDL = "token long, rep long, n long, shared long, rest long, " + ", ".join(f"c{c} int" for c in range(CLASSES))


def prefixes(cores: DataFrame, percent: int) -> DataFrame:
    """The prefix of every set as rows: the shingle, what follows it (``rest``), and
    that by classes."""

    def run(batches):
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                rep, n = (part.column(c).to_numpy() for c in (0, 1))
                tokens, first = part.column(2).flatten().to_numpy(), np.concatenate([[0], np.cumsum(part.column(2).value_lengths().to_numpy())])
                held = np.diff(first)
                take = np.clip(n - (percent * n + 99) // 100 + 1 - (n - held), 0, held)
                owner = np.repeat(np.arange(len(n)), take)
                place = np.arange(take.sum()) - np.repeat(np.cumsum(take) - take, take)
                where = first[owner] + place
                kind = (mix(tokens.view(np.uint64).copy()) >> np.uint64(61)).astype(np.int64)
                after = []
                for c in range(CLASSES):
                    total = np.concatenate([[0], np.cumsum(kind == c)])
                    after.append(pa.array(total[first[owner + 1]] - total[where + 1], pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (tokens[where], rep[owner], n[owner], held[owner], held[owner] - place - 1)] + after, schema=_POSTINGS)

    return cores.select("rep", "n", "core").mapInArrow(run, _POSTINGS_DDL)


def verified(pairs: DataFrame, cores: DataFrame, percent: int, block_rows: int) -> DataFrame:
    """The links among pairs (u, v), by the full sets; a set that many pairs name as
    ``v`` is handed out in several copies."""
    salts = pairs.groupBy("v").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("salts"))
    right = cores.select("rep", "n", "core").join(salts, F.col("rep") == salts.v).select("v", "n", "core", "salts", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    left = pairs.join(salts, "v").withColumn("salt", F.pmod(F.xxhash64("u"), F.col("salts")).cast("int")).select("u", "v", "salt")
    left = left.join(cores.select(F.col("rep").alias("u"), F.col("n").alias("nu"), F.col("core").alias("cu")), "u")
    both = left.join(right.select("v", "salt", F.col("n").alias("nv"), F.col("core").alias("cv")), ["v", "salt"])
    common = F.size(F.array_intersect("cu", "cv"))
    return both.select("u", "v", (F.col("nu") + F.col("nv")).alias("sum"), common.alias("common")).filter(f"100 * common >= {percent} * (sum - common)").select("u", "v")


def _long_enough(percent: int) -> F.Column:
    return 100 * F.least("n", "n2") >= percent * F.greatest("n", "n2")


def to_centres(postings: DataFrame, percent: int, turn: int) -> DataFrame:
    """Pairs of every set with the centre that it shares most prefix shingles with;
    centres: the fullest set of a shingle, in later turns one by a hash."""
    rank = F.col("shared") / F.col("n") if turn == 0 else F.xxhash64("rep", F.lit(turn)).cast("double")
    top = F.max(F.struct(rank.alias("rank"), F.col("rep"), F.col("n"), F.col("component"))).alias("top")
    centres = table(postings.groupBy("token").agg(top).select("token", F.col("top.rep").alias("centre"), F.col("top.n").alias("n2"), F.col("top.component").alias("other")), "centres")
    met = postings.join(centres, "token").filter("component <> other").filter(_long_enough(percent)).groupBy("rep", "centre").count()
    return table(met.groupBy("rep").agg(F.max(F.struct("count", "centre")).alias("top")).select(F.col("rep").alias("u"), F.col("top.centre").alias("v")), "centre-pairs")


# ------------------------------------------------------------------ crowded shingles

_UNIT = ["key", "lo", "hi"]
_WANTED = pa.schema([(c, pa.int64()) for c in ("anchor", "rep", "component", "n")])
_LINK = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _groups(bundle: pa.Table) -> list[np.ndarray]:
    """Row numbers of every unit (a key and two blocks) in a bundle."""
    columns = [bundle.column(c).to_numpy() for c in _UNIT]
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    for c in columns:
        new[1:] |= c[order][1:] != c[order][:-1]
    return np.split(order, np.flatnonzero(new))


def could_link(percent: int):
    def run(bundle: pa.Table) -> pa.Table:
        """Sets that have a partner of another component in their unit which passes the
        length, positional and suffix filters."""
        comp, n, rest, block, low, high = (bundle.column(c).to_numpy() for c in ("component", "n", "rest", "block", "lo", "hi"))
        follow = np.stack([bundle.column(f"c{c}").to_numpy() for c in range(CLASSES)], 1)
        sketch = np.frombuffer(b"".join(bundle.column("sketch").to_pylist()), np.uint8).reshape(-1, _SKETCH)
        wide = sketch.min(1) == 255
        wanted = np.zeros(len(comp), bool)

        def check(i, j):
            """Mark the pairs that pass; all are of different components."""
            need = -(-percent * (n[i] + n[j]) // (100 + percent))
            good = (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])) & (1 + np.minimum(rest[i], rest[j]) >= need)
            i, j, need = i[good], j[good], need[good]
            good = 1 + np.minimum(follow[i], follow[j]).sum(1) >= need
            i, j, need = i[good], j[good], need[good]
            for a in range(0, len(i), 4096):
                l, r = i[a : a + 4096], j[a : a + 4096]
                good = (np.minimum(sketch[l], sketch[r]).sum(1, dtype=np.int64) >= need[a : a + 4096]) | wide[l] | wide[r]
                wanted[l[good]] = wanted[r[good]] = True

        left, right, held = [], [], 0
        for rows in _groups(bundle):
            lo, hi = low[rows[0]], high[rows[0]]
            own, others = rows[block[rows] == lo], rows[block[rows] == hi]
            for k, i in enumerate(own.tolist()):
                j = others[k + 1 :] if lo == hi else others
                j = j[comp[j] != comp[i]]
                left.append(np.full(len(j), i))
                right.append(j)
                held += len(j)
                if held > 1 << 17:
                    check(np.concatenate(left), np.concatenate(right))
                    left, right, held = [], [], 0
        if left:
            check(np.concatenate(left), np.concatenate(right))
        return bundle.filter(pa.array(wanted)).select(_WANTED.names).cast(_WANTED).group_by(_WANTED.names).aggregate([])

    return run


def connecting(percent: int):
    def run(bundle: pa.Table) -> pa.Table:
        """Links between different components of a unit, on the full sets: as many as join
        components, since further ones change nothing."""
        rep, comp, n, block, low, high = (bundle.column(c).to_numpy() for c in ("rep", "component", "n", "block", "lo", "hi"))
        cores = bundle.column("core").combine_chunks()
        tokens, first = cores.flatten().to_numpy(), np.concatenate([[0], np.cumsum(cores.value_lengths().to_numpy())])
        u, v = [], []
        for rows in _groups(bundle):
            lo, hi = low[rows[0]], high[rows[0]]
            size, total = first[rows + 1] - first[rows], n[rows]
            edge = np.concatenate([[0], np.cumsum(size)])
            _, place = np.unique(np.concatenate([tokens[first[r] : first[r + 1]] for r in rows.tolist()]), return_inverse=True)
            order = np.argsort(place, kind="stable")
            owner = np.repeat(np.arange(len(rows)), size)[order]
            head = np.concatenate([[0], np.cumsum(np.bincount(place))])
            right, label = block[rows] == hi, comp[rows].copy()
            for i in np.flatnonzero(block[rows] == lo).tolist():
                if not (right & (label != label[i])).any():
                    continue
                own = place[edge[i] : edge[i + 1]]
                count = head[own + 1] - head[own]
                at = np.repeat(head[own] - (np.cumsum(count) - count), count) + np.arange(count.sum())
                both = np.bincount(owner[at], minlength=len(rows))
                j = np.flatnonzero(right & (label != label[i]) & (100 * both >= percent * (total + total[i] - both)))
                while len(j):
                    u.append(rep[rows[i]])
                    v.append(rep[rows[j[0]]])
                    label[label == label[j[0]]] = label[i]
                    j = j[label[j] != label[i]]
        return pa.table([pa.array(u, pa.int64()), pa.array(v, pa.int64())], schema=_LINK)

    return run


def _bundled(units: DataFrame) -> DataFrame:
    """Deal the units to bundles of about a million shingles: one call for many."""
    bundles = max(1, (units.agg(F.sum("n")).first()[0] or 0) // 1_000_000)
    return units.withColumn("bundle", F.pmod(F.xxhash64(*_UNIT), F.lit(bundles)))


def _dealt(members: DataFrame, block_rows: int, columns: list[str]) -> DataFrame:
    """The members of every key in units of two blocks, such that a block holds at most
    about ``block_rows`` sets and as many times 512 shingles."""
    size = F.greatest(F.count("*") / block_rows, F.sum("n") / (512 * block_rows))
    blocks = table(members.groupBy("key").agg(F.ceil(size).cast("int").alias("blocks")), "blocks")
    placed = members.join(blocks, "key").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return placed.withColumn("other", other).select("key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "rep", "component", "n", *columns)


def met_links(postings: DataFrame, cores: DataFrame, percent: int, block_rows: int) -> DataFrame:
    """Links that connect the components of sets that share a prefix shingle.  The filters
    go by shingle; the sets that they leave meet once for each anchor, the smallest set of
    their shingles, since similar sets share many of them."""
    classes = [f"c{c}" for c in range(CLASSES)]
    units = table(_dealt(postings.withColumn("key", F.col("token")), block_rows, ["anchor", "rest", *classes]), "units")
    wanted = _bundled(units).join(cores.select("rep", "sketch"), "rep").groupBy("bundle").applyInArrow(could_link(percent), "anchor long, rep long, component long, n long")
    wanted = table(wanted.distinct().withColumnRenamed("anchor", "key"), "wanted")
    units = table(_dealt(wanted, block_rows, []), "full-units")
    return _bundled(units).join(cores.select("rep", "core"), "rep").groupBy("bundle").applyInArrow(connecting(percent), "u long, v long")


def first_tokens(postings: DataFrame) -> DataFrame:
    """(token, anchor): of all prefix shingles that the same two sets or more hold, the
    first in the order, and the smallest of the sets.  The first common shingle of any
    pair is among them, and there the filters hold."""
    names = [F.bit_xor(F.xxhash64("rep", F.lit(i))).alias(f"set_{i}") for i in (1, 2)]
    members = postings.groupBy("token").agg(F.count("*").alias("members"), F.sum("rest").alias("rest"), F.min("rep").alias("anchor"), *names).filter("members > 1")
    return members.groupBy("members", "set_1", "set_2", "anchor").agg(F.max(F.struct("rest", "token")).alias("top")).select("top.token", "anchor")


def links(cores: DataFrame, percent: int, block_rows: int, centre_rounds: int) -> DataFrame:
    """Links ``u``, ``v`` that connect all sets over the threshold.  ``cores``: (rep, n,
    core), the sets in the order of the join."""
    postings = table(prefixes(cores, percent), "postings")
    open_ = table(postings.join(table(first_tokens(postings), "first-tokens"), "token").withColumn("component", F.col("rep")), "open")
    found = []
    for turn in range(centre_rounds):
        pairs = to_centres(open_, percent, turn)
        found.append(table(verified(pairs, cores, percent, block_rows), "links"))
        label = components(reduce(DataFrame.unionByName, found))
        marked = table(open_.drop("component").join(label, open_.rep == label.node, "left").withColumn("component", F.coalesce("component", "rep")).drop("node"), "marked")
        mixed = table(marked.groupBy("token").agg(F.min("component").alias("a"), F.max("component").alias("b")).filter("a <> b").select("token"), "mixed")
        open_ = table(marked.join(mixed, "token", "left_semi"), "open")
    found.append(table(met_links(open_, cores, percent, block_rows), "links"))
    return reduce(DataFrame.unionByName, found)


def joined(docs: DataFrame, percent: int = PERCENT, k: int = SHINGLE, block_rows: int = BLOCK_ROWS, centre_rounds: int = CENTRE_ROUNDS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    ship(docs.sparkSession)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null")
    marks = table(marked_sets(own, k), "marks")
    name = ["set_a", "set_b", "n"]
    groups = marks.filter("n > 0").groupBy(*name, "counted").agg(F.min("doc_id").alias("doc_id"))
    groups = table(groups.withColumn("rep", F.monotonically_increasing_id()), "distinct-sets")
    often = with_frequency(counted_tokens(own, k), hot_tokens(marks, hot_rows))
    order = F.array_sort(F.collect_list(F.struct("sets", "token"))).getField("token")
    ids = groups.select("doc_id").distinct()
    shared = often.join(ids, "doc_id", "left_semi").groupBy("doc_id").agg(order.alias("shared"))
    alone = F.col("counted") - F.coalesce(F.size("shared"), F.lit(0))
    able = groups.join(shared, "doc_id", "left").filter(alone <= F.col("n") - least_overlap(F.col("n"), percent))
    able = table(able.select("rep", "doc_id", "set_a", "set_b", "shared"), "able-sets")
    cores = table(ordered_sets(own, able, k, percent), "cores")
    label = components(links(cores, percent, block_rows, centre_rounds)).distinct()
    member = groups.join(label, groups.rep == label.node, "left").select(*name, "doc_id", F.coalesce("component", "rep").alias("component"))
    member = table(member, "members")
    lowest = member.groupBy("component").agg(F.min("doc_id").alias("lowest"))
    classes = table(member.join(lowest, "component").select(*name, "lowest"), "classes")
    result = marks.filter("doc_id is not null").select("doc_id", *name).join(classes, name, "left")
    return result.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("lowest", "doc_id").alias("component_id"))


def op11_jaccard(spark, sf_dir):
    return joined(documents(spark, sf_dir))


OP11_SQL = f"""
WITH RECURSIVE sequences AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents WHERE doc_id IS NOT NULL
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i + 1 : i + {SHINGLE}], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(0, greatest(1, len(w) - {SHINGLE - 1}))) AS i FROM sequences WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT u, v FROM common c JOIN sizes a ON a.doc_id = u JOIN sizes b ON b.doc_id = v WHERE 100 * c.n >= {PERCENT} * (a.n + b.n - c.n)
), reach(u, v) AS (
  SELECT u, v FROM links UNION SELECT r.u, l.v FROM reach r JOIN links l ON l.u = r.v
), lowest AS (
  SELECT u, min(v) AS v FROM reach GROUP BY u
)
SELECT t.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, least(t.doc_id, coalesce(l.v, t.doc_id)) AS component_id
FROM sequences t LEFT JOIN sizes s ON s.doc_id = t.doc_id LEFT JOIN lowest l ON l.u = t.doc_id
"""
