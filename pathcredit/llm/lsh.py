"""Links between sets by banded signatures, confirmed on the full sets.

Band values that two sets or more share are buckets.  Each set meets the bucket
centre it shares most bands with, and the pair is confirmed on the full sets (a
centre's group is salted).  Buckets whose members are by then in one component
are settled.  In the others, members of different components meet in blocks:
the signatures pick pairs that could reach the threshold (the sizes alone, where a
set has fewer elements than the estimate needs), and those members' full sets
confirm the links.  Blocks bound every task; no pair is left out.

Elements are hashes of 48 bits; a set is kept as its packed elements.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathcredit.llm.common import binary_array, ids_of, mix, table, utf8
from pathcredit.llm.components import components

BITS = 48  # of an element's hash


@dataclass(frozen=True)
class Near:
    """Link when ``100 * intersection >= percent * union``.  ``few``: sets of fewer
    elements are compared whatever their estimate, for signatures whose registers
    are not independent there."""

    percent: int
    shingle: int
    bands: int
    rows: int
    centre_rows: int = 1024
    block_rows: int = 1024
    few: int = 0

    @property
    def registers(self) -> int:
        return self.bands * self.rows

    @property
    def least_estimate(self) -> float:
        """4.5 standard deviations of the estimate under the threshold."""
        j = self.percent / 100
        return j - 4.5 * (j * (1 - j) / self.registers) ** 0.5


#: A column of full sets (packed, or in a shorter form) to (elements, first).
Unpack = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]
#: (elements, first) to one row of 64-bit registers a set.
Signature = Callable[[np.ndarray, np.ndarray, int], np.ndarray]


def mixed_bands(registers: np.ndarray, near: Near) -> np.ndarray:
    """Band values: neighbouring registers, and the band's own number."""
    out = np.zeros((len(registers), near.bands), np.uint64)
    for j in range(near.rows):
        out = mix(out + registers[:, j :: near.rows][:, : near.bands])
    return mix(out + np.arange(near.bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def packed(elements: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(elements.view(np.uint8).reshape(-1, 8)[:, : BITS // 8])


def unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(elements, first) of a column of packed sets."""
    data, offsets = utf8(column)
    out = np.zeros((len(data) // (BITS // 8), 8), np.uint8)
    out[:, : BITS // 8] = data.reshape(-1, BITS // 8)
    return out.view(np.uint64).ravel(), offsets // (BITS // 8)


# ------------------------------------------------------------------ links

_LINK = pa.schema([("u", pa.int64()), ("v", pa.int64())])
_LINK_DDL = "u long, v long"
#: Rows that a bundle of small groups holds on average.
_BUNDLE_ROWS = 2000


def _bundled(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Deal the groups of ``keys`` to bundles: one call for many small groups."""
    bundles = max(1, rows.count() // _BUNDLE_ROWS)
    return rows.withColumn("bundle", F.pmod(F.xxhash64(*keys), F.lit(bundles)))


def _groups(bundle: pa.Table, keys: list[str]):
    """Row numbers of every group in a bundle."""
    columns = [bundle.column(k).to_numpy() for k in keys]
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[order][1:] != c[order][:-1]
    return np.split(order, np.flatnonzero(new)[1:]) if len(order) else []


def _spread(first: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(element indexes, place in ``rows``) of the sets of some rows, one after another."""
    n = first[rows + 1] - first[rows]
    return np.repeat(first[rows] - (np.cumsum(n) - n), n) + np.arange(n.sum()), np.repeat(np.arange(len(rows)), n)


def _common(elements: np.ndarray, first: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Size of the intersection of each pair of rows; sets are sorted."""
    out = np.zeros(len(left), np.int64)
    for a in range(0, len(left), 1 << 15):  # a pair's number stands above its elements' bits
        part = slice(a, a + (1 << 15))
        keys = []
        for rows in (left[part], right[part]):
            at, pair = _spread(first, rows)
            keys.append((pair.astype(np.uint64) << np.uint64(BITS)) | elements[at])
        if len(keys[0]) and len(keys[1]):
            place = np.minimum(np.searchsorted(keys[0], keys[1]), len(keys[0]) - 1)
            hit = keys[1][keys[0][place] == keys[1]] >> np.uint64(BITS)
            out[part] = np.bincount(hit.astype(np.int64), minlength=len(out[part]))
    return out


def _couples(groups: list[np.ndarray], comp: np.ndarray, own: np.ndarray, low: np.ndarray, high: np.ndarray):
    """(left, right, rest): the pairs of groups of two rows, vectorised, and the
    larger groups."""
    two = [g for g in groups if len(g) == 2]
    a, b = np.stack(two).T if two else np.zeros((2, 0), np.int64)
    good = (comp[a] != comp[b]) & ((low[a] == high[a]) | (own[a] != own[b]))
    return a[good], b[good], [g for g in groups if len(g) > 2]


#: Groups of up to so many rows are compared many at a time, so many pairs at once.
_SMALL_GROUP = 64
_PAIRS_AT_ONCE = 1 << 16


def _all_pairs(groups: list[np.ndarray]):
    """(left, right): the pairs of rows of some small groups, those of one size together."""
    sizes: dict[int, list[np.ndarray]] = {}
    for rows in groups:
        sizes.setdefault(len(rows), []).append(rows)
    for n, some in sizes.items():
        i, j = np.triu_indices(n, 1)
        step = max(1, _PAIRS_AT_ONCE // max(1, len(i)))
        for k in range(0, len(some) if len(i) else 0, step):
            rows = np.stack(some[k : k + step])
            yield rows[:, i].ravel(), rows[:, j].ravel()


def _pairs(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.Table:
    u, v = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (zip(*found) if found else ((), ())))
    return pa.table([pa.array(u), pa.array(v)], schema=_LINK)


def _with_centre(percent: int, unpack: Unpack):
    def run(bundle: pa.Table) -> pa.Table:
        """Links of centres with their members (rows: centre, salt, member, elements)."""
        members, centres = bundle.column("member").to_numpy(), bundle.column("centre").to_numpy()
        elements, first = unpack(bundle.column("elements").combine_chunks())
        size, left, right = np.diff(first), [], []
        for rows in _groups(bundle, ["centre", "salt"]):
            is_centre = members[rows] == centres[rows]
            left.append(rest := rows[~is_centre])
            right.append(np.full(len(rest), rows[is_centre][0]))
        if not left:
            return _pairs([])
        u, v = np.concatenate(left), np.concatenate(right)
        both = _common(elements, first, v, u)
        linked = 100 * both >= percent * (size[u] + size[v] - both)
        return _pairs([(members[u[linked]], centres[u[linked]])])

    return run


def _could_link(near: Near):
    def run(bundle: pa.Table) -> pa.Table:
        """Members that have, in another component, a partner whose estimate
        reaches the least (or with few elements) and whose first common band this bucket's is."""
        comp, own, at, low, high, size = (bundle.column(x).to_numpy() for x in ("component", "block", "band", "lo", "hi", "size"))
        sketch = utf8(bundle.column("sketch").combine_chunks())[0].reshape(-1, near.registers)
        bands = bundle.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, near.bands)
        wanted = np.zeros(len(comp), bool)
        floor = near.least_estimate * near.registers

        def reaches(i, j):
            less, more = np.minimum(size[i], size[j]), np.maximum(size[i], size[j])
            return ((sketch[i] == sketch[j]).sum(1) >= floor) | ((less < near.few) & (100 * less >= near.percent * more))

        def similar_size(i, j):
            return 100 * np.minimum(size[i], size[j]) >= near.percent * np.maximum(size[i], size[j])

        small, groups = [], []
        for rows in _groups(bundle, ["key", "lo", "hi"]):
            (small if len(rows) <= _SMALL_GROUP else groups).append(rows)
        for a, b in _all_pairs(small):
            for test in (lambda i, j: comp[i] != comp[j], lambda i, j: (low[i] == high[i]) | (own[i] != own[j]), similar_size, reaches):
                good = test(a, b)
                a, b = a[good], b[good]
            earlier = (bands[a] == bands[b]) & (np.arange(near.bands) < at[a][:, None])
            good = ~earlier.any(1)
            wanted[a[good]] = wanted[b[good]] = True
        for rows in groups:
            lo, hi, band = low[rows[0]], high[rows[0]], at[rows[0]]
            left, right = rows[own[rows] == lo], rows[own[rows] == hi]
            for k, i in enumerate(left.tolist()):
                j = right[k + 1 :] if lo == hi else right
                j = j[comp[j] != comp[i]]
                if len(j):
                    j = j[similar_size(i, j)]
                if len(j):
                    j = j[reaches(i, j)]
                if len(j) and band:
                    j = j[~(bands[j, :band] == bands[i, :band]).any(1)]
                if len(j):
                    wanted[i] = True
                    wanted[j] = True
        return bundle.filter(pa.array(wanted)).select(["key", "lo", "hi", "rep", "component", "block"])

    return run


#: Elements that a product of sets holds at once: counts up to there are exact in
#: single precision.
_COLUMNS = 4096


def _intersections(elements: np.ndarray, edge: np.ndarray) -> Callable[[int], np.ndarray]:
    """From a set's place, the sizes of its intersections with all sets of a group
    (set ``i``: ``elements[edge[i]:edge[i + 1]]``).  Elements of one set alone meet
    nothing.  The others are multiplied as a table of sets by elements, or looked
    up in lists, whichever is less work."""
    n = len(edge) - 1
    order = np.argsort(elements, kind="stable")
    owner, sorted_ = ids_of(edge)[order], elements[order]
    head = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1])) if len(sorted_) else np.zeros(0, np.int64)
    count = np.diff(np.append(head, len(sorted_)))
    more = count > 1
    shared = int(more.sum())
    # a step through a list takes as long as some 50 products, a set's own lookup as a million
    if n * n * shared <= 50 * int((count * count).sum()) + (n << 20):
        met = np.repeat(more, count)
        rows, columns = owner[met], np.repeat(np.arange(shared), count[more])
        both = np.zeros((n, n), np.int64)
        np.fill_diagonal(both, np.diff(edge))
        for at in range(0, shared, _COLUMNS):
            part = slice(*np.searchsorted(columns, [at, at + _COLUMNS]))
            sets = np.zeros((n, min(_COLUMNS, shared - at)), np.float32)
            sets[rows[part], columns[part] - at] = 1
            product = (sets @ sets.T).astype(np.int64)
            np.fill_diagonal(product, 0)
            both += product
        return lambda i: both[i]
    where = np.empty(len(elements), np.int64)
    where[order] = np.repeat(np.arange(len(head)), count)

    def looked_up(i: int) -> np.ndarray:
        lists = where[edge[i] : edge[i + 1]]
        k = count[lists]
        return np.bincount(owner[np.repeat(head[lists] - (np.cumsum(k) - k), k) + np.arange(k.sum())], minlength=n)

    return looked_up


def _within_block(percent: int, unpack: Unpack):
    def run(bundle: pa.Table) -> pa.Table:
        """Links that connect members of different components, on full sets: as many
        as components join, since further ones change nothing."""
        rep, comp, own, low, high = (bundle.column(x).to_numpy() for x in ("rep", "component", "block", "lo", "hi"))
        elements, first = unpack(bundle.column("elements").combine_chunks())
        whole = np.diff(first)
        a, b, groups = _couples(_groups(bundle, ["key", "lo", "hi"]), comp, own, low, high)
        both = _common(elements, first, a, b)
        linked = 100 * both >= percent * (whole[a] + whole[b] - both)
        found = [(rep[a[linked]], rep[b[linked]])]
        for rows in groups:
            lo, hi = low[rows[0]], high[rows[0]]
            size = (first[rows + 1] - first[rows]).astype(np.int64)
            right, label = own[rows] == hi, comp[rows].copy()
            both_of = _intersections(elements[_spread(first, rows)[0]], np.append(0, np.cumsum(size)))
            for i in np.flatnonzero(own[rows] == lo).tolist():
                open_ = right & (label != label[i])
                if not open_.any():
                    continue
                both = both_of(i)
                j = np.flatnonzero(open_ & (100 * both >= percent * (size + size[i] - both)))
                while len(j):  # one link for each component that joins: a spanning forest, not all pairs
                    found.append((rep[rows[[i]]], rep[rows[j[:1]]]))
                    label[label == label[j[0]]] = label[i]
                    j = j[label[j] != label[i]]
        return _pairs(found)

    return run


def similar_sets(values: DataFrame, sets: Callable[[DataFrame], DataFrame], signature: Signature, near: Near, unpack: Unpack = unpacked) -> DataFrame:
    """Links ``u``, ``v`` that connect every pair of sets over the threshold.

    ``values``: (rep, band, key), the band values of every distinct set;
    ``sets``: from (rep, roles) to (rep, elements, roles), the full sets of some;
    ``unpack``: reads such a column of ``elements``;
    ``signature``: registers of the sets, as the band values were made of."""
    # aggregates are written before they meet their rows again, so that a join of
    # the two has a shuffle of its own on either side and a hot key can be split
    shared = table(values.groupBy("key").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).filter("a <> b").select("key"), "shared")
    crowded = table(values.join(shared, "key", "left_semi").distinct(), "crowded")
    count = crowded.count()
    sizes = crowded.groupBy("key").agg(F.count("*").alias("members"))

    # each set with the centre it shares most buckets with; centres: members of the fullest buckets
    fame = crowded.join(sizes, "key").groupBy("rep").agg(F.sum("members").alias("fame"))
    top = F.max(F.struct("fame", "rep"))
    centres = table(crowded.join(fame, "rep").groupBy("key").agg(top.alias("top")).select("key", F.col("top.rep").alias("centre")), "centres", count)
    met = crowded.join(centres, "key").groupBy("rep", "centre").count().filter("rep <> centre")
    best = table(met.groupBy("rep").agg(F.max(F.struct("count", "centre")).alias("top")).select("rep", "top.centre"), "best", count)
    salts = best.groupBy("centre").agg(F.ceil(F.count("*") / near.centre_rows).cast("int").alias("salts"))
    member = best.join(salts, "centre").select("rep", "centre", F.pmod(F.xxhash64("rep"), F.col("salts")).cast("int").alias("salt"))
    centre = salts.select(F.col("centre").alias("rep"), "centre", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    roles = member.unionByName(centre).groupBy("rep").agg(F.collect_list(F.struct("centre", "salt")).alias("roles"))
    full = table(sets(crowded.select("rep").distinct().join(roles, "rep", "left")), "sets")
    grouped = full.select(F.col("rep").alias("member"), "elements", F.inline("roles"))
    first = table(_bundled(grouped, ["centre", "salt"]).groupBy("bundle").applyInArrow(_with_centre(near.percent, unpack), _LINK_DDL), "links")

    # buckets that still hold several components: blocks against blocks
    label = components(first)
    marked = crowded.join(label, crowded.rep == label.node, "left").select("key", "band", "rep", F.coalesce("component", "rep").alias("component"))
    mixed = marked.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b"), F.ceil(F.count("*") / near.block_rows).cast("int").alias("blocks")).filter("a <> b").select("key", "blocks")
    mixed = table(mixed, "mixed", count)
    member = marked.join(mixed, "key").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = table(member.withColumn("other", other).select("key", "band", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "rep", "component", "block"), "dealt")

    def sketched(batches):
        for batch in batches:
            for at in range(0, len(batch), 2000):
                part = batch.slice(at, 2000)
                elements, first = unpack(part.column(1))
                registers = signature(elements, first, near.registers)
                keys = mixed_bands(registers, near).view(np.int64)
                n = np.arange(len(part) + 1)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(pa.array(n * near.bands, pa.int32()), pa.array(keys.ravel())), binary_array((registers & np.uint64(255)).astype(np.uint8), n * near.registers), pa.array(np.diff(first))],
                    ["rep", "bands", "sketch", "size"],
                )

    sketches = full.join(dealt.select("rep").distinct(), "rep", "left_semi").select("rep", "elements").mapInArrow(sketched, "rep long, bands array<long>, sketch binary, size long")
    row = "key long, lo int, hi int, rep long, component long, block int"
    unit = ["key", "lo", "hi"]
    open_ = table(_bundled(dealt, unit).join(sketches, "rep").groupBy("bundle").applyInArrow(_could_link(near), row), "open")
    checked = _bundled(open_, unit).join(full.select("rep", "elements"), "rep").groupBy("bundle")
    return table(first.unionByName(checked.applyInArrow(_within_block(near.percent, unpack), _LINK_DDL)), "links")
