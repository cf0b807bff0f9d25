"""Skew-safe ordered scans within groups: previous/next row, running sums,
dense rank.

``Window.partitionBy(key).orderBy(t)`` sends every row of one key to one task.
If a single user (a bot, a shared device id, a missing id) holds a third of all
touches, that task holds a third of the data.  The operators here route rows:

* **Ordinary keys** take the plain window: one hash exchange on the key.
* **Hot keys** are found by a frequent-items sketch (``approx_top_k`` over a
  hash of the key): one pass that shuffles one small sketch per task, never the
  keys.  A key is hot above ``max(hotKeyRows, rows / partitions)`` rows, so the
  list holds at most as many entries as there are partitions.  It only routes
  rows to a plan: a key that the sketch over- or underrates gets the same
  result by the other route.  Hot rows are then split:

  1. ``repartitionByRange(n, *keys, *order)`` cuts the globally sorted hot rows
     into ``n`` contiguous chunks of similar size; a hot key spans many chunks
     and chunk ids (``spark_partition_id()``) follow the sort order.
  2. The window runs per ``(chunk, key)``: every window group is bounded by the
     chunk size.
  3. Only the first and last group of a chunk continue in a neighbouring chunk.
     A per-chunk summary (``n`` rows, built from the groups' first and last
     rows only) carries boundary values across chunks and is broadcast back
     to patch the boundary rows.

With no hot key the cost is the plain window plus the sketch pass; hot rows pay
a range exchange and a hash exchange.  ``pathcredit.sequence.hotKeyRows``
(session conf) sets the absolute floor of the hot threshold; ``hot_rows=0``
sends everything through the chunked path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pathcredit.session import shuffle_partitions

CHUNK = "_chunk"
HOT_ROWS_CONF = "pathcredit.sequence.hotKeyRows"
DEFAULT_HOT_ROWS = 1_000_000


def _chunked(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int | None) -> DataFrame:
    """Range-partition and tag rows with their chunk id.

    The range bounds come from a sample whose seed depends on the RDD id, so two
    separately planned exchanges of the same input can disagree on bounds.  The
    lazy reliable checkpoint pins ONE partitioner for every consumer (the main
    window and the chunk summaries share its shuffle map stage, recomputation
    after an executor loss reuses the same bounds) and cuts the lineage into
    the shared checkpoint directory.
    """
    n = n or shuffle_partitions(df.sparkSession)
    ranged = df.repartitionByRange(n, *keys, *order).withColumn(CHUNK, F.spark_partition_id())
    return ranged.checkpoint(eager=False)


def _key_struct(keys: Sequence[str]) -> Column:
    return F.struct(*[F.col(k) for k in keys])


def _links(ends: DataFrame, keys: Sequence[str], order: Sequence[str], payload: Column) -> DataFrame:
    """Per chunk: the last row of the previous non-empty chunk (``_before``) and
    the first row of the next one (``_after``), as ``struct(k, v)``.

    ``ends`` holds only the first and last row of every ``(chunk, key)`` group
    (a chunk's first row is a group's first, its last row a group's last), so
    the aggregation reads two rows per group, not the chunk.  ``n`` rows come
    out, so the un-partitioned window and the broadcast are bounded by the
    chunk count."""
    sort_key = F.struct(*[F.col(c) for c in [*keys, *order]])
    edge = F.struct(_key_struct(keys).alias("k"), payload.alias("v"))
    heads = ends.groupBy(CHUNK).agg(F.min_by(edge, sort_key).alias("head"), F.max_by(edge, sort_key).alias("tail"))
    over_chunks = Window.orderBy(CHUNK)
    return heads.select(
        CHUNK,
        F.lag("tail").over(over_chunks).alias("_before"),
        F.lead("head").over(over_chunks).alias("_after"),
    )


def _offsets(heads: DataFrame, keys: Sequence[str], group_total: str) -> DataFrame:
    """Per ``(chunk, key)`` whose key continues from earlier chunks: the sum of
    that key's in-chunk totals over the earlier chunks.  Only a chunk's first
    and last group can cross a boundary: at most 2 rows per chunk.

    ``heads`` holds one row per ``(chunk, key)`` group (its first row, carrying
    the group total), so the smallest and largest key per chunk find the
    chunk's first and last group."""
    key = _key_struct(keys)
    edge = F.struct(key.alias("k"), F.col(group_total).alias("t"))
    ends = heads.groupBy(CHUNK).agg(F.min_by(edge, key).alias("h"), F.max_by(edge, key).alias("l"))
    parts = ends.select(
        CHUNK,
        F.explode(F.when(F.col("h.k").eqNullSafe(F.col("l.k")), F.array("h")).otherwise(F.array("h", "l"))).alias("e"),
    ).select(CHUNK, "e.k", "e.t")
    earlier = Window.partitionBy("k").orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    return parts.select(
        F.col(CHUNK).alias("_oc"),
        *[F.col(f"k.{name}").alias(f"_ok{i}") for i, name in enumerate(keys)],
        F.coalesce(F.sum("t").over(earlier), F.lit(0)).alias("_offset"),
    )


def _join_offsets(local: DataFrame, offsets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on (chunk, key); NULL keys form a group, so keys match null-safely."""
    cond = F.col(CHUNK) == F.col("_oc")
    for i, name in enumerate(keys):
        cond = cond & F.col(name).eqNullSafe(F.col(f"_ok{i}"))
    return local.join(F.broadcast(offsets), cond, "left")


def chunked_neighbors(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    cols: Sequence[str],
    prev_name: str = "prev",
    next_name: str = "next",
    n_chunks: int | None = None,
) -> DataFrame:
    """Add ``prev`` / ``next`` struct columns holding ``cols`` of the adjacent row
    of the same key in ``order`` (NULL at the group ends).

    ``order`` must make rows unique within a key (add a tiebreak column).
    """
    ranged = _chunked(df, keys, order, n_chunks)
    payload = F.struct(*[F.col(c) for c in cols])
    w = Window.partitionBy(CHUNK, *keys).orderBy(*order)
    local = ranged.select("*", F.lag(payload).over(w).alias(prev_name), F.lead(payload).over(w).alias(next_name))
    k = _key_struct(keys)
    ends = local.filter(F.col(prev_name).isNull() | F.col(next_name).isNull())
    patched = local.join(F.broadcast(_links(ends, keys, order, payload)), CHUNK, "left")
    fill_prev = F.col(prev_name).isNull() & k.eqNullSafe(F.col("_before.k"))
    fill_next = F.col(next_name).isNull() & k.eqNullSafe(F.col("_after.k"))
    return patched.select(
        *df.columns,
        F.when(fill_prev, F.col("_before.v")).otherwise(F.col(prev_name)).alias(prev_name),
        F.when(fill_next, F.col("_after.v")).otherwise(F.col(next_name)).alias(next_name),
    )


def chunked_running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str | Column,
    out: str,
    inclusive: bool = True,
    n_chunks: int | None = None,
) -> DataFrame:
    """Add ``out`` = sum of ``value`` over earlier rows of the same key in
    ``order`` (``inclusive`` adds the current row).  0 when there are none."""
    value_col = F.col(value) if isinstance(value, str) else value
    ranged = _chunked(df.withColumn("_v", value_col), keys, order, n_chunks)
    w = Window.partitionBy(CHUNK, *keys).orderBy(*order)
    frame = w.rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    local = ranged.select(
        "*",
        F.coalesce(F.sum("_v").over(frame), F.lit(0)).alias("_local"),
        F.sum("_v").over(Window.partitionBy(CHUNK, *keys)).alias("_group_total"),
        F.row_number().over(w).alias("_rn"),
    )
    heads = local.filter(F.col("_rn") == 1)
    joined = _join_offsets(local, _offsets(heads, keys, "_group_total"), keys)
    return joined.select(*df.columns, (F.col("_local") + F.coalesce(F.col("_offset"), F.lit(0))).alias(out))


def chunked_dense_rank(
    df: DataFrame,
    keys: Sequence[str],
    rank_on: str,
    tiebreak: Sequence[str],
    out: str,
    n_chunks: int | None = None,
) -> DataFrame:
    """``dense_rank() OVER (PARTITION BY keys ORDER BY rank_on)`` without a
    single-task group, in one chunking: a row starts a new rank when
    ``rank_on`` differs from the previous row's (the previous row may sit in
    the previous chunk), and the rank is the running count of such starts."""
    order = [rank_on, *tiebreak]
    ranged = _chunked(df, keys, order, n_chunks)
    w = Window.partitionBy(CHUNK, *keys).orderBy(*order)
    local = ranged.select(
        "*",
        F.lag(rank_on).over(w).alias("_p"),
        F.row_number().over(w).alias("_rn"),
        F.lead(F.lit(1)).over(w).isNull().alias("_last"),
    )
    payload = F.struct(F.col(rank_on).alias("r"))
    ends = local.filter((F.col("_rn") == 1) | F.col("_last"))
    linked = local.join(F.broadcast(_links(ends, keys, order, payload)), CHUNK, "left")
    continues = (F.col("_rn") == 1) & _key_struct(keys).eqNullSafe(F.col("_before.k"))
    previous = F.when(continues, F.col("_before.v.r")).otherwise(F.col("_p"))
    starts = F.when(((F.col("_rn") == 1) & ~continues) | ~previous.eqNullSafe(F.col(rank_on)), 1).otherwise(0)
    flagged = linked.select(*ranged.columns, "_rn", starts.alias("_start"))
    # Same partitioning and order as above: no new exchange or sort.
    counted = flagged.select(
        "*",
        F.sum("_start").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("_local"),
        F.sum("_start").over(Window.partitionBy(CHUNK, *keys)).alias("_group_total"),
    )
    joined = _join_offsets(counted, _offsets(counted.filter(F.col("_rn") == 1), keys, "_group_total"), keys)
    return joined.select(
        *df.columns, (F.col("_local") + F.coalesce(F.col("_offset"), F.lit(0))).cast("int").alias(out)
    )


# ------------------------------------------------------------------ routing


# Items the sketch tracks: its error is a small multiple of rows / items, far
# below the smallest hot share (rows / partitions).
_SKETCH_ITEMS = 10_000


def split_hot(df: DataFrame, keys: Sequence[str], hot_rows: int | None = None):
    """``(ordinary_rows, hot_rows_df, n_chunks)``; either frame may be None.

    Routing goes by a 64-bit hash of the key (NULL keys hash too), so a hash
    collision moves a key to the other route and changes no result.
    """
    spark = df.sparkSession
    floor = int(spark.conf.get(HOT_ROWS_CONF, str(DEFAULT_HOT_ROWS))) if hot_rows is None else hot_rows
    if floor <= 0:
        return None, df, None
    parts = shuffle_partitions(spark)
    # A plain count needs no shuffle (parquet inputs answer it from footers):
    # an input of at most `floor` rows cannot hold a key above the threshold.
    total = df.count()
    if total <= floor:
        return df, None, None
    threshold = max(floor, -(-total // parts))
    code = F.xxhash64(*keys)
    asked = min(parts, _SKETCH_ITEMS)
    top = df.select(code.alias("_code")).agg(F.expr(f"approx_top_k(_code, {asked}, {_SKETCH_ITEMS})").alias("top")).first()[0]
    hot = {r["item"]: r["count"] for r in top if r["count"] > threshold}
    if not hot:
        return df, None, None
    is_hot = code.isin(list(hot))  # at most `parts` literals
    n_chunks = max(2, min(parts, -(-sum(hot.values()) // threshold) * 2))
    return df.filter(~is_hot), df.filter(is_hot), n_chunks


def _route(df, keys, hot_rows, n_chunks, plain, chunked):
    ordinary, hot, n_hot = split_hot(df, keys, hot_rows)
    parts = []
    if ordinary is not None:
        parts.append(plain(ordinary))
    if hot is not None:
        parts.append(chunked(hot, n_chunks or n_hot))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def neighbors(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    cols: Sequence[str],
    prev_name: str = "prev",
    next_name: str = "next",
    n_chunks: int | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Add ``prev`` / ``next`` struct columns holding ``cols`` of the adjacent row
    of the same key in ``order`` (NULL at the group ends).  ``order`` must make
    rows unique within a key (add a tiebreak column)."""

    def plain(part: DataFrame) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(*order)
        payload = F.struct(*[F.col(c) for c in cols])
        return part.select("*", F.lag(payload).over(w).alias(prev_name), F.lead(payload).over(w).alias(next_name))

    return _route(
        df, keys, hot_rows, n_chunks, plain,
        lambda part, n: chunked_neighbors(part, keys, order, cols, prev_name, next_name, n),
    )


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str | Column,
    out: str,
    inclusive: bool = True,
    n_chunks: int | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Add ``out`` = sum of ``value`` over earlier rows of the same key in
    ``order`` (``inclusive`` adds the current row); 0 when there are none."""
    value_col = F.col(value) if isinstance(value, str) else value

    def plain(part: DataFrame) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(
            Window.unboundedPreceding, Window.currentRow if inclusive else -1
        )
        return part.select("*", F.coalesce(F.sum(value_col).over(w), F.lit(0)).alias(out))

    return _route(
        df, keys, hot_rows, n_chunks, plain,
        lambda part, n: chunked_running_sum(part, keys, order, value, out, inclusive, n),
    )


def dense_rank_by(
    df: DataFrame,
    keys: Sequence[str],
    rank_on: str,
    tiebreak: Sequence[str],
    out: str,
    n_chunks: int | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """``dense_rank() OVER (PARTITION BY keys ORDER BY rank_on)``."""

    def plain(part: DataFrame) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(rank_on)
        return part.select("*", F.dense_rank().over(w).cast("int").alias(out))

    return _route(
        df, keys, hot_rows, n_chunks, plain,
        lambda part, n: chunked_dense_rank(part, keys, rank_on, tiebreak, out, n),
    )
