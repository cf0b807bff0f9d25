"""User journeys (rows of at most ``SEGMENT_TOUCHES`` touches of one ``uid``) and
array-free journey summaries.

Ordering is always explicit: ``(time, event_id)`` inside the aggregate, so the
result does not depend on a window's sort surviving into ``collect_list``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pathcredit.functions.columns import CONVERSION, NULL_STATE, PATH_SEP, START
from pathcredit.operators.sequence import chunked_dense_rank, chunked_running_sum, split_hot

ORDER = ("time", "event_id")

# Touches of one journey row.  Fixed: a touch's segment depends on its position
# in its own journey alone, never on other rows or on the cluster.
SEGMENT_TOUCHES = 1000


def _step_key() -> F.Column:
    return F.struct(*[F.col(c) for c in ORDER])


def journey_summary(touches: DataFrame) -> DataFrame:
    """Per ``uid``: first/last channel, last conversion flag, touch count.

    Pure aggregation (``min_by``/``max_by`` with map-side partial aggregation),
    so a hot ``uid`` is combined per map task before the shuffle.
    """
    key = _step_key()
    return touches.groupBy("uid").agg(
        F.min_by("channel", key).alias("first_interaction"),
        F.max_by("channel", key).alias("last_interaction"),
        F.max_by("conversion", key).alias("conversion"),
        F.count(F.lit(1)).alias("touches"),
        F.max("time").alias("last_time"),
    )


_ENDS = ("first_interaction", "last_interaction", "conversion", "touches")


def _segment_rows(ranked: DataFrame, segment_touches: int) -> DataFrame:
    """One row per ``(uid, segment)`` from rows carrying ``visit_order``, the
    position ``pos`` and the journey-level columns."""
    per_segment = ranked.groupBy("uid", F.floor((F.col("pos") - 1) / F.lit(segment_touches)).cast("int").alias("segment")).agg(
        F.array_sort(F.collect_list(F.struct("time", "event_id", "channel", "visit_order"))).alias("steps"),
        *[F.min(c).alias(c) for c in _ENDS],  # one value per uid
    )
    last = F.floor((F.col("touches") - 1) / F.lit(segment_touches))
    ending = F.when(F.col("conversion") == 1, F.lit(PATH_SEP + CONVERSION)).otherwise(F.lit(PATH_SEP + NULL_STATE))
    path = F.concat(
        F.when(F.col("segment") == 0, F.lit(START + PATH_SEP)).otherwise(F.lit("")),
        F.concat_ws(PATH_SEP, F.col("steps.channel")),
        F.when(F.col("segment") == last, ending).otherwise(F.lit("")),
    )
    return per_segment.select(
        "uid",
        path.alias("path"),
        "first_interaction",
        "last_interaction",
        "conversion",
        F.col("steps.visit_order").alias("visiting_order"),
        "segment",
    )


def user_journeys(touches: DataFrame, hot_rows: int | None = None, segment_touches: int = SEGMENT_TOUCHES) -> DataFrame:
    """The gold user-journey table: ``uid, path, first_interaction,
    last_interaction, conversion, visiting_order, segment``.

    ``path`` is ``Start > c1 > .. > cn > Conversion|Null`` in ``(time, event_id)``
    order; ``visiting_order`` holds ``dense_rank`` by time (ties share a rank).

    Every journey is cut, in order, into rows of ``segment_touches`` touches
    (``segment`` 0, 1, ..), whatever the table's size or the cluster; a journey
    of at most that many touches is one row.  Concatenating a journey's paths in
    segment order with the separator gives the full path.

    Ordinary uids get position, rank and journey-level columns from windows over
    one exchange on ``uid``, which the grouping into rows reuses.  Uids that
    :func:`pathcredit.operators.sequence.split_hot` routes to chunks get theirs
    chunk by chunk; their journey-level columns come from one aggregate (a row
    for each hot uid, at most one per partition) that is broadcast, so no task
    ever holds a hot journey's rows or arrays together.
    """
    narrow = touches.select("uid", "time", "event_id", "channel", "conversion")
    ordinary, hot, n_chunks = split_hot(narrow, ["uid"], hot_rows)
    parts = []
    if ordinary is not None:
        ordered = Window.partitionBy("uid").orderBy(*ORDER)
        whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        parts.append(
            ordinary.select(
                "*",
                F.dense_rank().over(Window.partitionBy("uid").orderBy("time")).cast("int").alias("visit_order"),
                F.row_number().over(ordered).cast("long").alias("pos"),
                F.first("channel").over(whole).alias("first_interaction"),
                F.last("channel").over(whole).alias("last_interaction"),
                F.last("conversion").over(whole).alias("_conv"),
                F.count(F.lit(1)).over(whole).alias("touches"),
            )
            .drop("conversion")
            .withColumnRenamed("_conv", "conversion")
        )
    if hot is not None:
        ranked = chunked_dense_rank(hot, ["uid"], "time", ["event_id"], "visit_order", n_chunks)
        placed = chunked_running_sum(ranked, ["uid"], list(ORDER), F.lit(1).cast("long"), "pos", True, n_chunks)
        ends = journey_summary(hot).select(F.col("uid").alias("_uid"), *_ENDS)
        if n_chunks is not None:  # a routed list: one row per hot uid, at most one per partition
            ends = F.broadcast(ends)
        parts.append(placed.drop("conversion").join(ends, F.col("uid").eqNullSafe(F.col("_uid"))).drop("_uid"))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return _segment_rows(rows, segment_touches)


def render_journeys(journeys: DataFrame) -> DataFrame:
    """Arrays rendered as text (for oracle comparison and CSV sinks)."""
    return journeys.withColumn("visiting_order", F.concat_ws(",", F.transform("visiting_order", lambda x: x.cast("string"))))
