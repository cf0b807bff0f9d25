"""Heuristic channel credit: first touch, last touch (and the prose-only linear
and time-decay models), plus the derived per-model conversion counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pathcredit.functions.columns import ratio

FIRST_TOUCH = "first_touch"
LAST_TOUCH = "last_touch"
MARKOV = "markov_chain"
LINEAR = "linear"
TIME_DECAY = "time_decay"


def _share_of_total(counts: DataFrame, count_col: str = "n") -> F.Column:
    # ``counts`` has one row per channel: the global window is over a table
    # bounded by the number of channels, and avoids a second scan for the total.
    return ratio(F.col(count_col), F.sum(count_col).over(Window.partitionBy()))


def outcomes(summary: DataFrame) -> DataFrame:
    """Journeys counted by ``(first_interaction, last_interaction, conversion)``:
    at most #channels^2 rows per outcome.  Every heuristic credit and every
    denominator comes from these counts, so the touches are read once."""
    return summary.groupBy("first_interaction", "last_interaction", "conversion").agg(F.count(F.lit(1)).alias("journeys"))


def journeys_in(summary: DataFrame) -> F.Column:
    """Number of journeys in a group of summary rows, or of their counts."""
    return F.sum("journeys") if "journeys" in summary.columns else F.count(F.lit(1))


def touch_credit(summary: DataFrame, model: str, by: str) -> DataFrame:
    """``round(count / converting journeys, 2)`` per channel of ``by``;
    ``summary``: journeys, or their counts (:func:`outcomes`)."""
    counts = summary.filter(F.col("conversion") == 1).groupBy(F.col(by).alias("channel")).agg(journeys_in(summary).alias("n"))
    return counts.select(
        F.lit(model).alias("attribution_model"),
        "channel",
        F.round(_share_of_total(counts), 2).alias("attribution_percent"),
    )


def first_touch(summary: DataFrame) -> DataFrame:
    return touch_credit(summary, FIRST_TOUCH, "first_interaction")


def last_touch(summary: DataFrame) -> DataFrame:
    return touch_credit(summary, LAST_TOUCH, "last_interaction")


def gold_attribution(summary: DataFrame) -> DataFrame:
    """First- and last-touch credit in one table.  The two sides cannot share a
    row (the model name differs), so the reference's UNION needs no distinct."""
    return first_touch(summary).unionByName(last_touch(summary))


def convertingjourneys_in(summary: DataFrame) -> F.Column:
    """Scalar subquery: number of converting journeys."""
    n = F.coalesce(journeys_in(summary), F.lit(0))
    return summary.filter(F.col("conversion") == 1).select(n).scalar()


def attribution_by_model(attribution: DataFrame, summary: DataFrame) -> DataFrame:
    """``round(attribution_percent * converting journeys)`` per model and channel."""
    return attribution.select(
        "attribution_model",
        "channel",
        F.round(F.col("attribution_percent") * convertingjourneys_in(summary)).alias("conversions_attributed"),
    )


def model_percent(attribution: DataFrame, model: str = MARKOV) -> DataFrame:
    """Rows of one model with the share scaled to percent."""
    return attribution.filter(F.col("attribution_model") == F.lit(model)).withColumn(
        "percentage", F.col("attribution_percent") * 100
    )


# ---- models described in the reference's prose only (no code there) ----------


def _credit_from_weights(weighted: DataFrame, model: str) -> DataFrame:
    """``weighted`` has ``uid, channel, w`` of converting journeys, a few rows per
    uid.  Each journey's weights are normalised to 1, then summed per channel;
    the sum over channels is the number of converting journeys."""
    per_uid_channel = weighted.groupBy("uid", "channel").agg(F.sum("w").alias("w"))
    norm = per_uid_channel.withColumn("credit", F.col("w") / F.sum("w").over(Window.partitionBy("uid")))
    per_channel = norm.groupBy("channel").agg(F.sum("credit").alias("credit"))
    total = F.sum("credit").over(Window.partitionBy())  # one row per channel
    return per_channel.select(
        F.lit(model).alias("attribution_model"),
        "channel",
        F.round(ratio(F.col("credit"), F.round(total)), 6).alias("attribution_percent"),
    )


def _ends(per_group: DataFrame) -> DataFrame:
    """Adds the journey's last step to rows of a uid that carry their own last
    step; the window runs over pre-aggregated rows."""
    return per_group.withColumn("end", F.max("last").over(Window.partitionBy("uid"))).filter("end.conversion = 1")


def linear_touch(touches: DataFrame) -> DataFrame:
    """Every touch of a converting journey gets an equal share.  Touches are
    counted per (uid, channel) before anything meets on the uid (partial
    aggregation): at most one row per channel and uid is left then."""
    per_uid_channel = touches.groupBy("uid", "channel").agg(
        F.count(F.lit(1)).cast("double").alias("w"), F.max(F.struct("time", "event_id", "conversion")).alias("last")
    )
    return _credit_from_weights(_ends(per_uid_channel), LINEAR)


def time_decay(touches: DataFrame, half_life_hours: float = 24.0) -> DataFrame:
    """Weight ``2^(-(t_last - t) / half_life)``, normalised per journey.

    With ``t / half_life = d + f`` (whole and fraction), touches are summed as
    ``2^f`` per (uid, channel, d) first: rows of a uid then follow the half-lives
    it spans, not its touches.  ``2^(d - t_last / half_life)`` is applied after.
    """
    at = F.timestamp_diff("MICROSECOND", F.lit("2000-01-01 00:00:00").cast("timestamp_ntz"), F.col("time").cast("timestamp_ntz")) / F.lit(
        3.6e9 * float(half_life_hours)
    )
    timed = touches.withColumn("at", at).withColumn("d", F.floor("at"))
    per_group = timed.groupBy("uid", "channel", "d").agg(
        F.sum(F.pow(F.lit(2.0), F.col("at") - F.col("d"))).alias("w"),
        F.max(F.struct("time", "event_id", "conversion", "at")).alias("last"),
    )
    decayed = _ends(per_group).withColumn("w", F.col("w") * F.pow(F.lit(2.0), F.col("d") - F.col("end.at")))
    return _credit_from_weights(decayed, TIME_DECAY)
