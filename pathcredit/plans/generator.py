"""Synthetic touch generator, as a distributed seeded Spark job.

Rules (fixed values of the reference's generator): 500,000 users; a journey
converts with probability 0.14; 1..9 steps uniformly; every step's time is
uniform in whole seconds between the previous step's time and the window end
(so times never decrease but may tie); ordinary steps draw the channel with
weights 20/30/15/30/5; the last step of a converting journey is a
``conversion`` with flag 1 and a channel drawn with weights .3/.2/.1/.39/.01.

Every random number is a hash of ``(seed, user, step, purpose)``, so the
output is the same for any partition count and any retry of a task.  When a
step lands on the window's last second the next steps stay there (the
reference's draw would fail on the empty range).  The
sequential times are built inside the row with ``aggregate`` over the step
indices: no Python loop, no per-row UDF.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pathcredit.functions.columns import CHANNELS

# Fixed values of the reference's generator.
USERS = 500_000
CONVERSION_RATE = 0.14
MAX_STEPS = 9
WINDOW_START = "2020-05-17 13:30:00"
WINDOW_END = "2020-06-10 04:50:00"
STEP_WEIGHTS = (20, 30, 15, 30, 5)
FINAL_WEIGHTS = (0.3, 0.2, 0.1, 0.39, 0.01)

_P53 = 1 << 53


def _uniform(seed: int, *parts: Column | int | str) -> Column:
    """A uniform in [0, 1) from a 64-bit hash of the seed and ``parts``."""
    cols = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    return F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(_P53)).cast("double") / F.lit(float(_P53))


def _weighted_pick(u: Column, weights: tuple[float, ...]) -> Column:
    """Inverse-CDF pick of a channel for a uniform ``u``."""
    total = float(sum(weights))
    expr = F.lit(CHANNELS[-1])
    cum = 0.0
    bounds = []
    for name, w in zip(CHANNELS, weights):
        cum += w / total
        bounds.append((name, cum))
    for name, cum in reversed(bounds[:-1]):
        expr = F.when(u < F.lit(cum), F.lit(name)).otherwise(expr)
    return expr


def generate_touches(
    spark: SparkSession,
    users: int = USERS,
    seed: int = 42,
    partitions: int | None = None,
    conversion_rate: float = CONVERSION_RATE,
) -> DataFrame:
    """Bronze-typed touches ``uid, time, interaction, channel, conversion``
    plus ``step`` (0-based position in the journey)."""
    ids = spark.range(0, users, numPartitions=partitions) if partitions else spark.range(0, users)
    # Whole-second offsets from the window start; wall-clock (NTZ) arithmetic,
    # so the output does not depend on the session time zone.
    span = int((_dt.datetime.fromisoformat(WINDOW_END) - _dt.datetime.fromisoformat(WINDOW_START)).total_seconds())
    start = F.lit(0)
    end = F.lit(span)
    uid = F.col("id")
    journeys = ids.select(
        uid.alias("user"),
        F.md5(F.concat_ws(":", F.lit(str(seed)), uid.cast("string"))).alias("uid"),
        (_uniform(seed, uid, "converts") < F.lit(conversion_rate)).alias("converts"),
        (F.floor(_uniform(seed, uid, "steps") * MAX_STEPS) + 1).cast("int").alias("steps"),
        _weighted_pick(_uniform(seed, uid, "final"), FINAL_WEIGHTS).alias("final_channel"),
    )
    # offsets[i] = offsets[i-1] + floor(u_i * (span - offsets[i-1])), offsets[-1] = 0
    def step(acc: Column, i: Column) -> Column:
        nxt = (acc["last"] + F.floor(_uniform(seed, F.col("user"), i, "time") * (end - acc["last"]))).cast("long")
        return F.struct(nxt.alias("last"), F.concat(acc["times"], F.array(nxt)).alias("times"))

    times = F.aggregate(
        F.sequence(F.lit(0), F.col("steps") - 1),
        F.struct(start.cast("long").alias("last"), F.array().cast("array<long>").alias("times")),
        step,
        lambda acc: acc["times"],
    )
    steps = journeys.select("*", F.posexplode(times).alias("step", "epoch"))
    last = (F.col("step") == F.col("steps") - 1) & F.col("converts")
    ordinary = _weighted_pick(_uniform(seed, F.col("user"), F.col("step"), "channel"), STEP_WEIGHTS)
    return steps.select(
        "uid",
        F.timestamp_add("SECOND", F.col("epoch"), F.to_timestamp_ntz(F.lit(WINDOW_START))).alias("time"),
        F.when(last, F.lit("conversion")).otherwise(F.lit("impression")).alias("interaction"),
        F.when(last, F.col("final_channel")).otherwise(ordinary).alias("channel"),
        last.cast("int").alias("conversion"),
        "step",
    )


def generator_profile(touches: DataFrame) -> DataFrame:
    """Counts that the generator's rules fix: users, touches, converting share,
    step range, per-channel touch counts as one row."""
    per_user = touches.groupBy("uid").agg(
        F.count(F.lit(1)).alias("n"), F.max("conversion").alias("converted")
    )
    return per_user.agg(
        F.count(F.lit(1)).alias("users"),
        F.sum("n").alias("touches"),
        F.avg("converted").alias("conversion_share"),
        F.min("n").alias("min_steps"),
        F.max("n").alias("max_steps"),
    )
