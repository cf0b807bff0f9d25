"""Skew check: one uid holding a third of all touches.

    python tools/skew_check.py [sf_dir]

Re-keys every third touch (by a hash of the event id) of the given tables'
touches onto one uid, then computes previous/next touch per uid twice: with a
plain ``Window.partitionBy(uid)`` and with the routed skew-safe operator.
Checks that both agree and prints, from the Spark event log (written to a
fresh scratch directory), the largest share of rows any single task read from
a shuffle for each variant.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def _events(log_dir: str) -> list[dict]:
    import zstandard

    out = []
    for f in sorted(glob.glob(f"{log_dir}/*/events*")):
        with open(f, "rb") as fh:
            raw = fh.read()
        if f.endswith(".zstd"):
            raw = zstandard.ZstdDecompressor().stream_reader(__import__("io").BytesIO(raw)).read()
        out += [json.loads(line) for line in raw.decode().splitlines() if line.strip()]
    return out


def _max_task_share(events: list[dict], group: str) -> tuple[int, int]:
    """(largest shuffle-read record count of one task, total) over the jobs of
    a job group; stages reading fewer than 1,000 records (summaries) are left
    out of the maximum."""
    stage_group = {}
    for e in events:
        if e["Event"] == "SparkListenerJobStart" and e.get("Properties", {}).get("spark.jobGroup.id") == group:
            for s in e["Stage Infos"]:
                stage_group[s["Stage ID"]] = group
    per_stage: dict[int, list[int]] = {}
    for e in events:
        if e["Event"] == "SparkListenerTaskEnd" and e["Stage ID"] in stage_group:
            read = e.get("Task Metrics", {}).get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
            per_stage.setdefault(e["Stage ID"], []).append(read)
    big = {k: r for k, r in per_stage.items() if sum(r) >= 1000}
    if os.environ.get("SKEW_CHECK_VERBOSE"):
        for k, r in sorted(big.items()):
            print(f"  {group} stage {k}: tasks {len(r)} max {max(r)} total {sum(r)}", file=sys.stderr)
    return max((max(r) for r in big.values()), default=0), sum(sum(r) for r in big.values())


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="run-skew-", dir="/tmp")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "16")
        .config("spark.sql.adaptive.enabled", "true")
        # keep planned partitions: at this size AQE would merge them all and
        # hide where the rows of one key land
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", log_dir)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from pathcredit.operators.sequence import HOT_ROWS_CONF, neighbors
    from pathcredit.session import ensure_checkpoint_dir
    from pathcredit.sources.fixtures import load_touches

    ensure_checkpoint_dir(spark)
    # a small floor so that, at test scale, the threshold is rows / partitions
    spark.conf.set(HOT_ROWS_CONF, "1000")
    sc = spark.sparkContext
    touches = load_touches(spark, sf_dir)
    hot = F.pmod(F.xxhash64("event_id"), F.lit(3)) == 0
    skewed = touches.withColumn("uid", F.when(hot, F.lit("HOT")).otherwise(F.col("uid"))).checkpoint()
    n, n_hot = skewed.count(), skewed.filter(F.col("uid") == "HOT").count()

    results = {}
    for variant in ("plain_window", "routed"):
        sc.setJobGroup(variant, variant)
        t0 = time.perf_counter()
        if variant == "plain_window":
            w = Window.partitionBy("uid").orderBy("time", "event_id")
            out = skewed.select("event_id", F.lag("channel").over(w).alias("p"), F.lead("channel").over(w).alias("n"))
        else:
            nb = neighbors(skewed, ["uid"], ["time", "event_id"], ["channel"])
            out = nb.select("event_id", F.col("prev.channel").alias("p"), F.col("next.channel").alias("n"))
        results[variant] = out.checkpoint()
        results[variant + "_sec"] = round(time.perf_counter() - t0, 2)
    sc.setJobGroup("compare", "compare")
    same = results["plain_window"].exceptAll(results["routed"]).count() == 0
    spark.stop()

    events = _events(log_dir)
    report = {"rows": n, "hot_rows": n_hot, "results_equal": same}
    for variant in ("plain_window", "routed"):
        best, total = _max_task_share(events, variant)
        report[variant] = {"max_task_shuffle_records": best, "sec": results[variant + "_sec"]}
    print(json.dumps(report))


if __name__ == "__main__":
    main()
