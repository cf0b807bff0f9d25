"""Benchmark: run every named query (plus the 500,000-user generator) at
``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]`` and print ONE JSON line.

Each query is executed in full with the ``noop`` sink (no driver collect).
Shuffle bytes written per query come from the Spark event log, written to a
fresh scratch directory (one job group per query).
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pathcredit.named import QUERIES  # noqa: E402
from pathcredit.plans.generator import USERS, generate_touches  # noqa: E402
from pathcredit.session import local_session  # noqa: E402


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _shuffle_bytes(log_dir: str) -> dict[str, int]:
    """Shuffle bytes written per job group, from the event log."""
    import zstandard

    events = []
    for f in sorted(glob.glob(f"{log_dir}/*/events*")):
        with open(f, "rb") as fh:
            raw = fh.read()
        if f.endswith(".zstd"):
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        events += [json.loads(line) for line in raw.decode().splitlines() if line.strip()]
    stage_group: dict[int, str] = {}
    for e in events:
        if e["Event"] == "SparkListenerJobStart":
            group = e.get("Properties", {}).get("spark.jobGroup.id")
            for st in e["Stage Infos"]:
                if group:
                    stage_group[st["Stage ID"]] = group
    out: dict[str, int] = {}
    for e in events:
        if e["Event"] == "SparkListenerTaskEnd" and e["Stage ID"] in stage_group:
            written = e.get("Task Metrics", {}).get("Shuffle Write Metrics", {}).get("Shuffle Bytes Written", 0)
            group = stage_group[e["Stage ID"]]
            out[group] = out.get(group, 0) + written
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    log_dir = tempfile.mkdtemp(prefix="run-bench-", dir="/tmp")
    spark = local_session(
        cores=cpus,
        shuffle_partitions=max(cpus, 8),
        app="pathcredit-bench",
        extra_conf={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir},
    )
    sc = spark.sparkContext

    # JVM warm-up (class loading, JIT of codegen paths) on a small generated
    # workload, not on the measured tables; not timed.
    from pyspark.sql import functions as F

    from pathcredit.plans.journeys import journey_summary

    warm = generate_touches(spark, 20_000).withColumnRenamed("step", "event_id")
    _run(journey_summary(warm).groupBy("first_interaction").agg(F.count(F.lit(1))))

    timings: dict[str, float] = {}
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        sc.setJobGroup(name, name)
        t0 = time.perf_counter()
        _run(fn(spark, sf_dir))
        timings[name] = round(time.perf_counter() - t0, 3)
        print(f"{name}: {timings[name]}s", file=sys.stderr, flush=True)

    if not only or "build_all_tables" in only:
        from pathcredit.session import work_dir
        from pathcredit.tables import build_attribution_tables

        sc.setJobGroup("build_all_tables", "build_all_tables")
        t0 = time.perf_counter()
        build_attribution_tables(spark, sf_dir, work_dir(spark, "bench-tables"))
        timings["build_all_tables"] = round(time.perf_counter() - t0, 3)

    if not only or "attribution_500k_users" in only:
        # The reference's default workload: 500,000 generated users (~2.5 M
        # touches) through bronze, journeys, first/last and Markov credit.
        from pathcredit.plans import attribution as A
        from pathcredit.plans import journeys as J
        from pathcredit.plans import markov as M
        from pathcredit.session import materialize

        sc.setJobGroup("attribution_500k_users", "attribution_500k_users")
        t0 = time.perf_counter()
        bronze = materialize(generate_touches(spark, USERS).withColumnRenamed("step", "event_id"), "bench-generated")
        _run(A.gold_attribution(A.outcomes(J.journey_summary(bronze)).checkpoint()))
        _run(M.markov_attribution(M.removal_effects(M.simple_path_probability(M.edge_table(bronze)))))
        _run(J.user_journeys(bronze))
        timings["attribution_500k_users"] = round(time.perf_counter() - t0, 3)

    if not only or "generator_500k_users" in only:
        sc.setJobGroup("generator_500k_users", "generator_500k_users")
        t0 = time.perf_counter()
        _run(generate_touches(spark, USERS))
        timings["generator_500k_users"] = round(time.perf_counter() - t0, 3)

    spark.stop()
    try:
        shuffled = _shuffle_bytes(log_dir)
    except Exception as exc:  # timings matter more than the byte counts
        print(f"shuffle bytes unavailable: {exc}", file=sys.stderr)
        shuffled = {}
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "total_seconds_all_queries",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
                "shuffle_bytes": {q: shuffled.get(q, 0) for q in timings},
                "shuffle_bytes_total": sum(shuffled.get(q, 0) for q in timings),
            }
        )
    )


if __name__ == "__main__":
    main()
