"""Scale run: generated touches through the attribution chain.

    python tools/scale_run.py [users] [cores]

Generates ``users`` journeys with the distributed generator, writes them as a
bronze table under the session's checkpoint directory, then times each stage
(journey summary + first/last touch, transitions + matrix, Markov credit,
journey table) and prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    users = int(sys.argv[1]) if len(sys.argv) > 1 else 1_000_000
    cores = int(sys.argv[2]) if len(sys.argv) > 2 else 8
    from pathcredit.plans import attribution as A
    from pathcredit.plans import journeys as J
    from pathcredit.plans import markov as M
    from pathcredit.plans.generator import generate_touches
    from pathcredit.session import local_session, work_dir

    spark = local_session(cores=cores, shuffle_partitions=cores * 4, app="pathcredit-scale")
    out: dict = {"users": users, "cores": cores}

    def timed(name, fn):
        t0 = time.perf_counter()
        result = fn()
        out[name] = round(time.perf_counter() - t0, 2)
        return result

    path = work_dir(spark, "scale-bronze")
    timed("generate_and_write", lambda: generate_touches(spark, users).withColumnRenamed("step", "event_id")
          .write.parquet(path))
    bronze = spark.read.parquet(path)
    out["touches"] = bronze.count()

    def credit():
        summary = J.journey_summary(bronze)
        return A.gold_attribution(summary).collect()

    timed("first_last_touch", credit)
    edges = timed("transition_matrix", lambda: M.edge_table(bronze))
    out["edges"] = edges.count()
    rows = timed("markov_credit", lambda: M.markov_attribution(M.removal_effects(M.simple_path_probability(edges))).collect())
    out["markov"] = {r.channel: r.attribution_percent for r in rows}
    timed("user_journeys", lambda: J.user_journeys(bronze).write.format("noop").mode("overwrite").save())
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
