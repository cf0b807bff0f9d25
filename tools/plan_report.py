"""Write the physical plans of the costly named queries to PLANS.md.

    python tools/plan_report.py [sf_dir] [out_file]

Broadcast joins are off, so the plans have the shape of large tables.  They are
the initial adaptive plans (``explain()``): exchanges, join
strategies, pushed filters and read schemas as planned before AQE re-plans
at runtime.  Inputs that a query writes first (bronze, the edge table) show as
parquet or checkpoint scans.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


COSTLY = (
    "user_journey", "upsert_journeys", "journey_transitions", "gold_attribution", "cpa_summary", "time_decay",
    "linear_touch", "sales_enriched_from_files", "top_referrers",
)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out_file = sys.argv[2] if len(sys.argv) > 2 else "PLANS.md"
    from pathcredit.named import QUERIES
    from pathcredit.session import local_session

    spark = local_session(extra_conf={"spark.sql.autoBroadcastJoinThreshold": "-1"})
    parts = [
        "# Physical plans of the costly named queries\n",
        f"Generated by `python tools/plan_report.py` on `{sf_dir}` (local[8], 8 shuffle partitions, "
        "AQE on, broadcast joins off; initial plans).  Work-folder paths are shortened to `<work>`.\n",
    ]
    for name in COSTLY:
        fn = QUERIES[name]
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            fn(spark, sf_dir).explain()
        plan = re.sub(r"file:/(?!root/testdata)[^\s,\]]*", "<work>", buf.getvalue().strip())
        parts.append(f"\n## {name}\n\n```\n{plan}\n```\n")
    with open(out_file, "w") as fh:
        fh.write("".join(parts))
    print(f"wrote {out_file} ({len(COSTLY)} plans)")


if __name__ == "__main__":
    main()
