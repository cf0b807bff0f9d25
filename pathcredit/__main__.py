"""Command line: run one named query, or build all attribution tables.

    python -m pathcredit list
    python -m pathcredit query <name> <sf_dir> [--out <dir>] [--show N]
    python -m pathcredit build <sf_dir> <out_dir> [--method simple_path|absorbing|memo_dfs]

The session comes from ``SparkSession.builder.getOrCreate()`` (cluster
settings apply); a local one is created only when no master is configured.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    from pyspark import SparkConf

    from pathcredit.session import ensure_checkpoint_dir, local_session

    spark = SparkSession.builder.getOrCreate() if SparkConf().contains("spark.master") else local_session()
    ensure_checkpoint_dir(spark)
    return spark


def main(argv: list[str] | None = None) -> None:
    from pathcredit.named import QUERIES

    parser = argparse.ArgumentParser(prog="pathcredit")
    sub = parser.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    q = sub.add_parser("query")
    q.add_argument("name", choices=sorted(QUERIES))
    q.add_argument("sf_dir")
    q.add_argument("--out")
    q.add_argument("--show", type=int, default=20)
    b = sub.add_parser("build")
    b.add_argument("sf_dir")
    b.add_argument("out_dir")
    b.add_argument("--method", default="simple_path", choices=["simple_path", "absorbing", "memo_dfs"])
    args = parser.parse_args(argv)

    if args.cmd == "list":
        print("\n".join(sorted(QUERIES)))
        return
    spark = _session()
    if args.cmd == "query":
        df = QUERIES[args.name](spark, args.sf_dir)
        if args.out:
            df.write.mode("errorifexists").parquet(args.out)
        else:
            df.show(args.show, truncate=False)
    else:
        from pathcredit.tables import build_attribution_tables

        for name, table in build_attribution_tables(spark, args.sf_dir, args.out_dir, args.method).items():
            print(f"{name}\t{table.path}")


if __name__ == "__main__":
    main()
