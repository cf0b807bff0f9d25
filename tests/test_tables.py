"""End-to-end table build: every table written once, matching the named
queries that compute the same thing from scratch."""

import glob
import os

from pyspark.sql import functions as F

from pathcredit.named import QUERIES
from pathcredit.operators import catalog
from pathcredit.tables import build_attribution_tables
from tests.conftest import SF001


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_build_matches_named_queries(spark, scratch):
    tables = build_attribution_tables(spark, SF001, scratch)
    assert tables["bronze"].metrics["rows"] == 1000
    assert all(tables["bronze"].metrics[e] == 0 for e in ("valid_uid", "valid_time", "valid_channel", "valid_conversion"))
    read = {name: t.read() for name, t in tables.items()}
    assert _same(read["gold_attribution"], QUERIES["upsert_attribution"](spark, SF001))
    cols = ["channel", "dollar_spend", "attribution_model", "conversions_attributed", "CPA_in_Dollars"]
    assert _same(read["cpa_summary"].select(cols), QUERIES["cpa_summary"](spark, SF001).select(cols))
    assert _same(read["spend_optimization_final"], QUERIES["spend_comparison"](spark, SF001))
    assert _same(read["conversions_by_date"], QUERIES["conversions_by_date"](spark, SF001))
    journeys = read["gold_user_journey"].withColumn(
        "visiting_order", F.concat_ws(",", F.transform("visiting_order", lambda x: x.cast("string")))
    )
    assert _same(journeys, QUERIES["user_journey"](spark, SF001))
    assert {r[0] for r in spark.read.parquet(tables["gold_attribution"].path).select("version").distinct().collect()} == {0, 1}  # created, then the Markov upsert
    assert catalog.table_comment(spark, tables["cpa_summary"].name) == "cost per acquisition"


def _files(root):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{root.removeprefix('file:')}/**/*", recursive=True) if os.path.isfile(f)}


def test_build_twice(spark, scratch):
    """The second build finds every table and changes none."""
    first = build_attribution_tables(spark, SF001, scratch)
    before = _files(scratch)
    second = build_attribution_tables(spark, SF001, scratch)
    assert all(t.written for t in first.values()) and not any(t.written for t in second.values())
    assert _files(scratch) == before
    assert second["bronze"].metrics == first["bronze"].metrics and second["bronze"].metrics["rows"] == 1000
    assert _same(first["gold_attribution"].read(), second["gold_attribution"].read())


def test_build_goes_on_after_a_crash(spark, scratch):
    """A later session, whose catalog knows nothing: tables that lie there are registered,
    a step without its record runs again."""
    first = build_attribution_tables(spark, SF001, scratch)
    rows = first["cpa_summary"].read().collect()
    spark.sql(f"DROP DATABASE {first['bronze'].name.split('.')[0]} CASCADE")
    for f in glob.glob(f"{scratch.removeprefix('file:')}/build_steps/step=cpa_summary/*"):
        os.remove(f)
    second = build_attribution_tables(spark, SF001, scratch)
    assert [n for n, t in second.items() if t.written] == ["cpa_summary"]
    assert sorted(second["cpa_summary"].read().collect()) == sorted(rows)


def test_cli_list(capsys):
    from pathcredit.__main__ import main

    main(["list"])
    assert "markov_attribution" in capsys.readouterr().out


def test_cli_query_and_build(spark, scratch, capsys):
    from pathcredit.__main__ import main

    main(["query", "first_touch", SF001, "--show", "5"])
    assert "first_touch" in capsys.readouterr().out
    main(["query", "transition_row_sums", SF001, "--out", f"{scratch}/sums"])
    assert spark.read.parquet(f"{scratch}/sums").count() == 6
    main(["build", SF001, f"{scratch}/tables", "--method", "absorbing"])
    printed = capsys.readouterr().out
    assert "gold_attribution" in printed and "spend_optimization_final" in printed
