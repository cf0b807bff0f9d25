"""Data-quality expectations: named predicates on a dataset's output columns.

* ``warn`` (record only): violations are counted, every row is kept.
* ``fail``: any violation aborts the update; the published table is untouched.

A predicate that evaluates to NULL counts as a violation.  Counting happens in
the same pass as the write (``DataFrame.observe``), and ``fail`` is enforced
in-plan with ``raise_error`` so the write job aborts before it commits.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Expectation:
    name: str
    predicate: str  # SQL boolean expression over the dataset's columns
    action: str = "warn"  # "warn" | "fail"

    def passed(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def expectation_counts(df: DataFrame, dataset: str, expectations: list[Expectation]) -> DataFrame:
    """``(dataset, expectation, action, passed, failed)``: one aggregation pass
    (partial aggregates per task), one row per expectation."""
    aggs = []
    for i, e in enumerate(expectations):
        ok = e.passed()
        aggs.append(F.sum(F.when(ok, 1).otherwise(0)).alias(f"p{i}"))
        aggs.append(F.sum(F.when(ok, 0).otherwise(1)).alias(f"f{i}"))
    totals = df.agg(*aggs)
    rows = F.array(
        *[
            F.struct(
                F.lit(e.name).alias("expectation"),
                F.lit(e.action).alias("action"),
                F.coalesce(F.col(f"p{i}"), F.lit(0)).alias("passed"),
                F.coalesce(F.col(f"f{i}"), F.lit(0)).alias("failed"),
            )
            for i, e in enumerate(expectations)
        ]
    )
    return totals.select(F.explode(rows).alias("r")).select(
        F.lit(dataset).alias("dataset"), "r.expectation", "r.action",
        F.col("r.passed").cast("long").alias("passed"), F.col("r.failed").cast("long").alias("failed"),
    )


def enforce(df: DataFrame, expectations: list[Expectation]) -> DataFrame:
    """Rows pass through unchanged; a ``fail`` expectation raises on the first
    violating row, which aborts the job that consumes the frame."""
    guarded = df
    for e in expectations:
        if e.action == "fail":
            guarded = guarded.filter(
                F.when(~e.passed(), F.raise_error(F.lit(f"expectation '{e.name}' violated: {e.predicate}"))).otherwise(
                    F.lit(True)
                )
            )
    return guarded


def observed(df: DataFrame, name: str, expectations: list[Expectation]) -> tuple[DataFrame, Observation]:
    """Attach violation counters that are filled in by whatever action runs on
    the returned frame (typically the table write)."""
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")] + [
        F.sum(F.when(e.passed(), 0).otherwise(1)).alias(e.name) for e in expectations
    ]
    return df.observe(obs, *metrics), obs


def publish(df: DataFrame, path: str, expectations: list[Expectation], mode: str = "errorifexists") -> dict:
    """Write ``df`` to ``path`` (a new snapshot directory) after checking the
    expectations in the same job.  On a ``fail`` violation the job aborts before
    commit, so nothing is published.  Returns the observed counters."""
    checked, obs = observed(enforce(df, expectations), "expectations", expectations)
    checked.write.mode(mode).parquet(path)
    return obs.get
