"""Keyed upsert (MERGE ... WHEN MATCHED UPDATE SET * WHEN NOT MATCHED INSERT *)
for plain parquet tables, plus a per-upsert audit row.

Semantics reproduced:
* matched target rows take all source values; unmatched source rows are
  inserted; target rows without a source row are kept (nothing is deleted);
* NULL keys never match (SQL equality), so they are always inserted/kept;
* two source rows matching one target row is an error.

The merged rows are ``source UNION ALL (target LEFT ANTI JOIN source)``: one
shuffle of each side on the key (none for a side already bucketed or
partitioned on it).  :mod:`pathcredit.operators.keyed` keeps tables whose upserts
write the source alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class DuplicateSourceKeyError(ValueError):
    pass


def _not_null(keys: Sequence[str]) -> F.Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def check_unique_matches(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a target row would be matched by more than one source row.
    Aggregates only the source keys (partial aggregation), semi-joins the
    duplicates with the target keys, and asks for one row at most."""
    dup = (
        source.filter(_not_null(keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
        .join(target.select(*keys), list(keys), "left_semi")
    )
    if not dup.isEmpty():
        raise DuplicateSourceKeyError(f"source has several rows for a matched key in {list(keys)}")


def merge(target: DataFrame, source: DataFrame, keys: Sequence[str], check: bool = True) -> DataFrame:
    """The merged table as a DataFrame (columns of ``target``, by name)."""
    if check:
        check_unique_matches(target, source, keys)
    kept = target.join(source.select(*keys).filter(_not_null(keys)), list(keys), "left_anti")
    return source.select(*target.columns).unionByName(kept)


def audit(target: DataFrame, source: DataFrame, keys: Sequence[str], table_name: str) -> DataFrame:
    """One row: how many rows the upsert inserts (source rows without a match),
    updates (source rows with one) and keeps (target rows without one).  Rows are
    counted per key first (partial aggregation), and one full outer join of the
    two counts follows; NULL keys never match."""
    t = target.groupBy(*keys).agg(F.count(F.lit(1)).alias("_t"))
    s = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_s"))
    both = t.join(s, [t[k] == s[k] for k in keys], "full_outer")

    def rows(n: str, when: F.Column) -> F.Column:
        return F.coalesce(F.sum(F.when(when, F.col(n))), F.lit(0)).cast("long")

    return both.agg(
        rows("_s", F.col("_t").isNull()).alias("rows_inserted"),
        rows("_s", F.col("_t").isNotNull()).alias("rows_updated"),
        rows("_t", F.col("_s").isNull()).alias("rows_kept"),
    ).select(F.lit(table_name).alias("table_name"), "*")
