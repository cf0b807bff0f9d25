"""Physical layout: cluster a table on a key so parquet min/max statistics
skip files and row groups on key predicates (the single-column case of a
z-order rewrite)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pathcredit.session import shuffle_partitions


def clustered(df: DataFrame, keys: str | list[str], files: int | None = None) -> DataFrame:
    """Range-partition on ``keys`` (each output file holds one range) and sort
    within partitions (tight row-group statistics).  Give the columns that make
    a hot key's rows differ after the key: its rows then spread over files."""
    by = [keys] if isinstance(keys, str) else list(keys)
    n = files or shuffle_partitions(df.sparkSession)
    return df.repartitionByRange(n, *by).sortWithinPartitions(*by)


def write_clustered(df: DataFrame, keys: str | list[str], path: str, files: int | None = None) -> None:
    clustered(df, keys, files).write.mode("errorifexists").parquet(path)
