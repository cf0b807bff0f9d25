"""Refresh of credit from changed journeys: the old journeys of the touched uids are
taken out of the stored counts and their new ones put in.

Credit needs journeys only as counts (by first channel, last channel and outcome;
by state change), so a refresh reads the change, the touched uids' stored journeys,
and two small count tables.  Journeys of other uids are neither read nor counted
again: the stored journeys lie in folders by a hash of the uid, and only those of
the touched uids are opened.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathcredit.operators.keyed import KeyedTable


def stored_rows_of(table: KeyedTable, source: DataFrame, before: int | None = None) -> DataFrame:
    """The stored rows (of versions under ``before``) of the keys that ``source`` holds;
    at most ``table.buckets`` integers pass through the driver."""
    keys = source.select(*table.keys).distinct()
    buckets = [r[0] for r in keys.select(table.bucket().alias("b")).distinct().collect()]
    return table.read(before=before, buckets=buckets).join(keys, table.keys, "left_semi")


def retracted(stored: DataFrame, old: DataFrame, new: DataFrame, count: str) -> DataFrame:
    """Counts ``stored`` without those of ``old`` and with those of ``new``; the other
    columns are the group.  Groups that nothing is left of are gone."""
    groups = [c for c in stored.columns if c != count]
    signed = stored.unionByName(old.withColumn(count, -F.col(count))).unionByName(new)
    return signed.groupBy(*groups).agg(F.sum(count).alias(count)).filter(F.col(count) > 0)


def refreshed(table: KeyedTable, source: DataFrame, version: int, stored: DataFrame, counted, count: str) -> DataFrame:
    """The counts after ``source`` (all new rows of its keys) is upserted into ``table`` as
    batch ``version``; ``counted`` turns rows into counts.  The same batch again gives the
    same: old rows are those of earlier versions."""
    old = counted(stored_rows_of(table, source, before=version))
    counts = retracted(stored, old, counted(source), count).checkpoint()
    table.append(source, version)
    return counts
