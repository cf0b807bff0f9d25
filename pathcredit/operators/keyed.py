"""Keyed tables whose upserts append: every batch is a folder ``version=<n>``, and the
table is, for each key, the rows of its latest version.

An upsert writes its source and nothing else.  The caller numbers the batches (a
stream's epoch, a step of a flow), so a batch that was interrupted and runs again
under its number replaces what it left and touches no other.  :meth:`KeyedTable.compact`
is a job of its own that writes the latest rows to a new folder.

Semantics of MERGE: the rows of a matched key are replaced by the source's, other
source rows are inserted, other target rows stay; NULL keys match nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from pathcredit.operators.upsert import check_unique_matches

VERSION = "version"


class KeyedTable:
    """``schema``: of the rows, as DDL or a struct.  With ``buckets`` the rows of a batch
    lie in folders by a hash of the keys as well, so a reader of a few keys can skip the
    others (``bucket`` and :meth:`read` of some)."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], schema, buckets: int | None = None):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), list(keys), buckets
        self.columns = spark.createDataFrame([], schema)

    def bucket(self) -> F.Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def append(self, rows: DataFrame, version: int, check: bool = False) -> None:
        """Upsert ``rows`` as batch ``version``; ``check``: several source rows for a key
        that the table holds are an error."""
        if check:
            check_unique_matches(self.read(before=version), rows, self.keys)
        out = rows.select(self.columns.columns)
        if self.buckets:
            out = out.withColumn("bucket", self.bucket()).repartition("bucket", *self.keys).write.partitionBy("bucket")
        else:
            out = out.write
        out.mode("overwrite").parquet(f"{self.path}/{VERSION}={version}")

    def _rows(self) -> DataFrame:
        own = [StructField(VERSION, LongType())] + ([StructField("bucket", IntegerType())] if self.buckets else [])
        return self.spark.read.schema(StructType([*self.columns.schema.fields, *own])).parquet(self.path)

    def read(self, before: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        """The latest rows of every key (of those under ``before``; in some ``buckets``)."""
        rows = self._rows()
        if before is not None:
            rows = rows.filter(F.col(VERSION) < before)
        if buckets is not None:
            rows = rows.filter(F.col("bucket").isin(list(buckets)))
        known = F.lit(True)
        for k in self.keys:
            known = known & F.col(k).isNotNull()
        latest = rows.filter(known).groupBy(*self.keys).agg(F.max(VERSION).alias(VERSION))
        kept = rows.filter(known).join(latest, [*self.keys, VERSION], "left_semi").unionByName(rows.filter(~known))
        return kept.select(self.columns.columns)

    def compact(self, path: str, version: int) -> "KeyedTable":
        """The latest rows alone, written as one batch of a new table at ``path``."""
        new = KeyedTable(self.spark, path, self.keys, self.columns.schema, self.buckets)
        new.append(self.read(), version)
        return new
