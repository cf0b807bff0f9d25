"""Tables in Spark's catalog: created once from a query, replaced by one, declared
empty with their types, filled by a parametrised insert, all with comments.

A catalog entry is made only after its data are committed, so an interrupted
creation leaves no table; its leftover folder is written over by the next try.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from pathcredit.session import materialize
from pathcredit.sources.files import comment_table


def table_comment(spark: SparkSession, name: str) -> str | None:
    return spark.catalog.getTable(name).description


def create_table_as(spark: SparkSession, name: str, query: Callable[[], DataFrame], path: str | None = None, comment: str | None = None) -> bool:
    """``CREATE TABLE IF NOT EXISTS name [LOCATION path] [COMMENT ..] AS query``.
    Returns whether this call wrote the table; if it exists, ``query`` is not even
    called."""
    if spark.catalog.tableExists(name):
        return False
    writer = query().write.format("parquet").mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(name)
    if comment:
        comment_table(spark, name, comment)
    return True


def replace_table_as(spark: SparkSession, name: str, query: DataFrame, comment: str | None = None) -> None:
    """``CREATE OR REPLACE TABLE name AS query``; the query may read the table, so its
    rows are written aside first.  A replaced table keeps its place and comment."""
    rows = materialize(query, "replace")
    writer = rows.write.format("parquet").mode("overwrite")
    if spark.catalog.tableExists(name):
        detail = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
        comment = comment or table_comment(spark, name)
        if detail.get("Type") == "EXTERNAL":
            writer = writer.option("path", detail["Location"])
    writer.saveAsTable(name)
    if comment:
        comment_table(spark, name, comment)


def create_empty_table(spark: SparkSession, name: str, columns: str, path: str | None = None, comment: str = "") -> bool:
    """``CREATE TABLE IF NOT EXISTS name (columns)``: DDL with types and column comments.
    Returns whether the table is new."""
    if spark.catalog.tableExists(name):
        return False
    location = f"LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {location}")
    comment_table(spark, name, comment)
    return True


def register_table(spark: SparkSession, name: str, path: str, comment: str | None = None) -> bool:
    """``CREATE TABLE IF NOT EXISTS name LOCATION path`` over rows that an earlier
    session wrote; False if there are none."""
    if spark.catalog.tableExists(name):
        return True
    try:
        schema = spark.read.parquet(path).schema
    except AnalysisException:  # no such folder, or no committed file in it
        return False
    spark.catalog.createTable(name, path=path, source="parquet", schema=schema)
    if comment:
        comment_table(spark, name, comment)
    return True


def insert_values(spark: SparkSession, name: str, key: str, values: str, args: Mapping[str, object]) -> None:
    """``INSERT INTO name VALUES (values)`` with named parameters; ``args[key]`` is the
    row's value in column ``key``.  A second insert of a key replaces its row, so a rerun
    leaves one."""
    table = spark.table(name)
    if table.filter(table[key] == args[key]).isEmpty():
        spark.sql(f"INSERT INTO {name} VALUES ({values})", args=dict(args))
        return
    others = table.filter(~table[key].eqNullSafe(args[key]))
    row = spark.sql(f"SELECT * FROM VALUES ({values})", args=dict(args)).toDF(*table.columns)
    rows = materialize(others.unionByName(row.to(table.schema)), "insert")
    rows.write.insertInto(name, overwrite=True)
