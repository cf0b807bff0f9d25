"""File sources and table registration (CSV, JSON, SQL over files, catalog).

Readers take an explicit schema by default; inference is opt-in because it
costs an extra pass over the input and is unstable across files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from pathcredit.operators.quality import Expectation
from pathcredit.schemas import RAW_TOUCHES
from pathcredit.session import materialize


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    sep: str = ",",
    header: bool = True,
    infer: bool = False,
    corrupt: str | None = None,
) -> DataFrame:
    """CSV with header and delimiter; typed by ``schema`` or, opt-in, inferred.
    Without either every column is a string (header-only).  ``corrupt`` names a column
    that gets the text of malformed lines (see :func:`split_malformed`)."""
    reader = spark.read.option("header", header).option("sep", sep)
    if corrupt:
        schema, reader = with_corrupt(schema, corrupt), reader.option("columnNameOfCorruptRecord", corrupt)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def with_corrupt(schema: StructType, corrupt: str) -> StructType:
    return StructType([*schema.fields, StructField(corrupt, StringType())])


def split_malformed(df: DataFrame, corrupt: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantine): lines that fit the schema, and the text of the others as
    ``record``.  The files are parsed once, into a written table that both read."""
    held = materialize(df, "parsed")
    bad = held.filter(F.col(corrupt).isNotNull()).select(F.col(corrupt).alias("record"))
    return held.filter(F.col(corrupt).isNull()).drop(corrupt), bad


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None, corrupt: str | None = None) -> DataFrame:
    reader = spark.read
    if corrupt:
        schema, reader = with_corrupt(schema, corrupt), reader.option("columnNameOfCorruptRecord", corrupt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def sql_on_files(spark: SparkSession, fmt: str, path: str) -> DataFrame:
    """``SELECT * FROM <fmt>.`path` `` (query a file directly in SQL)."""
    if fmt not in {"json", "csv", "parquet", "orc", "text"}:
        raise ValueError(f"unsupported format {fmt}")
    return spark.sql(f"SELECT * FROM {fmt}.`{path}`")


# Fixed value: the touch files' time layout, yyyy-MM-dd HH:mm:ss.
_TIME_TEXT = r"^(\d{4})-(\d{2})-(\d{2}) (\d{2}):(\d{2}):(\d{2})$"


def parse_wall_clock(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text to TIMESTAMP_NTZ: independent of the session
    time zone (no DST gap shifts) and NULL, not an ANSI error, when malformed."""
    part = [F.regexp_extract(text, _TIME_TEXT, i).try_cast("int") for i in range(1, 7)]
    return F.when(text.rlike(_TIME_TEXT), F.try_make_timestamp_ntz(*part))


def typed_touches(raw: DataFrame) -> DataFrame:
    """Bronze touches from the all-text form: ``time`` parsed with the fixed
    pattern, ``conversion`` cast to int.  Malformed text becomes NULL (caught by
    expectations) instead of an ANSI error."""
    return raw.select(
        "uid",
        parse_wall_clock(F.col("time")).alias("time"),
        "interaction",
        "channel",
        F.col("conversion").try_cast("int").alias("conversion"),
    )


# What a bronze touch must satisfy before journeys are built.
# A NULL channel would vanish from a rendered path, a NULL time or uid has no
# place in any journey; the conversion flag is 0 or 1.
TOUCH_EXPECTATIONS = [
    Expectation("valid_uid", "uid IS NOT NULL", "fail"),
    Expectation("valid_time", "time IS NOT NULL", "fail"),
    Expectation("valid_channel", "channel IS NOT NULL", "fail"),
    Expectation("valid_conversion", "conversion IN (0, 1)", "fail"),
]


def read_raw_touches(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schema=RAW_TOUCHES)


def write_raw_touches(raw: DataFrame, path: str, files: int | None = None) -> None:
    """Write the all-text touch form as header CSV files (the generator's and
    the stream's file format)."""
    out = raw if files is None else raw.repartition(files)
    out.write.mode("errorifexists").option("header", True).csv(path)


def ensure_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def register_external(spark: SparkSession, table: str, path: str, fmt: str = "parquet") -> DataFrame:
    """``CREATE TABLE t USING <fmt> LOCATION path`` (metadata only)."""
    return spark.catalog.createTable(table, path=path, source=fmt)


def comment_table(spark: SparkSession, table: str, comment: str) -> None:
    spark.sql(f"COMMENT ON TABLE {table} IS :c", args={"c": comment})
