"""Incremental ingest of touch files with Structured Streaming.

File source (every file exactly once, existing files included, fixed schema)
-> stateless parse -> append parquet sink, run once with ``availableNow``.
The checkpoint sits next to the table, never inside it.  A ``foreachBatch``
variant keeps the journey table current: it re-derives only the journeys of
the users present in the batch and upserts them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathcredit.operators.quality import Expectation, enforce, observed
from pathcredit.schemas import RAW_TOUCHES
from pathcredit.sources.files import split_malformed, typed_touches, with_corrupt

#: Column of a parsed line that holds the text of a malformed one.
CORRUPT = "_malformed"


def raw_touch_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None, header: bool = True, corrupt: str | None = None) -> DataFrame:
    """Touch files as text columns; ``corrupt`` names a column for malformed lines."""
    schema = with_corrupt(RAW_TOUCHES, corrupt) if corrupt else RAW_TOUCHES
    reader = spark.readStream.format("csv").schema(schema).option("header", header)
    if corrupt:
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(source_dir)


def touch_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    return typed_touches(raw_touch_stream(spark, source_dir, max_files_per_trigger))


def _run_once(stream: DataFrame, handle, checkpoint_dir: str) -> None:
    query = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def checked_batch(root: str, dataset: str, expectations: list[Expectation]):
    """``foreachBatch`` handler of :func:`ingest_checked`."""

    def handle(batch: DataFrame, epoch: int) -> None:
        good, bad = split_malformed(batch, CORRUPT)  # the batch's files are read once
        checked, obs = observed(enforce(typed_touches(good), expectations), f"{dataset}-{epoch}", expectations)
        checked.write.mode("overwrite").parquet(f"{root}/bronze/epoch={epoch}")  # a violation ends it before its commit
        metrics = obs.get
        rows = metrics.get("rows") or 0
        counts = [(dataset, e.name, e.action, rows - (metrics.get(e.name) or 0), metrics.get(e.name) or 0) for e in expectations]
        bad.write.mode("overwrite").parquet(f"{root}/quarantine/epoch={epoch}")
        out = batch.sparkSession.createDataFrame(counts, "dataset string, expectation string, action string, passed long, failed long")
        out.coalesce(1).write.mode("overwrite").parquet(f"{root}/counts/epoch={epoch}")

    return handle


def ingest_checked(spark: SparkSession, source_dir: str, root: str, dataset: str, expectations: list[Expectation],
                   max_files_per_trigger: int | None = None, header: bool = True) -> None:
    """One-shot stream of touch files under expectations.  Every micro-batch becomes a
    folder ``epoch=<n>`` of ``bronze``, of ``quarantine`` (the text of malformed lines)
    and of ``counts`` (passed and failed rows by expectation, observed in the bronze
    write).  A ``fail`` expectation stops the stream before the batch is published; a
    batch that runs again replaces its own folders, so each row lands once."""
    stream = raw_touch_stream(spark, source_dir, max_files_per_trigger, header, CORRUPT)
    _run_once(stream, checked_batch(root, dataset, expectations), f"{root}/_checkpoint")


def ingest_once(spark: SparkSession, source_dir: str, table_dir: str, checkpoint_dir: str) -> int:
    """Append every new file under ``source_dir`` to the parquet table at
    ``table_dir`` and stop, without expectations (see :func:`ingest_checked`).  Re-running adds only files not seen before.
    Returns the number of rows appended by this run."""
    query = (
        touch_stream(spark, source_dir)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start(table_dir)
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return sum(int(p.get("numInputRows", 0)) for p in query.recentProgress)


def with_event_id(touches: DataFrame) -> DataFrame:
    """Bronze rows carry no event id; the tiebreak for equal times is the row's
    content, a conversion last (rows equal in all of it are interchangeable)."""
    return touches.withColumn("event_id", F.concat_ws("|", "conversion", "channel", "interaction"))


# Default directories of bronze by a hash of the uid.  A parameter: choose it so
# that a micro-batch touches few of them and a directory is a few hundred MB.
UID_BUCKETS = 64


def uid_bucket(buckets: int = UID_BUCKETS) -> F.Column:
    return F.pmod(F.xxhash64("uid"), F.lit(buckets)).cast("int").alias("uid_bucket")


def refresh_journeys_batch(spark: SparkSession, bronze_dir: str, journey_table, buckets: int = UID_BUCKETS):
    """``foreachBatch`` handler: write the micro-batch to the bronze table under
    its epoch and uid bucket, then recompute the journeys of the users in the
    batch from all their touches and upsert them by ``uid`` into
    ``journey_table`` (a :class:`pathcredit.operators.keyed.KeyedTable`): only these
    journeys are written, as the epoch's batch.

    A replayed epoch replaces its own directories and derives the same journeys,
    so a batch that fails anywhere and runs again leaves what one run leaves.
    The batch is read once (by the write); what follows reads the written rows.
    Only the bronze directories of the batch's buckets are read (at most
    ``buckets`` integers are collected), and only the touched users' journeys
    are rebuilt."""
    from pathcredit.plans.journeys import user_journeys

    def handle(batch: DataFrame, epoch_id: int) -> None:
        keyed = batch.select("*", uid_bucket(buckets), F.lit(epoch_id).cast("long").alias("epoch"))
        keyed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("epoch", "uid_bucket").parquet(bronze_dir)
        bronze = spark.read.schema(keyed.schema).parquet(bronze_dir)
        uids = bronze.filter(F.col("epoch") == F.lit(epoch_id)).select("uid_bucket", "uid").distinct()
        touched_buckets = [r[0] for r in uids.select("uid_bucket").distinct().collect()]
        own = bronze.filter(F.col("uid_bucket").isin(touched_buckets))
        touched = with_event_id(own.join(uids, ["uid_bucket", "uid"], "left_semi").drop("uid_bucket", "epoch"))
        journey_table.append(user_journeys(touched), epoch_id)  # all rows of a journey move together

    return handle


def ingest_and_refresh(spark: SparkSession, source_dir: str, bronze_dir: str, journey_table, checkpoint_dir: str,
                       max_files_per_trigger: int | None = None, buckets: int = UID_BUCKETS) -> None:
    """One-shot stream that keeps bronze and the journey table current."""
    handle = refresh_journeys_batch(spark, bronze_dir, journey_table, buckets)
    _run_once(touch_stream(spark, source_dir, max_files_per_trigger), handle, checkpoint_dir)
