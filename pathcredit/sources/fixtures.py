"""Inputs in the reference's shapes, derived by Spark from the driver tables.

The reference ships no data; these functions turn the TPC-H-like tables into
touches, sales, customers, products, clickstream and ad-spend inputs
(FIXTURES.md part B).  All of them scale with their source tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathcredit.functions.columns import CHANNELS, pick
from pathcredit.operators import catalog
from pathcredit.operators.sequence import running_sum
from pathcredit.session import work_dir
from pathcredit.sources.tables import Tables

# ---------------------------------------------------------------- touches (B1)


def touch_events(events: DataFrame) -> DataFrame:
    """Per-event touch attributes (no journey id yet): a narrow projection,
    so filters and column pruning still reach the parquet scan.  The channel
    travels as the integer ``k``; text columns are added by ``touch_text``."""
    return events.select(
        "event_id",
        "user_id",
        F.col("ts").alias("time"),
        F.to_date("ts").alias("day"),
        (F.col("event_type") == F.lit("purchase")).cast("int").alias("conversion"),
        F.get_json_object(F.col("props"), "$.k").cast("int").alias("k"),
    )


def touch_text(df: DataFrame) -> DataFrame:
    """Channel name and interaction label from ``k`` and ``conversion``."""
    return df.withColumns(
        {
            "interaction": F.when(F.col("conversion") == 1, F.lit("conversion")).otherwise(F.lit("impression")),
            "channel": pick(CHANNELS, F.pmod(F.col("k"), F.lit(len(CHANNELS)))),
        }
    )


def touches(events: DataFrame) -> DataFrame:
    """Bronze-shaped touches plus ``event_id`` as the ordering tiebreak.

    ``uid`` is a journey id ``user_id-yyyyMMdd-seq`` where ``seq`` counts the
    user's earlier purchases that day, so every purchase closes a journey.
    The running count is the skew-safe scan (a hot user does not become one
    task); the rows it shuffles are narrow (ids, time, date, flag, ``k``) and the
    text columns are derived after it.
    """
    seq = running_sum(
        touch_events(events), ["user_id", "day"], ["time", "event_id"], "conversion", "seq", inclusive=False
    )
    uid = F.concat_ws(
        "-", F.col("user_id").cast("string"), F.date_format("day", "yyyyMMdd"), F.col("seq").cast("string")
    )
    return touch_text(seq).select(uid.alias("uid"), "time", "interaction", "channel", "conversion", "event_id")


def load_touches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return touches(Tables(spark, sf_dir).events)


def raw_touch_text(touches_df: DataFrame) -> DataFrame:
    """The header-only CSV form (all strings, whole seconds) of touches (B2)."""
    return touches_df.select(
        "uid",
        F.date_format("time", "yyyy-MM-dd HH:mm:ss").alias("time"),
        "interaction",
        "channel",
        F.col("conversion").cast("string").alias("conversion"),
    )


def damaged_touch_lines(touches_df: DataFrame) -> DataFrame:
    """Touch files' lines, some of them malformed: every 97th event's is cut after the
    time, every 101st's has a field too many."""
    fields = [F.col("uid"), F.date_format("time", "yyyy-MM-dd HH:mm:ss"), F.col("interaction"), F.col("channel"), F.col("conversion").cast("string")]
    short = F.concat_ws(",", *fields[:2])
    long = F.concat_ws(",", *fields, F.lit("extra"))
    line = F.when(F.col("event_id") % 97 == 0, short).when(F.col("event_id") % 101 == 0, long).otherwise(F.concat_ws(",", *fields))
    return touches_df.select(line.alias("value"))


def damaged_click_lines(clicks: DataFrame) -> DataFrame:
    """Clicks as JSON lines; where the count is a multiple of 7 the line's last two
    characters are missing."""
    line = F.to_json(F.struct("curr_title", "prev_title", "n"))
    return clicks.select(F.when(F.col("n").cast("long") % 7 == 0, F.substring(line, 1, F.length(line) - 2)).otherwise(line).alias("value"))


# ------------------------------------------------------------------ sales (B4)


# Line items of one order row.  Fixed: a line's segment depends on its position
# in its own order alone.
SEGMENT_LINES = 1000


def sales(orders: DataFrame, lineitem: DataFrame, hot_rows: int | None = None, segment_lines: int = SEGMENT_LINES) -> DataFrame:
    """One row per order with ``ordered_products`` as positional string arrays
    ``[line, product_id, price, discount, quantity]``; orders without lines get
    an empty array.

    Line items are grouped per order key *before* the join with orders (the
    join input shrinks to a few rows per order).  Every order's lines are cut, in
    order, into rows of ``segment_lines`` lines (same order number); exploding
    the rows gives exactly the same line items.

    Dirty values on purpose (FIXTURES.md B4): quantity '0' for every 50th order
    key and items cut to 3 elements for every 101st, so the expectation and the
    NULL-safe positional access have work to do.  No row is dropped.
    """
    # Lines travel as compact numeric structs; the positional string items are
    # rendered after the grouping (same work, a lighter shuffle and sort).
    lines = lineitem.select(
        "l_orderkey",
        F.struct(
            F.col("l_linenumber").alias("n"),
            F.col("l_partkey").alias("p"),
            F.col("l_extendedprice").alias("x"),
            F.col("l_discount").alias("d"),
            F.col("l_quantity").alias("q"),
        ).alias("line"),
    )
    placed = running_sum(lines, ["l_orderkey"], ["line"], F.lit(1).cast("long"), "_pos", True, hot_rows=hot_rows)
    rows = placed.withColumn("_segment", F.floor((F.col("_pos") - 1) / F.lit(segment_lines))).drop("_pos")
    per_order = rows.groupBy("l_orderkey", "_segment").agg(F.array_sort(F.collect_list("line")).alias("lines"))
    joined = orders.select("o_orderkey", "o_custkey", "o_orderdate").join(
        per_order, F.col("o_orderkey") == F.col("l_orderkey"), "left"
    )
    key = F.col("o_orderkey")

    def item(line: F.Column) -> F.Column:
        qty = F.when(key % 50 == 0, F.lit("0")).otherwise(line["q"].cast("int").cast("string"))
        full = F.array(
            line["n"].cast("string"), line["p"].cast("string"), line["x"].cast("string"), line["d"].cast("string"), qty
        )
        return F.when(key % 101 == 0, F.slice(full, 1, 3)).otherwise(full)

    return joined.select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderkey").alias("order_number"),
        F.col("o_orderdate").alias("order_datetime"),
        F.coalesce(F.transform("lines", item), F.array().cast("array<array<string>>")).alias("ordered_products"),
    )


def customers(customer: DataFrame) -> DataFrame:
    return customer.withColumnRenamed("c_custkey", "customer_id")


def products(part: DataFrame) -> DataFrame:
    return part.withColumnRenamed("p_partkey", "product_id")


# ------------------------------------------------------------- clickstream (B5)

# Fixed value: the brand whose page title is blanked to exercise the
# record-only "title is not NULL" expectation.
BLANK_BRAND = "Brand#9"


def clickstream_raw(lineitem: DataFrame, part: DataFrame, supplier: DataFrame) -> DataFrame:
    """Referrer -> page click counts: page = part brand, referrer = supplier.

    ``n`` is text, as in a JSON dump.  Line items are counted per
    ``(part, supplier)`` before the dimension joins (aggregate pushed below the
    joins by hand: the join input shrinks to one row per pair), then the pair
    counts are summed per (brand, supplier name).
    """
    pairs = lineitem.groupBy("l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("c"))
    joined = pairs.join(part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey")).join(
        supplier.select("s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey")
    )
    counted = joined.groupBy("p_brand", "s_name").agg(F.sum("c").alias("cnt"))
    return counted.select(
        F.when(F.col("p_brand") == F.lit(BLANK_BRAND), F.lit(None).cast("string"))
        .otherwise(F.col("p_brand"))
        .alias("curr_title"),
        F.col("s_name").alias("prev_title"),
        F.col("cnt").cast("string").alias("n"),
    )


# ---------------------------------------------------------------- ad spend (B3)

# The campaign row the reference inserts (id, budget default;
# equal 0.2 share per channel and start 2020-05-17 00:00:00 are set in
# insert_campaign).
CAMPAIGN_ID = "3d65f7e92e81480cac52a20dfdf64d5b"
DEFAULT_ADSPEND = 10000


# The campaign table's columns.
AD_SPEND_COLUMNS = """
  campaign_id STRING COMMENT 'campaign',
  total_spend_in_dollars FLOAT COMMENT 'budget',
  channel_spend MAP<STRING, FLOAT> COMMENT 'share of the budget by channel',
  campaign_start_date TIMESTAMP COMMENT 'first day'"""


def spend_table(spark: SparkSession, name: str = "gold_ad_spend", path: str | None = None) -> str:
    """The empty campaign table, created once."""
    catalog.create_empty_table(spark, name, AD_SPEND_COLUMNS, path or work_dir(spark, name), "budget of every campaign and its share by channel")
    return name


def insert_campaign(spark: SparkSession, name: str, adspend: int | str = DEFAULT_ADSPEND, shares: dict[str, float] | None = None, campaign: str = CAMPAIGN_ID) -> None:
    """The campaign's row by a parametrised insert; a rerun keeps one row."""
    shares = shares or {c: 0.2 for c in CHANNELS}
    split = {f"{kind}{i}": value for i, pair in enumerate(shares.items()) for kind, value in zip(("channel", "share"), pair)}
    entries = ", ".join(f":channel{i}, CAST(:share{i} AS FLOAT)" for i in range(len(shares)))
    values = f":campaign_id, CAST(INT(:adspend) AS FLOAT), map({entries}), make_timestamp(2020, 5, 17, 0, 0, 0)"
    catalog.insert_values(spark, name, "campaign_id", values, {"campaign_id": campaign, "adspend": str(adspend), **split})


def ad_spend(spark: SparkSession, adspend: int | str = DEFAULT_ADSPEND, shares: dict[str, float] | None = None) -> DataFrame:
    """The campaign table ``(campaign_id, total_spend_in_dollars FLOAT, channel_spend
    MAP<STRING,FLOAT>, campaign_start_date TIMESTAMP)`` with its one row; created and
    filled once a session."""
    name = spend_table(spark)
    held = spark.table(name)
    if shares or held.filter((F.col("campaign_id") == CAMPAIGN_ID) & (F.col("total_spend_in_dollars") == float(adspend))).isEmpty():
        insert_campaign(spark, name, adspend, shares)
    return spark.table(name)
