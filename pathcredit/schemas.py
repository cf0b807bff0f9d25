"""Explicit schemas of the reference's data shapes (no inference in the hot path)."""

from pyspark.sql import types as T

# Raw touch file: header-only CSV, every column is text.
RAW_TOUCHES = T.StructType(
    [
        T.StructField("uid", T.StringType()),
        T.StructField("time", T.StringType()),
        T.StructField("interaction", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("conversion", T.StringType()),
    ]
)

BRONZE_TOUCHES = T.StructType(
    [
        T.StructField("uid", T.StringType()),
        T.StructField("time", T.TimestampNTZType()),
        T.StructField("interaction", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("conversion", T.IntegerType()),
    ]
)

USER_JOURNEY = T.StructType(
    [
        T.StructField("uid", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("first_interaction", T.StringType()),
        T.StructField("last_interaction", T.StringType()),
        T.StructField("conversion", T.IntegerType()),
        T.StructField("visiting_order", T.ArrayType(T.IntegerType())),
        T.StructField("segment", T.IntegerType()),
    ]
)

ATTRIBUTION = T.StructType(
    [
        T.StructField("attribution_model", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("attribution_percent", T.DoubleType()),
    ]
)

TRANSITION_MATRIX = T.StructType(
    [
        T.StructField("start_state", T.StringType()),
        T.StructField("end_state", T.StringType()),
        T.StructField("transition_probability", T.DoubleType()),
    ]
)

AD_SPEND = T.StructType(
    [
        T.StructField("campaign_id", T.StringType()),
        T.StructField("total_spend_in_dollars", T.FloatType()),
        T.StructField("channel_spend", T.MapType(T.StringType(), T.FloatType())),
        T.StructField("campaign_start_date", T.TimestampType()),
    ]
)

# Sales stream rows: line items are positional string arrays.
SALES = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("order_number", T.LongType()),
        T.StructField("order_datetime", T.TimestampNTZType()),
        T.StructField("ordered_products", T.ArrayType(T.ArrayType(T.StringType()))),
    ]
)

CLICKSTREAM_RAW = T.StructType(
    [
        T.StructField("curr_title", T.StringType()),
        T.StructField("prev_title", T.StringType()),
        T.StructField("n", T.StringType()),
    ]
)
