"""Retail sales tables: raw products/customers/sales, exploded line items with
a record-only quantity expectation, and the two left-outer enrichments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathcredit.operators.quality import Expectation, expectation_counts

# Fixed value: the expectation the reference declares on the line items.
ORDER_QUANTITY = Expectation("order quantity", "try_cast(quantity AS BIGINT) > 0", "warn")


def line_items(sales: DataFrame) -> DataFrame:
    """One row per ordered product: ``product_id`` = item[1], ``quantity`` =
    item[4] (0-based; NULL when the item is short instead of an ANSI error).
    The expectation is record-only, so no row is filtered."""
    exploded = sales.select("customer_id", "order_number", "order_datetime", F.explode("ordered_products").alias("line_item"))
    return exploded.select(
        "customer_id",
        "order_number",
        "order_datetime",
        F.get("line_item", 1).alias("product_id"),
        F.get("line_item", 4).alias("quantity"),
    )


def line_item_expectations(items: DataFrame) -> DataFrame:
    return expectation_counts(items, "sales_line_items", [ORDER_QUANTITY])


def join_customers(items: DataFrame, customers: DataFrame) -> DataFrame:
    """Left outer join USING ``customer_id`` (key once, first).  The customer
    side is a dimension: AQE broadcasts it when its runtime size is under the
    broadcast threshold and keeps a sort-merge join otherwise."""
    return items.join(customers, ["customer_id"], "left")


def join_products(items_with_customers: DataFrame, products: DataFrame) -> DataFrame:
    """Left outer join USING ``product_id``; the item id is text, cast to the
    dimension key type first (a malformed id becomes NULL, not an error)."""
    key_type = dict(products.dtypes)["product_id"]
    left = items_with_customers.withColumn("product_id", F.col("product_id").try_cast(key_type))
    return left.join(products, ["product_id"], "left")
