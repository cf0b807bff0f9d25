"""Sales and clickstream tables with expectations (record-only and
fail-before-publish), on the sf fixtures."""

import os

import pytest
from pyspark.sql import functions as F

from pathcredit.operators.quality import Expectation, expectation_counts, publish
from pathcredit.plans import clickstream as C
from pathcredit.plans import sales as S
from pathcredit.sources import fixtures as X
from pathcredit.sources.tables import Tables
from tests.conftest import SF001, SF01


def test_sales_expectation_keeps_rows(spark):
    t = Tables(spark, SF01)
    items = S.line_items(X.sales(t.orders, t.lineitem))
    assert items.count() == 60000  # record-only: nothing dropped
    counts = S.line_item_expectations(items).first()
    assert counts.failed == 1755 and counts.passed == 60000 - 1755
    assert items.filter(F.col("quantity").isNull()).count() == 588  # short items: NULL, not an error


def test_left_joins_keep_unmatched(spark):
    t = Tables(spark, SF001)
    items = S.line_items(X.sales(t.orders, t.lineitem))
    few_customers = X.customers(t.customer).filter(F.col("customer_id") % 7 != 0)
    joined = S.join_customers(items, few_customers)
    assert joined.count() == items.count()
    assert joined.filter(F.col("c_name").isNull()).count() == 943
    few_products = X.products(t.part).filter(F.col("product_id") % 11 != 0)
    both = S.join_products(joined, few_products)
    assert both.count() == items.count()
    assert both.filter(F.col("p_name").isNull()).count() == 559
    assert both.columns[0] == "product_id" and dict(both.dtypes)["product_id"] == "bigint"


def test_top_referrers_tie_break_sf01(spark):
    t = Tables(spark, SF01)
    top = C.top_referrers(C.prepared(X.clickstream_raw(t.lineitem, t.part, t.supplier)), "Brand#2", 10).collect()
    assert len(top) == 10
    assert [r.click_count for r in top[:3]] == [43, 42, 41]
    assert top[-1].click_count == 37 and top[-1].referrer.endswith("82")


def test_clickstream_counts(spark):
    t = Tables(spark, SF01)
    counts = {r.expectation: r for r in C.prepared_expectations(C.prepared(X.clickstream_raw(t.lineitem, t.part, t.supplier))).collect()}
    assert counts["valid_current_page_title"].failed == 100
    assert counts["valid_count"].failed == 0


def test_null_predicate_is_a_violation(spark):
    df = spark.createDataFrame([(1,), (None,), (0,)], "x int")
    row = expectation_counts(df, "d", [Expectation("pos", "x > 0")]).first()
    assert (row.passed, row.failed) == (1, 2)


def test_fail_expectation_blocks_publish(spark, scratch):
    t = Tables(spark, SF001)
    raw = X.clickstream_raw(t.lineitem, t.part, t.supplier)
    bad = raw.unionByName(spark.createDataFrame([("Brand#2", "Supplier#X", "0")], "curr_title string, prev_title string, n string"))
    with pytest.raises(Exception, match="valid_count"):
        publish(C.prepared(bad), f"{scratch}/bad", C.EXPECTATIONS)
    assert not os.path.exists(f"{scratch.removeprefix('file:')}/bad/_SUCCESS")
    metrics = publish(C.prepared(raw), f"{scratch}/good", C.EXPECTATIONS)
    assert metrics["rows"] == raw.count() and metrics["valid_current_page_title"] == 10
    assert spark.read.parquet(f"{scratch}/good").count() == raw.count()


def test_ansi_safe_parsing(spark):
    raw = spark.createDataFrame([("p", "r", "12"), ("p", "r", "x1"), ("p", "r", "20.0")], "curr_title string, prev_title string, n string")
    out = C.prepared(raw).collect()
    assert [r.click_count for r in out] == [12, None, None]


def test_hot_order_is_segmented(spark):
    orders = spark.createDataFrame([(1, 7, None), (2, 8, None)], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz")
    lines = spark.createDataFrame(
        [(1, i % 5 + 1, 100 + i, 1.0, 0.0, float(i % 9 + 1)) for i in range(230)] + [(2, 1, 5, 1.0, 0.0, 3.0)],
        "l_orderkey long, l_linenumber int, l_partkey long, l_extendedprice double, l_discount double, l_quantity double",
    )
    sales = X.sales(orders, lines, hot_rows=50, segment_lines=50)
    hot_rows = sales.filter("order_number = 1").collect()
    assert len(hot_rows) >= 4 and all(len(r.ordered_products) <= 50 for r in hot_rows)
    items = S.line_items(sales)
    plain = S.line_items(X.sales(orders, lines, hot_rows=10**9))
    assert items.count() == plain.count() == 231
    assert items.exceptAll(plain).count() == 0 and plain.exceptAll(items).count() == 0


def test_bronze_rejects_null_channel(spark):
    from pathcredit.operators.quality import enforce
    from pathcredit.sources.files import TOUCH_EXPECTATIONS

    rows = [("u", None, "impression", "Email", 0), ("u", None, "impression", None, 0)]
    df = spark.createDataFrame(rows, "uid string, time timestamp_ntz, interaction string, channel string, conversion int")
    with pytest.raises(Exception, match="valid_time|valid_channel"):
        enforce(df, TOUCH_EXPECTATIONS).collect()


def test_fail_expectation_cannot_be_filtered_away(spark, scratch, monkeypatch):
    """A bad row on another page fails the dataset, so the query over it fails."""
    import pathcredit.named as N

    bad = spark.createDataFrame([("Brand#2", "a", "4"), ("Brand#7", "b", "-3")], "curr_title string, prev_title string, n string")
    monkeypatch.setattr(N, "_clicks_raw", lambda spark, sf: bad)
    with pytest.raises(Exception, match="valid_count"):
        N.top_referrers(spark, "unused")
