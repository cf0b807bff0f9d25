"""Clickstream tables: cleaned clicks with two expectations, and the top
referrers of one page."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathcredit.operators.quality import Expectation, enforce, expectation_counts

# The two expectations the reference declares.
VALID_TITLE = Expectation("valid_current_page_title", "current_page_title IS NOT NULL", "warn")
VALID_COUNT = Expectation("valid_count", "click_count > 0", "fail")
EXPECTATIONS = [VALID_TITLE, VALID_COUNT]


def prepared(raw: DataFrame, check: bool = False) -> DataFrame:
    """Renamed, typed clicks.  ``n`` is text: ``try_cast`` turns junk into NULL
    (which the fail expectation then rejects) instead of an ANSI cast error.
    With ``check`` the fail expectation is enforced in-plan."""
    out = raw.select(
        F.col("curr_title").alias("current_page_title"),
        F.col("n").try_cast("int").alias("click_count"),
        F.col("prev_title").alias("previous_page_title"),
    )
    return enforce(out, EXPECTATIONS) if check else out


def prepared_expectations(clicks: DataFrame) -> DataFrame:
    return expectation_counts(clicks, "clickstream_prepared", EXPECTATIONS)


def top_referrers(clicks: DataFrame, page: str, k: int = 10) -> DataFrame:
    """The ``k`` referrers with most clicks into ``page``: filter pushed to the
    source, then a per-partition top-k merged in one task
    (``TakeOrderedAndProject``).  Ties are broken by referrer so the cut is
    deterministic."""
    return (
        clicks.filter(F.col("current_page_title") == F.lit(page))
        .select(F.col("previous_page_title").alias("referrer"), "click_count")
        .orderBy(F.col("click_count").desc(), F.col("referrer").asc())
        .limit(k)
    )
