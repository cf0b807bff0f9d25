"""Campaign performance and budget tables: spend per channel, base conversion
rate, conversions by date, cost per acquisition, ROAS and proposed budgets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pathcredit.functions.columns import ratio
from pathcredit.plans.attribution import MARKOV, attribution_by_model, journeys_in


def spend_by_channel(ad_spend: DataFrame) -> DataFrame:
    """``explode(channel_spend) AS (channel, pct_spend)`` and the dollar amount."""
    exploded = ad_spend.select(F.explode("channel_spend").alias("channel", "pct_spend"), "total_spend_in_dollars")
    return exploded.select(
        "channel", "pct_spend", F.round(F.col("total_spend_in_dollars") * F.col("pct_spend"), 2).alias("dollar_spend")
    )


def base_conversion_rate(summary: DataFrame) -> DataFrame:
    """Journeys by outcome: ``Impression`` when conversion = 0, else
    ``Conversion`` (NULL too, as in the reference's CASE), with the share."""
    counts = summary.groupBy("conversion").agg(journeys_in(summary).alias("count"))
    return counts.select(
        "count",
        F.when(F.col("conversion") == 0, F.lit("Impression")).otherwise(F.lit("Conversion")).alias("interaction_type"),
        # one row per outcome value: the global window is over <= 3 rows
        ratio(F.col("count"), F.sum("count").over(Window.partitionBy())).alias("share"),
    )


def conversions_by_date(touches: DataFrame) -> DataFrame:
    """Converting touches per calendar day (the filter reaches the scan)."""
    return (
        touches.filter(F.col("conversion") == 1)
        .groupBy(F.to_date("time").alias("date"))
        .agg(F.count(F.lit(1)).alias("count"))
        .select("count", F.lit("Conversion").alias("interaction_type"), "date")
        .orderBy("date")  # one row per day: the sort runs on a tiny result
    )


def cpa_summary(ad_spend: DataFrame, attribution: DataFrame, summary: DataFrame) -> DataFrame:
    """Cost per acquisition per channel and model (inner join: channels with
    spend but no credit, or credit but no spend, drop out as in the reference)."""
    spending = spend_by_channel(ad_spend).select("channel", "dollar_spend")
    counts = attribution_by_model(attribution, summary)
    return spending.join(counts, "channel").select(
        "channel",
        "dollar_spend",
        "attribution_model",
        "conversions_attributed",
        F.round(F.try_divide(F.col("dollar_spend"), F.col("conversions_attributed")), 2).alias("CPA_in_Dollars"),
    )


def spend_optimization(ad_spend: DataFrame, attribution: DataFrame, model: str = MARKOV) -> DataFrame:
    """ROAS = credit share / budget share; proposed budget = ROAS x current."""
    spending = spend_by_channel(ad_spend)
    credit = attribution.filter(F.col("attribution_model") == F.lit(model)).select("channel", "attribution_percent")
    roas = F.try_divide(F.col("attribution_percent"), F.col("pct_spend"))
    return spending.join(credit, "channel").select(
        "channel",
        "pct_spend",
        "attribution_percent",
        roas.alias("ROAS"),
        "dollar_spend",
        F.round(roas * F.col("dollar_spend"), 2).alias("proposed_dollar_spend"),
    )


def spend_comparison(ad_spend: DataFrame, optimization: DataFrame) -> DataFrame:
    """Current and proposed budget in long form (UNION: duplicates collapse)."""
    current = spend_by_channel(ad_spend).select(
        "channel", F.lit("current_spending").alias("spending"), F.col("dollar_spend").cast("double").alias("budget")
    )
    proposed = optimization.select(
        "channel", F.lit("proposed_spending").alias("spending"), F.col("proposed_dollar_spend").alias("budget")
    )
    return current.unionByName(proposed).distinct()
