"""Distributed union-find: connected components of a link table.

Alternating large-star and small-star rounds hang every node on the smallest
node it can reach; each round is two aggregations and joins over the links, and
its result is written to the shared folder, so lineage stays short.  Minima are
pre-aggregated before the shuffle and the join back leaves a hot node's links
to Spark's skew handling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathcredit.llm.common import table


def _directed(links: DataFrame) -> DataFrame:
    return links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()


def _large_star(links: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the node's smallest one."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    hung = links.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node that has a link; ``links`` has long
    columns ``u`` and ``v``; the component is its smallest node."""
    state, before = table(_directed(links), "links"), None
    while True:
        mark = state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            return state.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                state.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        before = mark
        state = table(_small_star(_large_star(state)), "links", mark[0])  # a round adds no link
