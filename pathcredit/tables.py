"""Build every attribution table once, in dependency order, the way the
reference's notebooks do: each is a table of Spark's catalog with a comment, and
the next step reads the written table (not the derivation), so nothing is computed
twice.  A step whose table exists is skipped, in this session or a later one.

bronze -> gold_user_journey (clustered on uid) -> gold_attribution (first and
last touch) -> transition_matrix -> Markov credit upserted into
gold_attribution -> ad spend and campaign tables.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathcredit.operators import catalog, layout
from pathcredit.operators.keyed import KeyedTable
from pathcredit.operators.quality import enforce, observed
from pathcredit.plans import attribution as A
from pathcredit.plans import journeys as J
from pathcredit.plans import markov as M
from pathcredit.plans import spend as P
from pathcredit.schemas import ATTRIBUTION
from pathcredit.sources import fixtures as X
from pathcredit.sources.files import TOUCH_EXPECTATIONS

KEYS = ["attribution_model", "channel"]


@dataclass
class Built:
    """A table of the build: where it lies, how to read it, whether this call wrote it,
    and what its write observed (from the step's record if an earlier call wrote it)."""

    name: str
    path: str
    read: Callable[[], DataFrame]
    written: bool
    metrics: dict = field(default_factory=dict)


class _Steps:
    """The record of finished steps: a row each under ``<root>/build_steps``, written
    after the step's table, with what its write observed."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, f"{root}/build_steps"

    def finished(self, step: str) -> dict | None:
        try:
            row = self.spark.read.schema("observed map<string,long>").parquet(f"{self.root}/step={step}").first()
        except AnalysisException:  # no such step
            return None
        return None if row is None else dict(row.observed)

    def finish(self, step: str, seen: dict) -> dict:
        row = self.spark.createDataFrame([({k: int(v or 0) for k, v in seen.items()},)], "observed map<string,long>")
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/step={step}")
        return seen


def build_attribution_tables(
    spark: SparkSession, sf_dir: str, root: str, method: str = "simple_path", adspend: int = X.DEFAULT_ADSPEND, database: str | None = None
) -> dict[str, Built]:
    """Write all tables under ``root`` (shared storage), in a database of their own, and
    return them by name.  The bronze write enforces the touch expectations and counts
    them in the same pass (``tables["bronze"].metrics``)."""
    root = root.rstrip("/")
    database = database or f"attribution_{zlib.crc32(root.encode()):08x}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}/database'")
    steps, tables = _Steps(spark, root), {}

    def write(name: str, comment: str, query: Callable[[], DataFrame], observation=None) -> DataFrame:
        full, path = f"{database}.{name}", f"{root}/{name}"
        seen = steps.finished(name)
        written = False
        if seen is None or not catalog.register_table(spark, full, path, comment):
            written = catalog.create_table_as(spark, full, query, path, comment)
            # an observation answers only for a frame that this call has written
            seen = steps.finish(name, observation.get if written and observation is not None else {})
        tables[name] = Built(full, path, lambda: spark.table(full), written, seen)
        return spark.table(full)

    checked, obs = observed(enforce(X.load_touches(spark, sf_dir), TOUCH_EXPECTATIONS), "bronze", TOUCH_EXPECTATIONS)
    bronze = write("bronze", "checked touches", lambda: checked, obs)
    journeys = write("gold_user_journey", "a journey of every uid, cut after each thousand touches", lambda: layout.clustered(J.user_journeys(bronze), ["uid", "segment"]))
    # Journey-level columns repeat on every segment row: segment 0 is one row per uid.
    outcomes = write("journey_outcomes", "journeys by first channel, last channel and outcome", lambda: A.outcomes(journeys.filter(F.col("segment") == 0)))
    matrix = write("transition_matrix", "probabilities of state changes", lambda: M.transition_matrix(M.transitions(bronze)))

    gold = KeyedTable(spark, f"{root}/gold_attribution", KEYS, ATTRIBUTION)
    credits = [lambda: A.gold_attribution(outcomes), lambda: M.markov_attribution(M.removal_effects(M.conversion_probability(matrix, method).checkpoint()))]
    written = False
    for version, credit in enumerate(credits):  # first and last touch, then Markov credit upserted
        if steps.finished(f"gold_attribution_{version}") is None:
            gold.append(credit(), version)
            steps.finish(f"gold_attribution_{version}", {})
            written = True
    tables["gold_attribution"] = Built("gold_attribution", gold.path, gold.read, written)
    attribution = gold.read()
    attribution.createOrReplaceTempView("gold_attribution")

    spending = X.spend_table(spark, f"{database}.gold_ad_spend", f"{root}/gold_ad_spend")
    done = steps.finished("gold_ad_spend")
    if done is None or done.get("adspend") != int(adspend):
        X.insert_campaign(spark, spending, adspend)
        steps.finish("gold_ad_spend", {"adspend": int(adspend)})
    ad = spark.table(spending)
    tables["gold_ad_spend"] = Built(spending, f"{root}/gold_ad_spend", lambda: spark.table(spending), done is None)
    write("exploded_gold_ad_spend", "spend by channel", lambda: P.spend_by_channel(ad))
    write("base_conversion_rate", "journeys by outcome", lambda: P.base_conversion_rate(outcomes))
    write("conversions_by_date", "conversions a day", lambda: P.conversions_by_date(bronze))
    write("attribution_by_model_type", "conversions that each model credits to a channel", lambda: A.attribution_by_model(attribution, outcomes))
    write("cpa_summary", "cost per acquisition", lambda: P.cpa_summary(ad, attribution, outcomes))
    optimization = write("spend_optimization_view", "return on spend and proposed budget", lambda: P.spend_optimization(ad, attribution))
    write("spend_optimization_final", "current and proposed budget", lambda: P.spend_comparison(ad, optimization))
    return tables
