"""Named queries: each takes ``(spark, sf_dir)`` and returns a DataFrame built
from the base tables (or data Spark derives from them).  Aliases match the
DuckDB oracle in :mod:`pathcredit.oracle` column for column."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathcredit.operators import layout, upsert
from pathcredit.operators.keyed import KeyedTable
from pathcredit.operators.quality import enforce, expectation_counts
from pathcredit.plans import attribution as A
from pathcredit.plans import clickstream as C
from pathcredit.plans import journeys as J
from pathcredit.plans import markov as M
from pathcredit.plans import refresh as R
from pathcredit.plans import sales as S
from pathcredit.plans import spend as P
from pathcredit.schemas import CLICKSTREAM_RAW, SALES, USER_JOURNEY
from pathcredit.session import materialize, work_dir
from pathcredit.sources import fixtures as X
from pathcredit.sources.files import (
    TOUCH_EXPECTATIONS,
    read_csv,
    read_json,
    split_malformed,
    sql_on_files,
    typed_touches,
    write_raw_touches,
)
from pathcredit.sources.tables import Tables
from pathcredit.streaming.ingest import ingest_and_refresh, ingest_checked

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the named queries (fixed values of the test scenarios).
TOP_PAGE = "Brand#2"
TOP_K = 10
# Refresh scenario: the table was first built from touches before noon of
# this day; the refresh recomputes from midnight on (the day is re-delivered).
FIRST_LOAD_BEFORE = "2024-01-16 12:00:00"
REFRESH_FROM = "2024-01-16 00:00:00"
DECAY_HALF_LIFE_HOURS = 24.0
PROBABILITY_DIGITS = 9
STREAM_BUCKETS = 8
JOURNEY_ENDS = ("uid", "first_interaction", "last_interaction", "conversion")


class _Inputs:
    """Derived inputs of one query, each built once and shared by every branch
    of that query's plan (a shared DataFrame also shares its pinned chunk
    data, so the skew-safe scans run once per query)."""

    def __init__(self, spark: SparkSession, sf: str, single_pass: bool = False):
        # single_pass: the query reads touches once, through one aggregation
        # (the journey summary), so writing bronze first would cost a write
        # without saving anything.  A skew-safe scan reads its input twice (key
        # count, then the window), so scans always read the written bronze.
        self.spark, self.sf, self.single_pass = spark, sf, single_pass

    @cached_property
    def touches(self) -> DataFrame:
        return X.load_touches(self.spark, self.sf)

    @cached_property
    def bronze(self) -> DataFrame:
        """Touches written once (a bronze table) for queries that run several
        scans over them; later scans read the files, not the derivation.  The
        touch expectations are enforced in the same write: a violation aborts
        it before any journey is built."""
        return materialize(enforce(self.touches, TOUCH_EXPECTATIONS), "bronze")

    @cached_property
    def base(self) -> DataFrame:
        """What the query's scans read: the written bronze table when several
        scans consume it, else the checked derivation itself (expectations
        still enforced in-plan)."""
        return enforce(self.touches, TOUCH_EXPECTATIONS) if self.single_pass else self.bronze

    @cached_property
    def summary(self) -> DataFrame:
        return J.journey_summary(self.base)

    @cached_property
    def outcomes(self) -> DataFrame:
        """Journeys counted by first channel, last channel and outcome: the one
        touch pass behind every heuristic credit and every denominator.  Bounded
        by the channels, so it is checkpointed like the edge table."""
        return A.outcomes(self.summary).checkpoint()

    @cached_property
    def gold(self) -> DataFrame:
        return A.gold_attribution(self.outcomes)

    @cached_property
    def edges(self) -> DataFrame:
        return M.edge_table(self.bronze)

    @cached_property
    def probability(self) -> DataFrame:
        # effects and credit read it several times; one row per channel
        return M.simple_path_probability(self.edges).checkpoint()

    @cached_property
    def markov_credit(self) -> DataFrame:
        return M.markov_attribution(M.removal_effects(self.probability))

    @cached_property
    def gold_all(self) -> DataFrame:
        # Markov rows come from a group-by on channel: keys are unique by
        # construction, so the duplicate-match check (an extra job) is skipped.
        return upsert.merge(self.gold, self.markov_credit, ["attribution_model", "channel"], check=False)


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("conversion_probability", F.round("conversion_probability", PROBABILITY_DIGITS))


# ---------------------------------------------------------------- sales


def sales_line_items(spark, sf):
    t = Tables(spark, sf)
    return S.line_items(X.sales(t.orders, t.lineitem))


def sales_expectation_counts(spark, sf):
    return S.line_item_expectations(sales_line_items(spark, sf))


def sales_customers_joined(spark, sf):
    return S.join_customers(sales_line_items(spark, sf), X.customers(Tables(spark, sf).customer))


def sales_products_joined(spark, sf):
    return S.join_products(sales_customers_joined(spark, sf), X.products(Tables(spark, sf).part))


def sales_enriched_from_files(spark, sf):
    """The sales tables as the reference ingests them: the order stream as
    JSON lines, customers as ``,``-CSV and products as ``;``-CSV (written by
    Spark from the base tables), read back with explicit schemas, then line
    items and both left joins."""
    t = Tables(spark, sf)
    root = work_dir(spark, "sales-files")
    sales_df = X.sales(t.orders, t.lineitem)
    cust, prod = X.customers(t.customer), X.products(t.part)
    sales_df.write.json(f"{root}/sales")
    cust.write.option("header", True).option("sep", ",").csv(f"{root}/customers")
    prod.write.option("header", True).option("sep", ";").csv(f"{root}/products")
    sales_in = read_json(spark, f"{root}/sales", SALES)
    cust_in = read_csv(spark, f"{root}/customers", schema=cust.schema, sep=",")
    prod_in = read_csv(spark, f"{root}/products", schema=prod.schema, sep=";")
    return S.join_products(S.join_customers(S.line_items(sales_in), cust_in), prod_in)


# ---------------------------------------------------------------- clickstream


def _clicks_raw(spark, sf):
    t = Tables(spark, sf)
    return X.clickstream_raw(t.lineitem, t.part, t.supplier)


def _published_clicks(prepared: DataFrame) -> DataFrame:
    """The prepared dataset, written with its fail expectation checked on every
    row: a violation aborts the write, and nothing downstream can filter it away."""
    return materialize(prepared, "clickstream-prepared")


def clickstream_prepared(spark, sf):
    return _published_clicks(C.prepared(_clicks_raw(spark, sf), check=True))


def clickstream_expectation_counts(spark, sf):
    return C.prepared_expectations(C.prepared(_clicks_raw(spark, sf)))


def clickstream_from_files(spark, sf):
    """Raw clicks dumped as JSON lines, queried directly in SQL
    (``SELECT * FROM json.`path` ``, inferred schema), then prepared."""
    root = work_dir(spark, "clicks-files")
    _clicks_raw(spark, sf).write.json(f"{root}/raw")
    raw = sql_on_files(spark, "json", f"{root}/raw")
    # one shape whatever inference saw (over empty files it sees no column)
    raw = raw.select(*[(F.col(f.name) if f.name in raw.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in CLICKSTREAM_RAW.fields])
    return _published_clicks(C.prepared(raw, check=True))


def top_referrers(spark, sf):
    return C.top_referrers(clickstream_prepared(spark, sf), TOP_PAGE, TOP_K)


# ---------------------------------------------------------------- bronze


def bronze_touches(spark, sf):
    return typed_touches(X.raw_touch_text(_Inputs(spark, sf).touches))


def bronze_expectation_counts(spark, sf):
    return expectation_counts(bronze_touches(spark, sf), "bronze_touches", TOUCH_EXPECTATIONS)


def _checked_stream(spark, sf):
    """Raw touch files land in a directory; a one-shot stream checks them into bronze."""
    root = work_dir(spark, "bronze-stream")
    write_raw_touches(X.raw_touch_text(_Inputs(spark, sf).touches), f"{root}/landing")
    ingest_checked(spark, f"{root}/landing", root, "bronze_touches", TOUCH_EXPECTATIONS)
    return root


def bronze_touches_streamed(spark, sf):
    return spark.read.parquet(f"{_checked_stream(spark, sf)}/bronze").drop("epoch")


def bronze_stream_counts(spark, sf):
    """What the stream's writes observed, over all micro-batches."""
    counts = spark.read.parquet(f"{_checked_stream(spark, sf)}/counts")
    return counts.groupBy("dataset", "expectation", "action").agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed"))


def quarantined_touches(spark, sf):
    """Touch files in which some lines are cut and some too long: the stream's quarantine."""
    root = work_dir(spark, "damaged-stream")
    X.damaged_touch_lines(X.load_touches(spark, sf)).write.text(f"{root}/landing")
    ingest_checked(spark, f"{root}/landing", root, "damaged_touches", TOUCH_EXPECTATIONS, header=False)
    return spark.read.parquet(f"{root}/quarantine").select("record")


def quarantined_clicks(spark, sf):
    """Click files in which some JSON lines are cut: the malformed records of a batch read."""
    root = work_dir(spark, "damaged-clicks")
    X.damaged_click_lines(_clicks_raw(spark, sf)).write.text(f"{root}/raw")
    return split_malformed(read_json(spark, f"{root}/raw", CLICKSTREAM_RAW, corrupt="_malformed"), "_malformed")[1]


# ---------------------------------------------------------------- journeys, credit


def user_journey(spark, sf):
    return J.render_journeys(J.user_journeys(_Inputs(spark, sf).bronze))


def journeys_streamed(spark, sf):
    """Touch files land in a directory; a one-shot stream keeps bronze and the
    journey table current; the journey table is returned."""
    root = work_dir(spark, "journey-stream")
    write_raw_touches(X.raw_touch_text(_Inputs(spark, sf).touches), f"{root}/landing")
    table = KeyedTable(spark, f"{root}/journeys", ["uid"], USER_JOURNEY, STREAM_BUCKETS)
    ingest_and_refresh(spark, f"{root}/landing", f"{root}/bronze", table, f"{root}/_checkpoint", buckets=STREAM_BUCKETS)
    return J.render_journeys(table.read())


def first_touch(spark, sf):
    return A.first_touch(_Inputs(spark, sf, single_pass=True).outcomes)


def last_touch(spark, sf):
    return A.last_touch(_Inputs(spark, sf, single_pass=True).outcomes)


def gold_attribution(spark, sf):
    return _Inputs(spark, sf, single_pass=True).gold


def linear_touch(spark, sf):
    return A.linear_touch(_Inputs(spark, sf, single_pass=True).base)


def time_decay(spark, sf):
    return A.time_decay(_Inputs(spark, sf, single_pass=True).base, DECAY_HALF_LIFE_HOURS)


# ---------------------------------------------------------------- markov


def journey_transitions(spark, sf):
    return M.transitions(_Inputs(spark, sf).bronze)


def path_transitions(spark, sf):
    """State changes counted from the rendered path text, as the reference does."""
    return M.path_transitions(J.user_journeys(_Inputs(spark, sf).bronze))


def transition_matrix(spark, sf):
    return M.transition_matrix(M.transitions(_Inputs(spark, sf).bronze))


def transition_row_sums(spark, sf):
    return M.row_sums(transition_matrix(spark, sf))


def transition_pivot(spark, sf):
    """Columns are the end states that the edge table holds."""
    return M.matrix_pivot(_Inputs(spark, sf).edges)


def removal_graph(spark, sf):
    return M.removal_graph(_Inputs(spark, sf).edges)


def markov_conversion_probability(spark, sf):
    return _rounded(_Inputs(spark, sf).probability)


def markov_removal_effect(spark, sf):
    return M.removal_effects(_Inputs(spark, sf).probability)


def markov_attribution(spark, sf):
    return _Inputs(spark, sf).markov_credit


def markov_absorbing(spark, sf):
    return _rounded(M.absorbing_probability(_Inputs(spark, sf).edges))


def markov_memo_dfs(spark, sf):
    return _rounded(M.memo_dfs_probability(_Inputs(spark, sf).edges))


def markov_removal_effect_memo(spark, sf):
    """Removal effects of the reference's own recursion."""
    return M.removal_effects(M.memo_dfs_probability(_Inputs(spark, sf).edges))


def markov_attribution_memo(spark, sf):
    """Credit from the reference's own recursion."""
    return M.markov_attribution(M.removal_effects(M.memo_dfs_probability(_Inputs(spark, sf).edges).checkpoint()))


# ---------------------------------------------------------------- spend


def base_conversion_rate(spark, sf):
    return P.base_conversion_rate(_Inputs(spark, sf, single_pass=True).outcomes)


def conversions_by_date(spark, sf):
    # The date count needs no journey id: filter and projection reach the scan.
    return P.conversions_by_date(X.touch_events(Tables(spark, sf).events))


def attribution_by_model(spark, sf):
    q = _Inputs(spark, sf)
    return A.attribution_by_model(q.gold_all, q.outcomes)


def cpa_summary(spark, sf):
    q = _Inputs(spark, sf)
    return P.cpa_summary(X.ad_spend(spark), q.gold_all, q.outcomes)


def markov_percent(spark, sf):
    return A.model_percent(_Inputs(spark, sf).markov_credit)


def spend_optimization(spark, sf):
    return P.spend_optimization(X.ad_spend(spark), _Inputs(spark, sf).markov_credit)


def spend_comparison(spark, sf):
    ad = X.ad_spend(spark)
    return P.spend_comparison(ad, P.spend_optimization(ad, _Inputs(spark, sf).markov_credit))


# ---------------------------------------------------------------- upsert, layout


def _refresh_inputs(spark, sf):
    t = _Inputs(spark, sf).bronze
    target = J.user_journeys(t.filter(F.col("time") < F.lit(FIRST_LOAD_BEFORE).cast("timestamp_ntz")))
    source = J.user_journeys(t.filter(F.col("time") >= F.lit(REFRESH_FROM).cast("timestamp_ntz")))
    return target, source


def upsert_journeys(spark, sf):
    target, source = _refresh_inputs(spark, sf)
    # All rows of a journey are replaced together: the check for one source row
    # per key does not apply to segment rows.
    return J.render_journeys(upsert.merge(target, source, ["uid"], check=False))


def _parts(spark, sf):
    """Touches of the first load and of the delivery after it."""
    t = _Inputs(spark, sf).bronze
    return t.filter(F.col("time") < F.lit(FIRST_LOAD_BEFORE).cast("timestamp_ntz")), t.filter(F.col("time") >= F.lit(REFRESH_FROM).cast("timestamp_ntz"))


def refresh_attribution(spark, sf):
    """First- and last-touch credit after a delivery, upserted into the credit table of
    the first load: the touched uids' old journeys leave the stored counts, their new ones
    enter."""
    first, delivered = (J.journey_summary(t).select(*JOURNEY_ENDS) for t in _parts(spark, sf))
    state = KeyedTable(spark, work_dir(spark, "journey-ends"), ["uid"], first.schema, STREAM_BUCKETS)
    state.append(first, 0)
    stored = A.outcomes(state.read()).checkpoint()
    counts = R.refreshed(state, materialize(delivered, "delivered"), 1, stored, A.outcomes, "journeys")
    return upsert.merge(A.gold_attribution(stored), A.gold_attribution(counts), ["attribution_model", "channel"])


def refresh_transition_matrix(spark, sf):
    """The transition matrix after the same delivery, from stored counts of state changes
    and the touched uids' journeys."""
    first, delivered = (J.user_journeys(t) for t in _parts(spark, sf))
    state = KeyedTable(spark, work_dir(spark, "journeys"), ["uid"], USER_JOURNEY, STREAM_BUCKETS)
    state.append(first, 0)
    stored = M.path_transitions(state.read()).checkpoint()
    counts = R.refreshed(state, materialize(delivered, "delivered"), 1, stored, M.path_transitions, "total_transitions")
    return M.transition_matrix(counts.withColumnRenamed("total_transitions", "cnt"))


def upsert_audit(spark, sf):
    target, source = _refresh_inputs(spark, sf)
    return upsert.audit(target, source, ["uid"], "gold_user_journey")


def upsert_attribution(spark, sf):
    return _Inputs(spark, sf).gold_all


def clustered_journeys(spark, sf):
    path = work_dir(spark, "gold-user-journey")
    layout.write_clustered(J.user_journeys(_Inputs(spark, sf).bronze), ["uid", "segment"], path)
    return J.render_journeys(spark.read.parquet(path))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in [
        sales_line_items,
        sales_expectation_counts,
        sales_customers_joined,
        sales_products_joined,
        sales_enriched_from_files,
        clickstream_prepared,
        clickstream_expectation_counts,
        clickstream_from_files,
        top_referrers,
        bronze_touches,
        bronze_expectation_counts,
        bronze_touches_streamed,
        bronze_stream_counts,
        quarantined_touches,
        quarantined_clicks,
        user_journey,
        journeys_streamed,
        first_touch,
        last_touch,
        gold_attribution,
        journey_transitions,
        path_transitions,
        transition_matrix,
        transition_row_sums,
        transition_pivot,
        removal_graph,
        markov_conversion_probability,
        markov_removal_effect,
        markov_attribution,
        markov_absorbing,
        markov_memo_dfs,
        markov_removal_effect_memo,
        markov_attribution_memo,
        base_conversion_rate,
        conversions_by_date,
        attribution_by_model,
        cpa_summary,
        markov_percent,
        spend_optimization,
        spend_comparison,
        upsert_journeys,
        upsert_audit,
        upsert_attribution,
        refresh_attribution,
        refresh_transition_matrix,
        clustered_journeys,
        linear_touch,
        time_decay,
    ]
}
