"""pathcredit: marketing-attribution and table-pipeline analytics on Apache Spark.

Every public function takes and returns ``DataFrame``s; no session, path or
table name is global.  See README.md for the module map.
"""

from pathcredit.operators.quality import Expectation, enforce, expectation_counts, publish
from pathcredit.operators.sequence import dense_rank_by, neighbors, running_sum, split_hot
from pathcredit.operators.catalog import create_table_as, replace_table_as
from pathcredit.operators.keyed import KeyedTable
from pathcredit.operators.upsert import audit, merge
from pathcredit.plans.attribution import (
    attribution_by_model,
    first_touch,
    gold_attribution,
    last_touch,
    linear_touch,
    time_decay,
)
from pathcredit.plans.journeys import journey_summary, user_journeys
from pathcredit.plans.markov import (
    conversion_probability,
    markov_attribution,
    removal_effects,
    removal_graph,
    transition_matrix,
    transitions,
)
from pathcredit.plans.spend import (
    base_conversion_rate,
    conversions_by_date,
    cpa_summary,
    spend_by_channel,
    spend_comparison,
    spend_optimization,
)

__version__ = "0.1.0"

__all__ = [
    "Expectation", "enforce", "expectation_counts", "publish",
    "dense_rank_by", "neighbors", "running_sum", "split_hot",
    "KeyedTable", "audit", "create_table_as", "merge", "replace_table_as",
    "attribution_by_model", "first_touch", "gold_attribution", "last_touch", "linear_touch", "time_decay",
    "journey_summary", "user_journeys",
    "conversion_probability", "markov_attribution", "removal_effects", "removal_graph", "transition_matrix",
    "transitions",
    "base_conversion_rate", "conversions_by_date", "cpa_summary", "spend_by_channel", "spend_comparison",
    "spend_optimization",
]
