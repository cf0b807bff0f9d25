"""Markov-chain attribution by removal effect, as one Spark dataflow.

touches --(skew-safe prev/next scan)--> transitions --(partial agg)--> edge
counts --> transition matrix (bounded: at most (#channels+1)*(#channels+2)
edges) --> conversion probability for every removal scenario at once -->
removal effects --> credit.

Only the per-touch scan and the count touch the big data.  Everything after it
works on the edge table, which is checkpointed once (it feeds several
branches and the recursion) and is small by construction, so broadcasting it is
safe.  Three methods for the conversion probability share one output shape
``(removed, conversion_probability)``, ``removed`` NULL for the full graph:

* ``simple_path``: sum over loop-free Start->Conversion paths, the definition
  the reference states: one recursive query while they are few, beyond that a
  level-by-level join expansion that merges paths with the same last state and
  visited set; the value without channel ``r`` is the sum
  over paths that avoid ``r``.  Its work doubles with every channel.
* ``absorbing``: loops included, exact absorption probability: one elimination of
  the baseline, and a rank-one update of it for every removal.
* ``memo_dfs`` (default): the reference's memoised depth-first recursion with
  children in ``end_state`` descending order, as what it computes: the edges
  that close a cycle in that order are found per scenario, and the values of the
  remaining acyclic graph are summed by joins, state by state.

The last two are polynomial in the channels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pathcredit.functions.columns import CONVERSION, NULL_STATE, PATH_SEP, START, ratio, terminal_state, transition_array, transition_label
from pathcredit.operators.sequence import neighbors
from pathcredit.session import materialize
from pathcredit.plans.attribution import MARKOV

# ------------------------------------------------------------------ transitions


def transitions(touches: DataFrame) -> DataFrame:
    """One row per state change of every journey: ``Start -> c1``, ``ci -> ci+1``
    and ``cn -> Conversion|Null``.  Built from neighbouring rows, not from the
    rendered path text, so channel names may contain any character."""
    narrow = touches.select("uid", "time", "event_id", "channel", "conversion")
    steps = neighbors(narrow, ["uid"], ["time", "event_id"], ["channel"], "prev", "next")
    enter = F.struct(F.coalesce(F.col("prev.channel"), F.lit(START)).alias("s"), F.col("channel").alias("e"))
    leave = F.struct(F.col("channel").alias("s"), terminal_state(F.col("conversion")).alias("e"))
    moves = F.when(F.col("next").isNull(), F.array(enter, leave)).otherwise(F.array(enter))
    exploded = steps.select("uid", F.explode(moves).alias("m"))
    return exploded.select(
        "uid",
        F.col("m.s").alias("start_state"),
        F.col("m.e").alias("end_state"),
        transition_label(F.col("m.s"), F.col("m.e")).alias("transition"),
        F.lit(1).alias("cnt"),
    )


def path_transitions(journeys: DataFrame) -> DataFrame:
    """``(start_state, end_state, total_transitions)`` from the path text of journeys.  A
    later row of a cut journey starts from the last state of the row before (a journey has
    a row for every thousand touches)."""
    rows = Window.partitionBy("uid").orderBy("segment")
    last = F.element_at(F.split("path", PATH_SEP), -1)
    whole = F.concat_ws(PATH_SEP, F.lag(last).over(rows), F.col("path"))
    moves = journeys.select(whole.alias("path")).select(F.explode(transition_array("path")).alias("transition"))
    counted = moves.groupBy("transition").agg(F.count(F.lit(1)).alias("total_transitions"))
    state = F.split("transition", PATH_SEP)
    return counted.select(F.get(state, 0).alias("start_state"), F.get(state, 1).alias("end_state"), "total_transitions")


def transition_matrix(transitions_df: DataFrame) -> DataFrame:
    """``p(s, e) = n(s, e) / sum_e n(s, e)`` (unrounded)."""
    counts = transitions_df.groupBy("start_state", "end_state").agg(F.sum("cnt").alias("total_transitions"))
    out_of_state = F.sum("total_transitions").over(Window.partitionBy("start_state"))
    return counts.select(
        "start_state",
        "end_state",
        ratio(F.col("total_transitions"), out_of_state).alias("transition_probability"),
    )


def row_sums(matrix: DataFrame) -> DataFrame:
    """Consistency check: outgoing probabilities of every state sum to 1."""
    return matrix.groupBy("start_state").agg(
        F.round(F.sum("transition_probability"), 2).alias("transition_probability_sum")
    )


def matrix_pivot(matrix: DataFrame, end_states: list[str] | None = None) -> DataFrame:
    """Heat-map input: one row per start state, one column per end state."""
    return matrix.groupBy("start_state").pivot("end_state", end_states).agg(F.first("transition_probability"))


# ------------------------------------------------------------- removal scenarios


def _channels_scalar(matrix: DataFrame):
    """Removal candidates (every start state but Start) as a scalar array."""
    return matrix.filter(F.col("start_state") != F.lit(START)).select(
        F.array_sort(F.collect_set("start_state"))
    ).scalar()


def removal_graph(matrix: DataFrame, include_baseline: bool = False) -> DataFrame:
    """Edges of the graph without each channel ``removed``: edges out of it are
    dropped, edges into it are redirected to ``Null``; nothing is renormalised.

    Every edge is copied once per scenario it belongs to (explode of the
    candidate list minus its own start state): no join, and the result is
    bounded by #channels x #edges.
    """
    others = F.array_remove(_channels_scalar(matrix), F.col("start_state"))
    if include_baseline:
        others = F.concat(F.array(F.lit(None).cast("string")), others)
    copies = matrix.select("*", F.explode(others).alias("removed"))
    return copies.select(
        "removed",
        "start_state",
        F.when(F.col("end_state") == F.col("removed"), F.lit(NULL_STATE)).otherwise(F.col("end_state")).alias("end_state"),
        F.col("end_state").alias("original_end_state"),
        "transition_probability",
    )


# ------------------------------------------------------------- simple paths

# Rounds of a recursion that share one plan before the state is written: cuts
# the lineage, changes no value.
_ROUNDS_A_PLAN = 8


#: Up to so many channels all loop-free paths are listed by one recursive query (their
#: number grows with the factorial: about 110,000 rows at 8); beyond, paths over the
#: same channels are merged level by level.
RECURSIVE_CHANNELS = 8


def listed_paths(matrix: DataFrame) -> DataFrame:
    """Loop-free Start -> Conversion paths with their probability, ``(channels, prob)``,
    by one recursive query over the edge table."""
    return matrix.sparkSession.sql(
        """
        WITH RECURSIVE paths(last_state, visited, prob) AS (
          SELECT end_state, array(end_state), transition_probability FROM {edges} WHERE start_state = :start
          UNION ALL
          SELECT e.end_state, array_append(p.visited, e.end_state), p.prob * e.transition_probability
          FROM paths p JOIN {edges} e ON e.start_state = p.last_state AND NOT array_contains(p.visited, e.end_state)
        )
        SELECT array_remove(visited, last_state) AS channels, prob FROM paths WHERE last_state = :conversion
        """,
        args={"start": START, "conversion": CONVERSION},
        edges=matrix,
    )


def converting_paths(matrix: DataFrame) -> DataFrame:
    """The loop-free paths by whichever way suits the number of channels."""
    channels = matrix.filter(F.col("start_state") != F.lit(START)).select("start_state").distinct().count()
    return listed_paths(matrix) if channels <= RECURSIVE_CHANNELS else merged_paths(matrix, channels)


def merged_paths(matrix: DataFrame, channels: int) -> DataFrame:
    """Loop-free Start -> Conversion paths with their probability, as
    ``(channels, prob)``, paths over the same channels merged.

    Level k holds the paths with k+1 states after Start; a simple path visits
    every channel at most once, so there are at most #channels+1 levels.  Each
    level joins the frontier with the edge table and sums paths with the same
    last state and visited set: everything downstream needs only the set of
    channels on a path, and the frontier stays within #channels * 2^#channels
    rows.  It is written every few levels, so no plan grows with the channels.
    The depth comes from the checkpointed edge table (one number to the driver).
    """
    edges = matrix.select("start_state", "end_state", "transition_probability")
    step = edges.withColumnsRenamed({"start_state": "_s", "end_state": "_e", "transition_probability": "_p"})
    frontier = edges.filter(F.col("start_state") == F.lit(START)).select(
        F.col("end_state").alias("last_state"),
        F.array("end_state").alias("visited"),
        F.col("transition_probability").alias("prob"),
    )
    # Each level extends open paths by one edge; a path with no allowed next
    # edge (it reached Conversion or Null, or every successor is already on
    # it) finds no partner in the left join and passes through unchanged.  The
    # plan is a chain of joins, one per level, with no union of levels.
    for level in range(1, channels + 2):
        extended = frontier.join(
            step,
            (F.col("last_state") == F.col("_s")) & ~F.array_contains("visited", F.col("_e")),
            "left",
        )
        frontier = extended.select(
            F.coalesce(F.col("_e"), F.col("last_state")).alias("last_state"),
            F.when(F.col("_e").isNull(), F.col("visited")).otherwise(F.array_append("visited", F.col("_e"))).alias(
                "visited"
            ),
            (F.col("prob") * F.coalesce(F.col("_p"), F.lit(1.0))).alias("prob"),
        )
        frontier = frontier.groupBy("last_state", F.array_sort("visited").alias("visited")).agg(F.sum("prob").alias("prob"))
        if level % _ROUNDS_A_PLAN == 0:
            frontier = materialize(frontier, "path-frontier")
    paths = frontier.filter(F.col("last_state") == F.lit(CONVERSION))
    return paths.select(F.array_remove("visited", F.lit(CONVERSION)).alias("channels"), "prob")


def simple_path_probability(matrix: DataFrame) -> DataFrame:
    """Conversion probability for the full graph and without each channel.

    Removing ``r`` zeroes exactly the paths through ``r``, so
    ``P_without(r) = P - sum(prob of paths through r)``.  One pass over the
    paths: each path adds its probability to the baseline (``removed`` NULL)
    and to every channel on it; zero rows keep candidates that no path uses.
    """
    paths = converting_paths(matrix)
    baseline = F.lit(None).cast("string")
    zero = matrix.select(
        F.when(F.col("start_state") == F.lit(START), baseline).otherwise(F.col("start_state")).alias("removed"),
        F.lit(0.0).alias("prob"),
    )
    through = paths.select(F.explode(F.concat(F.array(baseline), F.col("channels"))).alias("removed"), "prob")
    sums = zero.unionByName(through).groupBy("removed").agg(F.sum("prob").alias("s"))
    return sums.select(
        "removed",
        F.when(F.col("removed").isNull(), F.col("s"))
        .otherwise(_baseline_over(F.col("s")) - F.col("s"))
        .alias("conversion_probability"),
    )


def _baseline_over(value: F.Column) -> F.Column:
    """The baseline row's value on every row; the window spans one row per
    scenario (bounded by the number of channels)."""
    return F.max(F.when(F.col("removed").isNull(), value)).over(Window.partitionBy())


# ------------------------------------------------------------- absorbing chain

_BASELINE = "~baseline~"  # stands for "no channel removed" where rows are joined


def _scenarios(matrix: DataFrame) -> DataFrame:
    """(removed, s, e, p): the edges of every scenario, ``removed`` never NULL."""
    graph = removal_graph(matrix, include_baseline=True)
    return graph.select(
        F.coalesce("removed", F.lit(_BASELINE)).alias("removed"),
        F.col("start_state").alias("s"),
        F.col("end_state").alias("e"),
        F.col("original_end_state").alias("child"),
        F.col("transition_probability").alias("p"),
    )


def _start_values(values: DataFrame, scenarios: DataFrame) -> DataFrame:
    """(removed, conversion_probability): the value of Start, 0 where it has none."""
    start = values.filter(F.col("s") == F.lit(START)).select("removed", "v")
    names = scenarios.select("removed").distinct()
    return names.join(start, "removed", "left").select(
        F.when(F.col("removed") != F.lit(_BASELINE), F.col("removed")).alias("removed"),
        F.coalesce("v", F.lit(0.0)).alias("conversion_probability"),
    )


def _once(value: F.Column, body) -> F.Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _eliminated(rows: F.Column, states: F.Column) -> F.Column:
    """Gauss-Jordan over ``rows`` (a row a state): a fold over the pivots.  The rows of a
    transient chain need no pivoting; a state that never leaves has no pivot and counts
    0."""

    def pivot(matrix, k):
        own = F.get(matrix, k)

        def clear(lead):
            return F.transform(matrix, lambda row, i: F.when(i == k, lead).otherwise(F.zip_with(row, lead, lambda x, y: x - F.get(row, k) * y)))

        scaled = F.transform(own, lambda x: F.when(F.abs(F.get(own, k)) > 1e-12, x / F.get(own, k)).otherwise(F.lit(0.0)))
        return _once(scaled, clear)

    return F.aggregate(F.sequence(F.lit(0), F.size(states) - 1), rows, pivot)


def absorbing_probability(matrix: DataFrame) -> DataFrame:
    """Absorption probability in Conversion from Start, loops included.

    With ``Q`` the moves between states that have edges and ``b`` those to
    Conversion, the values are ``x = (I - Q)^-1 b``.  Removing a channel forces its
    value to 0, a rank-one update of the inverse ``N``: ``x_Start - N[Start, r] /
    N[r, r] x_r``.  So one elimination answers every scenario.  The edge table is
    gathered into one row (at most (#channels + 1)(#channels + 2) edges) and folded
    there; no round, no write and nothing to the driver.
    """
    held = matrix.agg(
        F.array_sort(F.collect_set("start_state")).alias("states"),
        F.map_from_entries(F.collect_list(F.struct(F.struct("start_state", "end_state"), "transition_probability"))).alias("p"),
    ).filter(F.array_contains("states", F.lit(START)))

    def p(s, e):
        return F.coalesce(F.try_element_at(F.col("p"), F.struct(s.alias("start_state"), e.alias("end_state"))), F.lit(0.0))

    def unit(s):
        return F.transform("states", lambda t: F.when(t == s, F.lit(1.0)).otherwise(F.lit(0.0)))

    rows = F.transform("states", lambda s: F.concat(F.zip_with(unit(s), F.transform("states", lambda t: p(s, t)), lambda x, y: x - y), unit(s), F.array(p(s, F.lit(CONVERSION)))))
    solved = held.select("states", F.size("states").alias("n"), rows.alias("rows")).select("states", "n", _eliminated(F.col("rows"), F.col("states")).alias("m"))
    start = F.get("m", (F.array_position("states", F.lit(START)) - 1).cast("int"))
    value = F.transform(
        "states",
        lambda s, i: F.struct(
            F.when(s != F.lit(START), s).alias("removed"),
            (
                F.get(start, 2 * F.col("n"))
                - F.when(s == F.lit(START), F.lit(0.0)).otherwise(
                    F.coalesce(F.try_divide(F.get(start, F.col("n") + i), F.get(F.get("m", i), F.col("n") + i)), F.lit(0.0)) * F.get(F.get("m", i), 2 * F.col("n"))
                )
            ).alias("conversion_probability"),
        ),
    )
    return solved.select(F.inline(value))


# ------------------------------------------------------------- memoised DFS


def _depth_first(graph: DataFrame) -> DataFrame:
    """(removed, s, above): for every state that a depth-first walk from Start
    enters, the states that are open when it does (itself included).

    Children go in ``child`` descending order.  One row per scenario holds its
    adjacency (at most #channels rows of at most #channels+2 children); a fold
    over twice as many turns as states either opens the first child that was
    never opened or closes the current state."""
    adjacency = graph.groupBy("removed", "s").agg(F.reverse(F.array_sort(F.collect_list(F.struct("child", "e")))).alias("c"))
    states = adjacency.groupBy("removed").agg(F.map_from_entries(F.collect_list(F.struct("s", F.col("c.e")))).alias("next"))
    path, none = F.array(F.lit(START)), F.array().cast("array<string>")
    entry = F.struct(F.lit(START).alias("s"), path.alias("above"))
    begin = F.struct(path.alias("open"), path.alias("seen"), F.array(entry).alias("log"))

    def turn(state, _):
        children = F.coalesce(F.try_element_at(F.col("next"), F.try_element_at(state["open"], F.lit(-1))), none)
        fresh = F.filter(children, lambda c: ~c.isin(CONVERSION, NULL_STATE) & ~F.array_contains(state["seen"], c))
        child = F.get(fresh, 0)
        deeper = F.array_append(state["open"], child)
        opened = F.struct(
            deeper.alias("open"),
            F.array_append(state["seen"], child).alias("seen"),
            F.array_append(state["log"], F.struct(child.alias("s"), deeper.alias("above"))).alias("log"),
        )
        closed = F.struct(
            F.slice(state["open"], 1, F.greatest(F.size(state["open"]) - 1, F.lit(0))).alias("open"), state["seen"].alias("seen"), state["log"].alias("log")
        )
        return F.when(F.size(state["open"]) == 0, state).when(child.isNotNull(), opened).otherwise(closed)

    turns = F.sequence(F.lit(1), 2 * F.size("next") + 2)
    walked = states.select("removed", F.aggregate(turns, begin, turn)["log"].alias("log"))
    return walked.select("removed", F.inline("log"))


def memo_dfs_probability(matrix: DataFrame) -> DataFrame:
    """The reference's recursion: a state is valued once, when the depth-first
    walk leaves it; a child that is still open counts 0, one that was left
    before counts its stored value.  So the edges to open states drop out, the
    rest is acyclic, and its values settle after at most one join per state."""
    graph = materialize(_scenarios(matrix), "scenarios")
    walked = _depth_first(graph)
    kept = materialize(
        graph.join(walked, ["removed", "s"]).filter(~F.array_contains("above", F.col("e"))).groupBy("removed", "s", "e").agg(F.sum("p").alias("p")), "acyclic"
    )
    own = kept.filter(F.col("e") == F.lit(CONVERSION)).select("removed", "s", F.col("p").alias("w"))
    inner = kept.filter(~F.col("e").isin(CONVERSION, NULL_STATE))
    v = own.select("removed", "s", F.col("w").alias("v"))
    for turn in range(1, matrix.select("start_state").distinct().count() + 1):
        ahead = inner.join(v.withColumnRenamed("s", "e"), ["removed", "e"]).groupBy("removed", "s").agg(F.sum(F.col("p") * F.col("v")).alias("d"))
        v = own.join(ahead, ["removed", "s"], "full_outer").select("removed", "s", (F.coalesce("w", F.lit(0.0)) + F.coalesce("d", F.lit(0.0))).alias("v"))
        if turn % _ROUNDS_A_PLAN == 0:
            v = materialize(v, "memo")
    return _start_values(v, graph)


METHODS = {
    "simple_path": simple_path_probability,
    "absorbing": absorbing_probability,
    "memo_dfs": memo_dfs_probability,
}


def conversion_probability(matrix: DataFrame, method: str = "memo_dfs") -> DataFrame:
    return METHODS[method](matrix)


# ------------------------------------------------------------- effects, credit


def removal_effects(probabilities: DataFrame) -> DataFrame:
    """``round((P - P_without) / P, 2)`` per removed channel."""
    total = _baseline_over(F.col("conversion_probability"))
    with_total = probabilities.select("removed", "conversion_probability", total.alias("_total"))
    return with_total.filter(F.col("removed").isNotNull()).select(
        F.col("removed").alias("channel"),
        F.round(ratio(F.col("_total") - F.col("conversion_probability"), F.col("_total")), 2).alias("removal_effect"),
    )


def markov_attribution(effects: DataFrame) -> DataFrame:
    """``round(effect / sum(effects), 2)`` from the already rounded effects.
    The global window runs over one row per channel."""
    return effects.select(
        F.lit(MARKOV).alias("attribution_model"),
        "channel",
        F.round(ratio(F.col("removal_effect"), F.sum("removal_effect").over(Window.partitionBy())), 2).alias(
            "attribution_percent"
        ),
    )


def edge_table(touches: DataFrame) -> DataFrame:
    """The transition matrix, checkpointed: it is read by every scenario and by
    the path expansion, and cutting its lineage keeps retries cheap.  It is
    bounded by (#channels+1)*(#channels+2) rows, so the checkpoint's second
    pass (it writes after counting) costs next to nothing; tables that grow
    with the data are written once as parquet instead (``materialize``)."""
    return transition_matrix(transitions(touches)).checkpoint()
