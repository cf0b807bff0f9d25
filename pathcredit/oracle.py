"""DuckDB oracle SQL for the named queries (base tables are pre-registered
views).  Each statement inlines the derived inputs as CTEs and is written
independently of the Spark plan: plain windows, string_agg and a recursive
CTE, i.e. the reference's own formulation."""

from __future__ import annotations

_EV = """
ev AS (
  SELECT event_id, user_id, ts AS time, strftime(ts, '%Y%m%d') AS day,
         CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS conversion,
         CASE WHEN event_type = 'purchase' THEN 'conversion' ELSE 'impression' END AS interaction,
         CASE CAST(json_extract_string(props, '$.k') AS INTEGER) % 5
           WHEN 0 THEN 'Social Network' WHEN 1 THEN 'Search Engine Marketing'
           WHEN 2 THEN 'Google Display Network' WHEN 3 THEN 'Affiliates' WHEN 4 THEN 'Email' END AS channel
  FROM events)"""

_TOUCHES = _EV + """,
touches AS (
  SELECT CAST(user_id AS VARCHAR) || '-' || day || '-' || CAST(COALESCE(SUM(conversion) OVER (
           PARTITION BY user_id, day ORDER BY time, event_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS VARCHAR) AS uid,
         time, interaction, channel, conversion, event_id
  FROM ev)"""


SEGMENT_TOUCHES = 1000


def _journeys(name: str, src: str, tie: str = "event_id") -> str:
    return f""",
{name}_steps AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY uid ORDER BY time, {tie}) AS rn,
         COUNT(*) OVER (PARTITION BY uid) AS n,
         DENSE_RANK() OVER (PARTITION BY uid ORDER BY time) AS visit_order
  FROM {src}),
{name}_ends AS (
  SELECT uid, MAX(CASE WHEN rn = 1 THEN channel END) AS first_interaction,
         MAX(CASE WHEN rn = n THEN channel END) AS last_interaction,
         MAX(CASE WHEN rn = n THEN conversion END) AS conversion,
         CAST((MAX(n) - 1) // {SEGMENT_TOUCHES} AS INTEGER) AS last_segment
  FROM {name}_steps GROUP BY uid),
{name}_rows AS (
  SELECT uid, CAST((rn - 1) // {SEGMENT_TOUCHES} AS INTEGER) AS segment,
         string_agg(channel, ' > ' ORDER BY time, {tie}) AS channels,
         string_agg(CAST(visit_order AS VARCHAR), ',' ORDER BY time, {tie}) AS visiting_order
  FROM {name}_steps GROUP BY uid, (rn - 1) // {SEGMENT_TOUCHES}),
{name} AS (
  SELECT r.uid,
         CASE WHEN r.segment = 0 THEN 'Start > ' ELSE '' END || r.channels
           || CASE WHEN r.segment < e.last_segment THEN '' WHEN e.conversion = 1 THEN ' > Conversion' ELSE ' > Null' END AS path,
         e.first_interaction, e.last_interaction, e.conversion, r.visiting_order, r.segment
  FROM {name}_rows r JOIN {name}_ends e ON r.uid = e.uid)"""


_SUMMARY = _TOUCHES + """,
steps AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY uid ORDER BY time, event_id) AS rn,
         COUNT(*) OVER (PARTITION BY uid) AS n
  FROM touches),
summary AS (
  SELECT uid, MAX(CASE WHEN rn = 1 THEN channel END) AS first_interaction,
         MAX(CASE WHEN rn = n THEN channel END) AS last_interaction,
         MAX(CASE WHEN rn = n THEN conversion END) AS conversion,
         MAX(time) AS last_time
  FROM steps GROUP BY uid)"""

_GOLD = _SUMMARY + """,
gold AS (
  SELECT 'first_touch' AS attribution_model, first_interaction AS channel,
         round(COUNT(*) / (SELECT COUNT(*) FROM summary WHERE conversion = 1), 2) AS attribution_percent
  FROM summary WHERE conversion = 1 GROUP BY first_interaction
  UNION
  SELECT 'last_touch' AS attribution_model, last_interaction AS channel,
         round(COUNT(*) / (SELECT COUNT(*) FROM summary WHERE conversion = 1), 2) AS attribution_percent
  FROM summary WHERE conversion = 1 GROUP BY last_interaction)"""

_TRANSITIONS = _GOLD + """,
nb AS (
  SELECT uid, channel, conversion,
         CASE WHEN ROW_NUMBER() OVER w = 1 THEN 'Start' ELSE LAG(channel) OVER w END AS prev_state,
         ROW_NUMBER() OVER w AS rn, COUNT(*) OVER (PARTITION BY uid) AS n
  FROM touches WINDOW w AS (PARTITION BY uid ORDER BY time, event_id)),
tr AS (
  SELECT uid, prev_state AS start_state, channel AS end_state FROM nb
  UNION ALL
  SELECT uid, channel AS start_state, CASE WHEN conversion = 1 THEN 'Conversion' ELSE 'Null' END AS end_state
  FROM nb WHERE rn = n),
edge_counts AS (SELECT start_state, end_state, COUNT(*) AS total FROM tr GROUP BY start_state, end_state),
matrix AS (
  SELECT start_state, end_state,
         CAST(total AS DOUBLE) / CAST(SUM(total) OVER (PARTITION BY start_state) AS DOUBLE) AS transition_probability
  FROM edge_counts),
candidates AS (SELECT DISTINCT start_state AS removed FROM matrix WHERE start_state <> 'Start')"""

_MARKOV = _TRANSITIONS + """,
walk(last_state, visited, prob) AS (
  SELECT end_state, [end_state], transition_probability FROM matrix WHERE start_state = 'Start'
  UNION ALL
  SELECT e.end_state, list_append(w.visited, e.end_state), w.prob * e.transition_probability
  FROM walk w JOIN matrix e ON e.start_state = w.last_state
  WHERE w.last_state NOT IN ('Conversion', 'Null') AND NOT list_contains(w.visited, e.end_state)),
paths AS (SELECT visited, prob FROM walk WHERE last_state = 'Conversion'),
probability AS (
  SELECT CAST(NULL AS VARCHAR) AS removed, COALESCE(SUM(prob), 0) AS conversion_probability FROM paths
  UNION ALL
  SELECT c.removed, COALESCE((SELECT SUM(p.prob) FROM paths p WHERE NOT list_contains(p.visited, c.removed)), 0)
  FROM candidates c),
effects AS (
  SELECT p.removed AS channel,
         round((b.conversion_probability - p.conversion_probability) / b.conversion_probability, 2) AS removal_effect
  FROM probability p, (SELECT conversion_probability FROM probability WHERE removed IS NULL) b
  WHERE p.removed IS NOT NULL),
markov AS (
  SELECT 'markov_chain' AS attribution_model, channel,
         round(removal_effect / SUM(removal_effect) OVER (), 2) AS attribution_percent
  FROM effects),
gold_all AS (
  SELECT * FROM markov
  UNION ALL
  SELECT g.* FROM gold g ANTI JOIN markov m
    ON g.attribution_model = m.attribution_model AND g.channel = m.channel),
converting AS (SELECT COUNT(*) AS n FROM summary WHERE conversion = 1),
ad_spend AS (
  SELECT channel, CAST(0.2 AS FLOAT) AS pct_spend, CAST(10000 AS FLOAT) AS total_spend_in_dollars
  FROM (VALUES ('Social Network'), ('Search Engine Marketing'), ('Google Display Network'),
               ('Affiliates'), ('Email')) v(channel)),
spend AS (SELECT channel, pct_spend, round(total_spend_in_dollars * pct_spend, 2) AS dollar_spend FROM ad_spend),
by_model AS (
  SELECT attribution_model, channel, round(attribution_percent * (SELECT n FROM converting)) AS conversions_attributed
  FROM gold_all),
optimization AS (
  SELECT a.channel, a.pct_spend, b.attribution_percent,
         b.attribution_percent / a.pct_spend AS ROAS, a.dollar_spend,
         round((b.attribution_percent / a.pct_spend) * a.dollar_spend, 2) AS proposed_dollar_spend
  FROM spend a JOIN gold_all b ON a.channel = b.channel AND b.attribution_model = 'markov_chain')"""


def _with(ctes: str, body: str) -> str:
    return f"WITH RECURSIVE {ctes.strip()}\n{body}"


_SALES = """
lines AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, l.l_orderkey, l.l_partkey,
         CASE WHEN o.o_orderkey % 50 = 0 THEN '0' ELSE CAST(CAST(l.l_quantity AS INTEGER) AS VARCHAR) END AS qty
  FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey),
line_items AS (
  SELECT o_custkey AS customer_id, o_orderkey AS order_number, o_orderdate AS order_datetime,
         CAST(l_partkey AS VARCHAR) AS product_id,
         CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE qty END AS quantity
  FROM lines WHERE l_orderkey IS NOT NULL),
with_customers AS (
  SELECT li.*, c.c_name, c.c_nationkey, c.c_acctbal, c.c_mktsegment
  FROM line_items li LEFT JOIN customer c ON li.customer_id = c.c_custkey)"""

_CLICKS = """
clicks_raw AS (
  SELECT CASE WHEN p.p_brand = 'Brand#9' THEN NULL ELSE p.p_brand END AS curr_title,
         s.s_name AS prev_title, CAST(COUNT(*) AS VARCHAR) AS n
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
  GROUP BY p.p_brand, s.s_name),
clicks AS (
  SELECT curr_title AS current_page_title, TRY_CAST(n AS INTEGER) AS click_count, prev_title AS previous_page_title
  FROM clicks_raw)"""

_REFRESH = _TOUCHES + _journeys("target_j", "(SELECT * FROM touches WHERE time < TIMESTAMP '2024-01-16 12:00:00')") + _journeys(
    "source_j", "(SELECT * FROM touches WHERE time >= TIMESTAMP '2024-01-16 00:00:00')"
)

def _weighted(model: str, weight: str) -> str:
    ctes = _SUMMARY + f""",
weights AS (
  SELECT t.uid, t.channel, {weight} AS w
  FROM touches t JOIN summary s ON t.uid = s.uid WHERE s.conversion = 1),
per_uid_channel AS (SELECT uid, channel, SUM(w) AS w FROM weights GROUP BY uid, channel),
normalised AS (SELECT channel, w / SUM(w) OVER (PARTITION BY uid) AS credit FROM per_uid_channel)"""
    body = f"""SELECT '{model}' AS attribution_model, channel,
       round(SUM(credit) / (SELECT COUNT(*) FROM summary WHERE conversion = 1), 6) AS attribution_percent
FROM normalised GROUP BY channel"""
    return _with(ctes, body)


_PIVOT_STATES = sorted(
    ["Social Network", "Search Engine Marketing", "Google Display Network", "Affiliates", "Email", "Conversion", "Null"]
)

ORACLE_SQL: dict[str, str] = {
    "sales_line_items": _with(_SALES, "SELECT * FROM line_items"),
    "sales_expectation_counts": _with(
        _SALES,
        """SELECT 'sales_line_items' AS dataset, 'order quantity' AS expectation, 'warn' AS action,
       CAST(SUM(CASE WHEN COALESCE(TRY_CAST(quantity AS BIGINT) > 0, FALSE) THEN 1 ELSE 0 END) AS BIGINT) AS passed,
       CAST(SUM(CASE WHEN COALESCE(TRY_CAST(quantity AS BIGINT) > 0, FALSE) THEN 0 ELSE 1 END) AS BIGINT) AS failed
FROM line_items""",
    ),
    "sales_customers_joined": _with(_SALES, "SELECT * FROM with_customers"),
    "sales_products_joined": _with(
        _SALES,
        """SELECT CAST(w.product_id AS BIGINT) AS product_id, w.customer_id, w.order_number, w.order_datetime,
       w.quantity, w.c_name, w.c_nationkey, w.c_acctbal, w.c_mktsegment,
       p.p_name, p.p_brand, p.p_type, p.p_size, p.p_retailprice
FROM with_customers w LEFT JOIN part p ON TRY_CAST(w.product_id AS BIGINT) = p.p_partkey""",
    ),
    "clickstream_prepared": _with(_CLICKS, "SELECT * FROM clicks"),
    "clickstream_expectation_counts": _with(
        _CLICKS,
        """SELECT 'clickstream_prepared' AS dataset, 'valid_current_page_title' AS expectation, 'warn' AS action,
       CAST(SUM(CASE WHEN current_page_title IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS passed,
       CAST(SUM(CASE WHEN current_page_title IS NOT NULL THEN 0 ELSE 1 END) AS BIGINT) AS failed
FROM clicks
UNION ALL
SELECT 'clickstream_prepared', 'valid_count', 'fail',
       CAST(SUM(CASE WHEN COALESCE(click_count > 0, FALSE) THEN 1 ELSE 0 END) AS BIGINT),
       CAST(SUM(CASE WHEN COALESCE(click_count > 0, FALSE) THEN 0 ELSE 1 END) AS BIGINT)
FROM clicks""",
    ),
    "top_referrers": _with(
        _CLICKS,
        """SELECT previous_page_title AS referrer, click_count FROM clicks
WHERE current_page_title = 'Brand#2' ORDER BY click_count DESC, referrer ASC LIMIT 10""",
    ),
    "bronze_touches": _with(
        _TOUCHES,
        """SELECT uid, strptime(strftime(time, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS time,
       interaction, channel, CAST(CAST(conversion AS VARCHAR) AS INTEGER) AS conversion
FROM touches""",
    ),
    "bronze_expectation_counts": _with(
        _TOUCHES
        + """,
bronze AS (
  SELECT uid, strptime(strftime(time, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS time,
         interaction, channel, CAST(CAST(conversion AS VARCHAR) AS INTEGER) AS conversion
  FROM touches)""",
        " UNION ALL ".join(
            f"""SELECT 'bronze_touches' AS dataset, '{name}' AS expectation, 'fail' AS action,
       CAST(SUM(CASE WHEN COALESCE({pred}, FALSE) THEN 1 ELSE 0 END) AS BIGINT) AS passed,
       CAST(SUM(CASE WHEN COALESCE({pred}, FALSE) THEN 0 ELSE 1 END) AS BIGINT) AS failed
FROM bronze"""
            for name, pred in [
                ("valid_uid", "uid IS NOT NULL"),
                ("valid_time", "time IS NOT NULL"),
                ("valid_channel", "channel IS NOT NULL"),
                ("valid_conversion", "conversion IN (0, 1)"),
            ]
        ),
    ),
    "user_journey": _with(_TOUCHES + _journeys("journeys", "touches"), "SELECT * FROM journeys"),
    "first_touch": _with(_GOLD, "SELECT * FROM gold WHERE attribution_model = 'first_touch'"),
    "last_touch": _with(_GOLD, "SELECT * FROM gold WHERE attribution_model = 'last_touch'"),
    "gold_attribution": _with(_GOLD, "SELECT * FROM gold"),
    "journey_transitions": _with(
        _TRANSITIONS, "SELECT uid, start_state, end_state, start_state || ' > ' || end_state AS transition, 1 AS cnt FROM tr"
    ),
    "path_transitions": _with(
        _TRANSITIONS, "SELECT start_state, end_state, COUNT(*) AS total_transitions FROM tr GROUP BY start_state, end_state"
    ),
    "transition_matrix": _with(_TRANSITIONS, "SELECT * FROM matrix"),
    "transition_row_sums": _with(
        _TRANSITIONS,
        "SELECT start_state, round(SUM(transition_probability), 2) AS transition_probability_sum FROM matrix GROUP BY start_state",
    ),
    "transition_pivot": _with(
        _TRANSITIONS,
        "SELECT start_state, "
        + ", ".join(
            f"MAX(CASE WHEN end_state = '{s}' THEN transition_probability END) AS \"{s}\"" for s in _PIVOT_STATES
        )
        + " FROM matrix GROUP BY start_state",
    ),
    "removal_graph": _with(
        _TRANSITIONS,
        """SELECT c.removed, m.start_state,
       CASE WHEN m.end_state = c.removed THEN 'Null' ELSE m.end_state END AS end_state,
       m.end_state AS original_end_state, m.transition_probability
FROM matrix m JOIN candidates c ON m.start_state <> c.removed""",
    ),
    "markov_conversion_probability": _with(
        _MARKOV, "SELECT removed, round(conversion_probability, 9) AS conversion_probability FROM probability"
    ),
    "markov_removal_effect": _with(_MARKOV, "SELECT * FROM effects"),
    "markov_attribution": _with(_MARKOV, "SELECT * FROM markov"),
    "base_conversion_rate": _with(
        _SUMMARY,
        """SELECT COUNT(*) AS count, CASE WHEN conversion = 0 THEN 'Impression' ELSE 'Conversion' END AS interaction_type,
       COUNT(*) / SUM(COUNT(*)) OVER () AS share
FROM summary GROUP BY conversion""",
    ),
    "conversions_by_date": _with(
        _TOUCHES,
        """SELECT COUNT(*) AS count, 'Conversion' AS interaction_type, CAST(time AS DATE) AS date
FROM touches WHERE conversion = 1 GROUP BY CAST(time AS DATE)""",
    ),
    "attribution_by_model": _with(_MARKOV, "SELECT * FROM by_model"),
    "cpa_summary": _with(
        _MARKOV,
        """SELECT s.channel, s.dollar_spend, b.attribution_model, b.conversions_attributed,
       round(CASE WHEN b.conversions_attributed = 0 THEN NULL ELSE s.dollar_spend / b.conversions_attributed END, 2) AS CPA_in_Dollars
FROM spend s JOIN by_model b ON s.channel = b.channel""",
    ),
    "markov_percent": _with(
        _MARKOV, "SELECT *, attribution_percent * 100 AS percentage FROM gold_all WHERE attribution_model = 'markov_chain'"
    ),
    "spend_optimization": _with(_MARKOV, "SELECT * FROM optimization"),
    "spend_comparison": _with(
        _MARKOV,
        """SELECT channel, 'current_spending' AS spending, CAST(dollar_spend AS DOUBLE) AS budget FROM spend
UNION
SELECT channel, 'proposed_spending' AS spending, proposed_dollar_spend AS budget FROM optimization""",
    ),
    "upsert_journeys": _with(
        _REFRESH,
        """SELECT * FROM source_j
UNION ALL
SELECT t.* FROM target_j t ANTI JOIN source_j s ON t.uid = s.uid""",
    ),
    "upsert_audit": _with(
        _REFRESH,
        """SELECT 'gold_user_journey' AS table_name,
       CAST((SELECT COUNT(*) FROM source_j s ANTI JOIN target_j t ON s.uid = t.uid) AS BIGINT) AS rows_inserted,
       CAST((SELECT COUNT(*) FROM source_j s SEMI JOIN target_j t ON s.uid = t.uid) AS BIGINT) AS rows_updated,
       CAST((SELECT COUNT(*) FROM target_j t ANTI JOIN source_j s ON t.uid = s.uid) AS BIGINT) AS rows_kept""",
    ),
    "upsert_attribution": _with(_MARKOV, "SELECT * FROM gold_all"),
    "clustered_journeys": _with(_TOUCHES + _journeys("journeys", "touches"), "SELECT * FROM journeys"),
    "linear_touch": _weighted("linear", "1.0"),
    "time_decay": _weighted(
        "time_decay", "pow(2.0, -((epoch_us(s.last_time) - epoch_us(t.time)) / 3.6e9) / 24.0)"
    ),
}

# Absorbing chain: value iteration v <- P v per removal scenario, as a
# recursive CTE over each scenario's edge list (400 steps; the transient part
# contracts by ~0.5 per step, so the fixed point is reached to machine
# precision).  Independent of the Spark side's exact linear solve.
ORACLE_SQL["markov_absorbing"] = _with(
    _TRANSITIONS
    + """,
scen AS (SELECT removed FROM candidates UNION ALL SELECT '~baseline~' AS removed),
g AS (
  SELECT s.removed, m.start_state,
         CASE WHEN m.end_state = s.removed THEN 'Null' ELSE m.end_state END AS end_state,
         CAST(m.transition_probability AS DOUBLE) AS p
  FROM matrix m JOIN scen s ON m.start_state <> s.removed),
st AS (
  SELECT removed, start_state AS s,
         CAST(ROW_NUMBER() OVER (PARTITION BY removed ORDER BY start_state) AS INTEGER) AS i
  FROM (SELECT DISTINCT removed, start_state FROM g)),
ge AS (
  SELECT g.removed, a.i AS si, COALESCE(b.i, 0) AS ei,
         CASE WHEN g.end_state = 'Conversion' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS conv, g.p
  FROM g JOIN st a ON a.removed = g.removed AND a.s = g.start_state
  LEFT JOIN st b ON b.removed = g.removed AND b.s = g.end_state),
packed AS (
  SELECT removed, list({'si': si, 'ei': ei, 'conv': conv, 'p': p}) AS es, MAX(si) AS n
  FROM ge GROUP BY removed),
it(k, removed, v) AS (
  SELECT 0, removed, list_transform(range(1, n + 1), lambda i: CAST(0 AS DOUBLE)) FROM packed
  UNION ALL
  SELECT it.k + 1, it.removed,
         list_transform(range(1, pk.n + 1), lambda i: COALESCE(list_sum(list_transform(
           list_filter(pk.es, lambda e: e.si = i),
           lambda e: e.p * (e.conv + CASE WHEN e.ei = 0 THEN CAST(0 AS DOUBLE) ELSE it.v[e.ei] END))), CAST(0 AS DOUBLE)))
  FROM it JOIN packed pk ON it.removed = pk.removed
  WHERE it.k < 400)""",
    """SELECT CASE WHEN it.removed = '~baseline~' THEN NULL ELSE it.removed END AS removed,
       round(it.v[st.i], 9) AS conversion_probability
FROM it JOIN st ON it.removed = st.removed AND st.s = 'Start'
WHERE it.k = 400""",
)

# Memoised recursion: the reference's recursion is a depth-first search
# (children in original end_state descending order) that evaluates each state
# once, at its post-order finish: a child on the stack counts 0, a finished
# child its stored value.  Replayed here as a recursive-CTE state machine, one
# examined edge or one finished state per step: stack, next-child positions,
# partial sums, probabilities of the pushing edges, finished states and values.
def _memo_dfs_sql() -> str:
    def set_last(lst: str, v: str) -> str:
        return f"list_concat(list_slice({lst}, 1, len({lst}) - 1), [{v}])"

    top = "d.stack[len(d.stack)]"
    nxt = "d.pos[len(d.pos)]"
    ch = "COALESCE(a.ch, [])"
    pop = f"({nxt} > len({ch}))"
    c = f"{ch}[{nxt}].c"
    p = f"{ch}[{nxt}].p"
    conv = f"({c} = 'Conversion')"
    skip = f"({c} = 'Null' OR list_contains(d.stack, {c}))"
    fin = f"list_contains(d.fn, {c})"
    push = f"(NOT ({conv} OR {skip} OR {fin}))"
    acc = "d.acc[len(d.acc)]"
    ctes = _TRANSITIONS + f""",
scen AS (SELECT removed FROM candidates UNION ALL SELECT '~baseline~' AS removed),
g AS (
  SELECT s.removed, m.start_state,
         CASE WHEN m.end_state = s.removed THEN 'Null' ELSE m.end_state END AS end_state,
         m.end_state AS original_end_state, CAST(m.transition_probability AS DOUBLE) AS p
  FROM matrix m JOIN scen s ON m.start_state <> s.removed),
adj AS (
  SELECT removed, start_state AS node,
         list({{'c': end_state, 'p': p}} ORDER BY original_end_state DESC) AS ch
  FROM g GROUP BY removed, start_state),
dfs(removed, stack, pos, acc, ep, fn, fv) AS (
  SELECT removed, ['Start'], [1], [CAST(0 AS DOUBLE)], [CAST(1 AS DOUBLE)],
         CAST([] AS VARCHAR[]), CAST([] AS DOUBLE[])
  FROM scen
  UNION ALL
  SELECT d.removed,
    CASE WHEN {pop} THEN list_slice(d.stack, 1, len(d.stack) - 1)
         WHEN {push} THEN list_append(d.stack, {c}) ELSE d.stack END,
    CASE WHEN {pop} THEN list_slice(d.pos, 1, len(d.pos) - 1)
         WHEN {push} THEN list_append({set_last('d.pos', f'{nxt} + 1')}, 1)
         ELSE {set_last('d.pos', f'{nxt} + 1')} END,
    CASE WHEN {pop} THEN
           CASE WHEN len(d.acc) > 1
                THEN {set_last('list_slice(d.acc, 1, len(d.acc) - 1)', f"d.acc[len(d.acc) - 1] + d.ep[len(d.ep)] * {acc}")}
                ELSE CAST([] AS DOUBLE[]) END
         WHEN {conv} THEN {set_last('d.acc', f'{acc} + {p}')}
         WHEN {skip} THEN d.acc
         WHEN {fin} THEN {set_last('d.acc', f'{acc} + {p} * d.fv[list_position(d.fn, {c})]')}
         ELSE list_append(d.acc, CAST(0 AS DOUBLE)) END,
    CASE WHEN {pop} THEN list_slice(d.ep, 1, len(d.ep) - 1)
         WHEN {push} THEN list_append(d.ep, {p}) ELSE d.ep END,
    CASE WHEN {pop} THEN list_append(d.fn, {top}) ELSE d.fn END,
    CASE WHEN {pop} THEN list_append(d.fv, {acc}) ELSE d.fv END
  FROM dfs d LEFT JOIN adj a ON a.removed = d.removed AND a.node = {top}
  WHERE len(d.stack) > 0)"""
    body = """SELECT CASE WHEN removed = '~baseline~' THEN NULL ELSE removed END AS removed,
       round(fv[list_position(fn, 'Start')], 9) AS conversion_probability
FROM dfs WHERE len(stack) = 0"""
    return _with(ctes, body)


ORACLE_SQL["markov_memo_dfs"] = _memo_dfs_sql()

# Effects and credit of the memoised recursion: its probabilities, then the same
# rounding as for the simple paths.
_MEMO = ORACLE_SQL["markov_memo_dfs"].replace("round(fv[list_position(fn, 'Start')], 9)", "fv[list_position(fn, 'Start')]")
_MEMO_EFFECTS = f"""WITH memo AS ({_MEMO}), effects AS (
  SELECT p.removed AS channel,
         round((b.conversion_probability - p.conversion_probability) / b.conversion_probability, 2) AS removal_effect
  FROM memo p, (SELECT conversion_probability FROM memo WHERE removed IS NULL) b
  WHERE p.removed IS NOT NULL)"""
ORACLE_SQL["markov_removal_effect_memo"] = _MEMO_EFFECTS + "\nSELECT * FROM effects"
ORACLE_SQL["markov_attribution_memo"] = _MEMO_EFFECTS + """
SELECT 'markov_chain' AS attribution_model, channel,
       round(removal_effect / SUM(removal_effect) OVER (), 2) AS attribution_percent
FROM effects"""

# The streamed journeys come from the text form of the touches: whole seconds,
# ties by content with a conversion last.
ORACLE_SQL["journeys_streamed"] = _with(
    _TOUCHES
    + """,
landed AS (
  SELECT uid, strptime(strftime(time, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS time, channel, conversion,
         concat_ws('|', CAST(conversion AS VARCHAR), channel, interaction) AS tie
  FROM touches)"""
    + _journeys("journeys", "landed", "tie"),
    "SELECT * FROM journeys",
)

# Credit after the refresh: first-load credit, replaced by that of the merged journeys.
ORACLE_SQL["refresh_attribution"] = _with(
    _REFRESH
    + """,
merged AS (
  SELECT * FROM source_j
  UNION ALL
  SELECT t.* FROM target_j t ANTI JOIN source_j s ON t.uid = s.uid),"""
    + ",".join(
        f"""
{name} AS ("""
        + " UNION ALL ".join(
            f"""
  SELECT '{model}' AS attribution_model, {col} AS channel,
         round(COUNT(*) / (SELECT COUNT(*) FROM {src} WHERE conversion = 1 AND segment = 0), 2) AS attribution_percent
  FROM {src} WHERE conversion = 1 AND segment = 0 GROUP BY {col}"""
            for model, col in [("first_touch", "first_interaction"), ("last_touch", "last_interaction")]
        )
        + ")"
        for name, src in [("before", "target_j"), ("after", "merged")]
    ),
    """SELECT * FROM after
UNION ALL
SELECT b.* FROM before b ANTI JOIN after a ON a.attribution_model = b.attribution_model AND a.channel = b.channel""",
)

# File-ingest variants read the same rows as their in-memory counterparts.
ORACLE_SQL["bronze_touches_streamed"] = ORACLE_SQL["bronze_touches"]
ORACLE_SQL["sales_enriched_from_files"] = ORACLE_SQL["sales_products_joined"]
ORACLE_SQL["clickstream_from_files"] = ORACLE_SQL["clickstream_prepared"]
ORACLE_SQL["bronze_stream_counts"] = ORACLE_SQL["bronze_expectation_counts"]
ORACLE_SQL["quarantined_touches"] = _with(
    _TOUCHES,
    """SELECT uid || ',' || strftime(time, '%Y-%m-%d %H:%M:%S')
       || CASE WHEN event_id % 97 = 0 THEN '' ELSE ',' || interaction || ',' || channel || ',' || CAST(conversion AS VARCHAR) || ',extra' END AS record
FROM touches WHERE event_id % 97 = 0 OR event_id % 101 = 0""",
)
# Journeys are by uid and the delivery is whole days: the refreshed matrix is that of all touches.
ORACLE_SQL["refresh_transition_matrix"] = ORACLE_SQL["transition_matrix"]
ORACLE_SQL["quarantined_clicks"] = _with(
    _CLICKS,
    """SELECT line[1 : len(line) - 2] AS record
FROM (SELECT n, '{' || CASE WHEN curr_title IS NULL THEN '' ELSE '"curr_title":"' || curr_title || '",' END
             || CASE WHEN prev_title IS NULL THEN '' ELSE '"prev_title":"' || prev_title || '",' END || '"n":"' || n || '"}' AS line FROM clicks_raw)
WHERE CAST(n AS BIGINT) % 7 = 0""",
)
