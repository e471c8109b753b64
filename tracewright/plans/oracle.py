"""The registered queries in DuckDB SQL, for side-by-side checks on the same tables.

Each statement is written against the given tables from the definition of the result, with
the adapters repeated as CTEs; it shares constants with the operators but no logic.
"""

from __future__ import annotations

import math
from importlib import resources
from xml.etree import ElementTree

from tracewright.model import SCHEMA_CONSTRAINTS, SLA_TARGET_HOURS
from tracewright.operators.monitoring import DURATION_BUCKETS
from tracewright.operators.prediction import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from tracewright.operators.scenarios import CATALOG
from tracewright.sources.adapters import (
    AHEAD_BALANCE,
    CLICK_IDEAL,
    CLICK_TARGETS,
    CLOSING_INDEX,
    LINE_ACTIVITIES,
    ORDER_APPROVAL,
    ORDER_DECISION,
    ORDER_IDEAL,
    ORDER_REWORK,
    ORDER_TARGETS,
    TIER_BALANCE,
)

H = "3600000000.0"
#: All kinds of clicks; one letter each makes a trace a word.
CLICK_KINDS = ("click", "error", "purchase", "signup", "view")


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def num(value: float) -> str:
    return f"{float(value)!r}e0"


def arr(values) -> str:
    return "[" + ", ".join(lit(v) for v in values) + "]"


def iso(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%dT%H:%M:%S.%fZ')"


def r(expr: str, name: str, digits: int = 6) -> str:
    return f"round({expr}, {digits}) AS {name}"


def case_of(column: str, mapping: dict, default: str) -> str:
    whens = " ".join(f"WHEN {column} = {lit(k)} THEN {v}" for k, v in mapping.items())
    return f"CASE {whens} ELSE {default} END" if whens else default


# --- adapters -----------------------------------------------------------------------------

DIMENSIONS = """
  'BU-' || (user_id % 3) AS business_unit, 'Dept-' || (user_id % 5) AS department,
  'Country-' || (user_id % 4) AS country, 'V-' || (user_id % 80) AS vendor_id,
  ['A','B','C'][((user_id // 3) % 3) + 1] AS vendor_tier,
  'Cat-' || (user_id % 7) AS material_category,
  ['Urgent','Standard','Strategic'][((user_id // 9) % 3) + 1] AS priority,
  'Channel-' || (user_id % 2) AS channel"""


def click(grain: str) -> str:
    return f"""ev AS (SELECT
  user_id || '|' || strftime(date_trunc('{grain}', ts), '%Y-%m-%d') AS case_id,
  event_id AS event_index, event_type AS activity, ts AS tm,
  'R-' || json_extract_string(props, '$.k') AS resource_id,
  CASE WHEN event_type IN ('error','signup') THEN 'Bot' ELSE 'Agent' END AS resource_role,
  {DIMENSIONS}, value AS amount_usd, event_type IN ('error','signup') AS automated,
  CAST(round(value * 60000000.0) AS BIGINT) AS touch_us,
  CASE WHEN event_type = 'purchase' THEN 'Checkout'
       WHEN event_type IN ('error','signup') THEN 'Portal' ELSE 'Web' END AS source_system
  FROM events)"""


def click_cases(grain: str) -> str:
    targets = case_of("priority", {k: num(v) for k, v in CLICK_TARGETS[grain].items()}, "NULL")
    return f"""cs0 AS (SELECT
  user_id || '|' || strftime(date_trunc('{grain}', ts), '%Y-%m-%d') AS case_id, user_id,
  min(ts) AS created_at, max(ts) AS completed_at, CAST(count(*) AS INTEGER) AS event_count,
  string_agg(DISTINCT event_type, '+' ORDER BY event_type) AS variant_ground_truth,
  CAST(count(*) - count(DISTINCT event_type) AS INTEGER) AS rework_count,
  round(sum(value), 2) AS amount_usd FROM events GROUP BY 1, 2),
cs1 AS (SELECT *, {DIMENSIONS},
  epoch_us(completed_at) - epoch_us(created_at) AS cycle_us,
  (epoch_us(completed_at) - epoch_us(created_at)) / {H} AS cycle_time_hours FROM cs0),
cs AS (SELECT *, {targets} AS sla_target_hours,
  cycle_time_hours > {targets} AS sla_breached FROM cs1)"""


LINES = """ev AS (SELECT CAST(l_orderkey AS VARCHAR) AS case_id, l_linenumber AS event_index,
  'Ship ' || l_returnflag || l_linestatus AS activity, l_shipdate AS tm, l_partkey AS part,
  l_extendedprice AS amount_usd, l_quantity AS processing_minutes,
  CASE l_returnflag WHEN 'A' THEN 'TRUE' WHEN 'N' THEN '0' ELSE l_returnflag END AS automated
  FROM lineitem)"""

ORDER_CASES = f"""ln AS (SELECT l_orderkey, max(l_linenumber) AS event_count, count(*) AS lines,
  max(l_shipdate) AS completed_at FROM lineitem GROUP BY 1),
oc0 AS (SELECT CAST(o_orderkey AS VARCHAR) AS case_id, o_orderdate AS created_at, completed_at,
  substr(c_mktsegment, 1, 1) AS vendor_tier,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Urgent' WHEN '3-MEDIUM' THEN 'Standard'
    WHEN '2-HIGH' THEN 'Strategic' ELSE o_orderpriority END AS priority,
  o_totalprice AS amount_usd, event_count, event_count - lines AS rework_count,
  (epoch_us(completed_at) - epoch_us(o_orderdate)) / {H} AS cycle_time_hours,
  o_orderstatus = 'P' AS sla_breached
  FROM orders LEFT JOIN ln ON l_orderkey = o_orderkey
  LEFT JOIN customer ON c_custkey = o_custkey),
oc AS (SELECT *, {case_of('priority', {k: num(v) for k, v in SLA_TARGET_HOURS.items()}, '0.0e0')}
  AS sla_target_hours FROM oc0)"""

CHAT = """ev AS (SELECT CAST(conv_id AS VARCHAR) AS case_id, turn AS event_index,
  role AS activity, turn AS tm FROM conversations)"""

LINKED = """tr AS (SELECT *,
  lag(activity) OVER w AS previous_activity,
  epoch_us(tm) - epoch_us(lag(tm) OVER w) AS wait_us
  FROM ev WINDOW w AS (PARTITION BY case_id ORDER BY tm, event_index, activity)),
st AS (SELECT * FROM tr WHERE previous_activity IS NOT NULL)"""

SEQ = """sq AS (SELECT case_id, list(activity ORDER BY tm, event_index, activity) AS steps,
  string_agg(activity, ' > ' ORDER BY tm, event_index, activity) AS variant
  FROM ev GROUP BY case_id)"""

VARIANTS = SEQ + """, vc AS (SELECT variant,
  CAST(len(any_value(steps)) AS BIGINT) AS activity_count, count(*) AS case_count FROM sq GROUP BY variant),
vr AS (SELECT row_number() OVER (ORDER BY case_count DESC, variant) AS variant_rank, variant,
  activity_count, case_count,
  case_count / CAST((SELECT sum(case_count) FROM vc) AS DOUBLE) AS case_share,
  CAST(sum(case_count) OVER (ORDER BY case_count DESC, variant
    ROWS UNBOUNDED PRECEDING) AS DOUBLE)
    / CAST((SELECT sum(case_count) FROM vc) AS DOUBLE) AS cumulative_share FROM vc)"""


def conform(ideal) -> str:
    letters = {a: lit(chr(ord("A") + i)) for i, a in enumerate(ideal)}
    code = "".join(chr(ord("A") + i) for i in range(len(ideal)))
    char = case_of("activity", letters, "'.'")
    n = len(ideal)
    path = arr(ideal)
    return f"""cf0 AS (SELECT case_id, list(activity ORDER BY tm, event_index, activity) AS steps,
  levenshtein(string_agg({char}, '' ORDER BY tm, event_index, activity), '{code}') AS d
  FROM ev GROUP BY case_id),
cf AS (SELECT case_id, CAST(d AS INTEGER) AS edit_distance, d = 0 AS conformant,
  greatest(0.0, 1.0 - d / CAST(greatest(len(steps), {n}) AS DOUBLE)) AS fitness,
  list_filter({path}, lambda a: NOT list_contains(steps, a)) AS missing,
  list_sort(list_distinct(list_filter(steps, lambda a: NOT list_contains({path}, a))))
    AS unexpected,
  list_sort(list_filter(list_distinct(steps),
    lambda a: len(list_filter(steps, lambda b: b = a)) > 1)) AS repeated FROM cf0)"""


def dev(ideal) -> str:
    return f"""WITH src, {conform(ideal)}, d AS (
  SELECT 'missing' AS deviation_type, unnest(missing) AS activity FROM cf
  UNION ALL SELECT 'unexpected', unnest(unexpected) FROM cf
  UNION ALL SELECT 'repeated', unnest(repeated) FROM cf)
SELECT deviation_type, activity, count(*) AS case_count FROM d GROUP BY 1, 2"""


# --- order process ------------------------------------------------------------------------

ORDERS = f"""cu AS (SELECT c_custkey, c_mktsegment AS department, n_name AS country,
  r_name AS business_unit,
  CASE WHEN c_acctbal >= {AHEAD_BALANCE} THEN 'Prepaid' ELSE 'Account' END AS channel
  FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
  LEFT JOIN region ON r_regionkey = n_regionkey),
pl AS (SELECT CAST(o_orderkey AS VARCHAR) AS case_id, o_custkey, o_orderstatus,
  o_orderdate AS placed_at, o_totalprice AS amount_usd,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Urgent' WHEN '2-HIGH' THEN 'Strategic'
    ELSE 'Standard' END AS priority, business_unit, department, country, channel
  FROM orders LEFT JOIN cu ON c_custkey = o_custkey),
li AS (SELECT *, CAST(l_orderkey AS VARCHAR) AS case_id, row_number() OVER (
  PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_suppkey DESC, l_partkey DESC) AS dearest
  FROM lineitem),
sm AS (SELECT case_id, max(l_shipdate) AS last_at, count(*) AS lines,
  count(DISTINCT l_returnflag) AS kinds,
  max(l_suppkey) FILTER (dearest = 1) AS suppkey, max(l_partkey) FILTER (dearest = 1) AS partkey
  FROM li GROUP BY case_id),
ev AS (
  SELECT case_id, 0 AS event_index, 'Order Placed' AS activity, placed_at AS tm,
    'C-' || o_custkey AS resource_id, 'Customer' AS resource_role, business_unit, department,
    amount_usd, false AS automated, CAST(0 AS BIGINT) AS touch_us, 'Order Desk' AS source_system
  FROM pl
  UNION ALL
  SELECT case_id, l_linenumber, {case_of("l_returnflag", {k: lit(v) for k, v in
                                                          LINE_ACTIVITIES.items()}, "NULL")},
    l_shipdate, 'S-' || l_suppkey, 'Supplier', business_unit, department, l_extendedprice,
    l_linestatus = 'F', CAST(round(l_quantity * 60000000.0) AS BIGINT),
    CASE l_linestatus WHEN 'F' THEN 'Settled Lines' ELSE 'Open Lines' END
  FROM li JOIN pl USING (case_id)
  UNION ALL
  SELECT case_id, {CLOSING_INDEX}, 'Order Closed', greatest(placed_at, last_at), 'DESK', 'Desk',
    business_unit, department, amount_usd, true, 0, 'Ledger'
  FROM pl LEFT JOIN sm USING (case_id) WHERE o_orderstatus = 'F'),
cs0 AS (SELECT case_id, placed_at AS created_at,
  coalesce(greatest(placed_at, last_at), placed_at) AS completed_at, business_unit, department,
  country, 'V-' || suppkey AS vendor_id,
  CASE WHEN suppkey IS NULL THEN NULL WHEN s_acctbal >= {TIER_BALANCE["A"]} THEN 'A' WHEN s_acctbal >= {TIER_BALANCE["B"]} THEN 'B'
    ELSE 'C' END AS vendor_tier, p_type AS material_category, amount_usd, priority, channel,
  o_orderstatus AS variant_ground_truth,
  CAST(1 + coalesce(lines, 0) + CASE o_orderstatus WHEN 'F' THEN 1 ELSE 0 END AS INTEGER)
    AS event_count,
  CAST(coalesce(lines, 0) - coalesce(kinds, 0) AS INTEGER) AS rework_count
  FROM pl LEFT JOIN sm USING (case_id) LEFT JOIN supplier ON s_suppkey = suppkey
  LEFT JOIN part ON p_partkey = partkey),
cs AS (SELECT *, (epoch_us(completed_at) - epoch_us(created_at)) / {H} AS cycle_time_hours,
  {case_of("priority", {k: num(v) for k, v in ORDER_TARGETS.items()}, "NULL")} AS sla_target_hours,
  (epoch_us(completed_at) - epoch_us(created_at)) / {H}
    > {case_of("priority", {k: num(v) for k, v in ORDER_TARGETS.items()}, "NULL")} AS sla_breached
  FROM cs0)"""

def model_ctes() -> str:
    """Edges ``m`` of the packaged model: a recursive walk from each task to the next ones."""
    text = resources.files("tracewright.sources").joinpath("order_process.bpmn").read_text()
    space = "{http://www.omg.org/spec/BPMN/20100524/MODEL}"
    root = ElementTree.fromstring(text.encode())
    tasks = ", ".join(f"({lit(x.get('id'))}, {lit(x.get('name'))})" for x in root.iter()
                      if x.tag.lower().endswith("task"))
    flows = ", ".join(f"({lit(x.get('sourceRef'))}, {lit(x.get('targetRef'))})"
                      for x in root.iter(f"{space}sequenceFlow"))
    return f"""task(id, name) AS (VALUES {tasks}), flow(a, b) AS (VALUES {flows}),
walk(start, node) AS (SELECT a, b FROM flow WHERE a IN (SELECT id FROM task)
  UNION SELECT start, b FROM walk JOIN flow ON a = node
  WHERE node NOT IN (SELECT id FROM task)),
m AS (SELECT DISTINCT s.name AS source, t.name AS target FROM walk
  JOIN task s ON s.id = start JOIN task t ON t.id = node)"""


CASES_SELECT = f"""SELECT case_id, {iso("created_at")} AS created_at,
  {iso("completed_at")} AS completed_at, business_unit, department, country, vendor_id,
  vendor_tier, material_category, amount_usd, priority, channel, variant_ground_truth,
  event_count, rework_count, {r("cycle_time_hours", "cycle_time_hours")}, sla_target_hours,
  sla_breached"""


# --- shared result shapes -----------------------------------------------------------------


def dfg_select(cases: str = "(SELECT count(DISTINCT case_id) FROM ev)") -> str:
    return f"""SELECT previous_activity AS source, activity AS target,
  count(*) AS transition_count,
  {r(f"sum(wait_us) / CAST(count(*) AS DOUBLE) / {H}", "mean_wait_hours")},
  {r(f"quantile_cont(wait_us, 0.5) / {H}", "median_wait_hours")},
  {r(f"quantile_cont(wait_us, 0.9) / {H}", "p90_wait_hours")},
  {r(f"count(*) / CAST({cases} AS DOUBLE)", "case_coverage")}
FROM st GROUP BY 1, 2"""


BOTTLENECK = f"""bn0 AS (SELECT activity, count(DISTINCT case_id) AS case_count,
  count(*) AS transition_count, sum(wait_us) / {H} AS total_wait_hours,
  sum(wait_us) / CAST(count(*) AS DOUBLE) / {H} AS mean_wait_hours,
  quantile_cont(wait_us, 0.5) / {H} AS median_wait_hours,
  quantile_cont(wait_us, 0.9) / {H} AS p90_wait_hours,
  quantile_cont(wait_us, 0.95) / {H} AS p95_wait_hours,
  count(DISTINCT case_id) / CAST((SELECT count(DISTINCT case_id) FROM ev) AS DOUBLE)
    AS case_coverage FROM st GROUP BY activity),
bn AS (SELECT *, 0.55 * total_wait_hours / max(total_wait_hours) OVER ()
  + 0.30 * p90_wait_hours / max(p90_wait_hours) OVER () + 0.15 * case_coverage
  AS bottleneck_score FROM bn0)"""

BOTTLENECK_SELECT = "SELECT activity, case_count, transition_count, " + ", ".join(
    r(c, c) for c in ("total_wait_hours", "mean_wait_hours", "median_wait_hours",
                      "p90_wait_hours", "p95_wait_hours", "case_coverage", "bottleneck_score")
) + " FROM bn"

PERFORMANCE = f"""pf0 AS (SELECT case_id, min(tm) AS created_at, max(tm) AS completed_at,
  count(*) AS event_count, count(DISTINCT activity) AS unique_activity_count,
  sum(touch_us) AS touch, count(*) FILTER (automated) AS automated_event_count
  FROM ev GROUP BY case_id),
pf AS (SELECT *, (epoch_us(completed_at) - epoch_us(created_at)) / {H} AS cycle_time_hours,
  touch / {H} AS touch_time_hours,
  greatest(0.0, (epoch_us(completed_at) - epoch_us(created_at)) / {H} - touch / {H})
    AS estimated_wait_hours, event_count - unique_activity_count AS rework_event_count,
  automated_event_count / CAST(event_count AS DOUBLE) AS automation_rate FROM pf0)"""


def kpi_select() -> str:
    q = "(SELECT quantile_cont(CAST(round(cycle_time_hours * 3600000000.0) AS BIGINT), {}) FROM cs)"
    q = q + f" / {H}"
    return f"""SELECT {r(q.format(0.5), "median_cycle_hours", 2)},
  {r(q.format(0.9), "p90_cycle_hours", 2)}, {r(q.format(0.95), "p95_cycle_hours", 2)},
  {r("(SELECT avg(CASE WHEN sla_breached THEN 0.0 ELSE 1.0 END) FROM cs)", "sla_adherence", 4)},
  {r("(SELECT avg(CAST(conformant AS INTEGER)) FROM cf)", "straight_through_rate", 4)},
  {r("(SELECT avg(fitness) FROM cf)", "mean_conformance_fitness", 4)},
  {r("(SELECT avg(CAST(rework_count > 0 AS INTEGER)) FROM cs)", "rework_case_rate", 4)},
  {r("(SELECT avg(CAST(automated AS INTEGER)) FROM ev)", "automation_event_rate", 4)},
  {r("(SELECT sum(estimated_wait_hours) / greatest(sum(cycle_time_hours), 1.0) FROM pf)",
     "wait_time_share", 4)},
  8000 AS annualized_case_volume"""


def features(decision: str, approval: str, rework: str, touch: str) -> str:
    return f"""po AS (SELECT case_id, min(tm) AS po_created_at FROM ev
  WHERE activity = {lit(decision)} GROUP BY 1),
early AS (SELECT ev.case_id, count(*) AS early_event_count,
  count(*) FILTER (activity = {lit(approval)}) AS approval_count,
  count(*) FILTER (activity = {lit(rework)}) AS early_rework_count,
  sum(CASE WHEN automated THEN 0 ELSE {touch} END) AS manual_us
  FROM ev LEFT JOIN po USING (case_id) WHERE po_created_at IS NULL OR tm <= po_created_at
  GROUP BY 1),
ft AS (SELECT cs.*, po_created_at,
  coalesce((epoch_us(po_created_at) - epoch_us(created_at)) / {H}, cycle_time_hours)
    AS elapsed_to_po_hours, coalesce(early_event_count, 0) AS early_event_count,
  coalesce(approval_count, 0) AS approval_count,
  coalesce(early_rework_count, 0) AS early_rework_count,
  coalesce(manual_us / 60000000.0, 0.0) AS early_manual_minutes
  FROM cs LEFT JOIN po USING (case_id) LEFT JOIN early USING (case_id))"""


ORDER_FEATURES = features(ORDER_DECISION, ORDER_APPROVAL, ORDER_REWORK, "touch_us")
SCORED = """sc AS (SELECT *, least(1.0, greatest(0.0,
    round(elapsed_to_po_hours / sla_target_hours, 2))) AS risk_score FROM ft),
sp AS (SELECT *, risk_score >= 0.5 AS predicted_breach, CASE WHEN risk_score <= 0.30 THEN 'Low'
  WHEN risk_score <= 0.60 THEN 'Medium' WHEN risk_score <= 0.80 THEN 'High' ELSE 'Critical' END
  AS risk_band FROM sc)"""


def rank_sql(by: str | None, source: str = "sp") -> str:
    keys = f"{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""rk0 AS (SELECT {keys}risk_score, count(*) FILTER (sla_breached) AS pos,
  count(*) FILTER (NOT sla_breached) AS neg FROM {source} GROUP BY {keys}risk_score),
rk1 AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
  sum(pos) OVER ({part}) AS p, sum(neg) OVER ({part}) AS n FROM rk0
  WINDOW w AS ({part} ORDER BY risk_score DESC)),
rk AS (SELECT {keys}coalesce(
    sum(neg * (tp - pos + pos / 2.0)) / nullif(max(p) * CAST(max(n) AS DOUBLE), 0), 0.5) AS roc_auc,
  coalesce(sum(pos * (tp / CAST(tp + fp AS DOUBLE))) / nullif(max(p), 0),
    max(p) / CAST(max(p) + max(n) AS DOUBLE)) AS average_precision FROM rk1 {group})"""


def threshold_sql(by: str, source: str = "sp") -> str:
    return f"""th0 AS (SELECT {by}, count(*) AS cases,
  count(*) FILTER (NOT sla_breached AND NOT predicted_breach) AS tn,
  count(*) FILTER (NOT sla_breached AND predicted_breach) AS fp,
  count(*) FILTER (sla_breached AND NOT predicted_breach) AS fn,
  count(*) FILTER (sla_breached AND predicted_breach) AS tp,
  avg(power(risk_score - CAST(sla_breached AS INTEGER), 2)) AS brier,
  avg(CAST(sla_breached AS INTEGER)) AS positive_rate FROM {source} GROUP BY ALL),
th AS (SELECT {by}, cases, {r("positive_rate", "positive_rate")},
  {r("(tp + tn) / CAST(cases AS DOUBLE)", "accuracy")},
  {r("coalesce(tp / CAST(nullif(tp + fp, 0) AS DOUBLE), 0.0)", "precision")},
  {r("coalesce(tp / CAST(nullif(tp + fn, 0) AS DOUBLE), 0.0)", "recall")},
  {r("coalesce(2 * tp / CAST(nullif(2 * tp + fp + fn, 0) AS DOUBLE), 0.0)", "f1")},
  {r("brier", "brier_score")}, tn AS true_negative, fp AS false_positive,
  fn AS false_negative, tp AS true_positive FROM th0)"""


# --- scenarios ----------------------------------------------------------------------------


def scenario_ctes(stage_map, replications: int) -> str:
    """Case outcomes per scenario from the published levers, restated per activity."""
    stage = stage_map.stage_activity

    def factor(s, kind):
        out: dict[str, float] = {}
        seats = {"Manager Approval": 7, "Procurement Review": 6, "Purchase Order Created": 5,
                 "Goods Received": 7, "Invoice Matched": 4, "Payment Authorized": 3}
        for name, activity in stage.items():
            value = s.service_factor.get(name, 1.0)
            if kind == "wait":
                value = value * seats[name] / s.seats.get(name, seats[name])
            out[activity] = value
        if kind == "wait":
            for a in stage_map.lead_time_activities:
                out[a] = out.get(a, 1.0) * s.lead_time_factor
            for a in stage_map.rework_activities:
                out[a] = out.get(a, 1.0) * s.rework_probability / 0.16
        return {a: num(v) for a, v in out.items()}

    parts = []
    for i, s in enumerate(CATALOG):
        wait = case_of("activity", factor(s, "wait"), "1e0")
        manual = case_of("activity", factor(s, "manual"), "1e0")
        parts.append(f"""SELECT {i} AS catalog_index, {lit(s.name)} AS scenario, case_id,
  min(tm) AS arrival,
  CAST(sum(CAST(round(coalesce(wait_us, 0) * ({wait})) AS BIGINT)) AS BIGINT) AS cycle_us,
  CAST(sum(CAST(round(CASE WHEN automated THEN 0 ELSE touch_us END * ({manual})) AS BIGINT))
    AS BIGINT) AS manual_us FROM tr GROUP BY case_id""")
    rows = " UNION ALL ".join(parts)
    metrics = ("mean_cycle_hours", "median_cycle_hours", "p90_cycle_hours", "sla_adherence",
               "manual_hours_per_case", "throughput_cases_per_8h")
    catalog = ", ".join(
        f"({i}, {lit(s.description)}, {num(s.investment_usd)})" for i, s in enumerate(CATALOG)
    )
    # How often a replication draws a case: the Poisson distribution of mean one, inverted.
    reached, whens = 0.0, []
    for k in range(10):
        reached += 1 / (math.e * math.factorial(k))
        whens.append(f"WHEN u < {reached!r}e0 THEN {k}")
    poisson = f"CASE {' '.join(whens)} ELSE 10 END"
    return f"""wi0 AS ({rows}),
wi AS (SELECT case_id, epoch_us(arrival) AS arrival_us, sla_target_hours, catalog_index,
  scenario, wi0.cycle_us AS cycle_us, manual_us FROM wi0 LEFT JOIN cs USING (case_id)),
dr AS (SELECT case_id, k AS replication, CAST('0x' || substr(sha256('bootstrap|' || case_id || '|'
    || (k // 5)), 1 + 12 * (k % 5), 12) AS BIGINT) / 281474976710656e0 AS u
  FROM (SELECT DISTINCT case_id FROM wi0), range({replications}) AS r(k)),
wt AS (SELECT case_id, replication, {poisson} AS w FROM dr),
rx AS (SELECT wi.*, CAST(replication AS INTEGER) AS replication
  FROM wi JOIN wt USING (case_id), range(w) AS r(copy)),
ro AS (SELECT catalog_index, scenario, replication, count(*) AS cases,
  sum(cycle_us) / CAST(count(*) AS DOUBLE) / {H} AS mean_cycle_hours,
  quantile_cont(cycle_us, 0.5) / {H} AS median_cycle_hours,
  quantile_cont(cycle_us, 0.9) / {H} AS p90_cycle_hours,
  1 - avg(CAST(cycle_us / {H} > sla_target_hours AS INTEGER)) AS sla_adherence,
  sum(manual_us) / CAST(count(*) AS DOUBLE) / {H} AS manual_hours_per_case,
  count(*) / greatest((max(arrival_us + cycle_us) - min(arrival_us)) / {H}, 1.0) * 8
    AS throughput_cases_per_8h FROM rx GROUP BY 1, 2, 3),
mo AS (SELECT catalog_index, scenario, {", ".join(f"avg({m}) AS {m}" for m in metrics)}
  FROM ro GROUP BY 1, 2),
cat(catalog_index, description, one_time_investment_usd) AS (VALUES {catalog}),
b AS (SELECT * FROM mo WHERE catalog_index = 0),
c0 AS (SELECT mo.*, description, one_time_investment_usd,
  greatest(0.0, 1 - mo.mean_cycle_hours / b.mean_cycle_hours) AS cycle_time_reduction_pct,
  (mo.sla_adherence - b.sla_adherence) * 100 AS sla_adherence_uplift_pp,
  greatest(0.0, b.manual_hours_per_case - mo.manual_hours_per_case)
    AS manual_hours_saved_per_case,
  8000 * (greatest(0.0, b.mean_cycle_hours - mo.mean_cycle_hours) * 5.5
    + greatest(0.0, b.manual_hours_per_case - mo.manual_hours_per_case) * 32
    + greatest(0.0, mo.sla_adherence - b.sla_adherence) * 85) AS estimated_annual_value_usd
  FROM mo JOIN cat USING (catalog_index), b),
cmp AS (SELECT *, CASE WHEN one_time_investment_usd > 0 THEN
  (estimated_annual_value_usd - one_time_investment_usd) / one_time_investment_usd
  ELSE 0.0 END AS first_year_roi FROM c0)"""


# --- measures -----------------------------------------------------------------------------


def measure_select(source: str, by: str, extra: str = "", grouping: str | None = None) -> str:
    names = by.split(", ")
    level = f", CAST(GROUPING({by}) AS INTEGER) AS level" if grouping else ""
    cycle = "CAST(round(cycle_time_hours * 3600000000.0) AS BIGINT)"
    return f"""SELECT {", ".join(names)}{level}, count(*) AS cases,
  {r("CAST(sum(CAST(amount_usd AS DECIMAL(14,2))) AS DOUBLE)", "total_spend")},
  {r(f"sum({cycle}) / CAST(count(*) AS DOUBLE) / {H}", "average_cycle_hours")},
  count(*) FILTER (sla_breached) AS sla_breached_cases, {extra}
  {r("CAST(sum(CAST(amount_usd AS DECIMAL(14,2))) AS DOUBLE) / count(*)",
     "average_spend_per_case")},
  {r("1 - count(*) FILTER (sla_breached) / CAST(count(*) AS DOUBLE)", "sla_adherence")},
  {r(f"quantile_cont({cycle}, 0.5) / {H}", "median_cycle_hours")}
FROM {source} GROUP BY {grouping or by}"""


RUNS = """rn AS (SELECT ts, event_id AS run_id,
  CASE WHEN event_type = 'error' THEN 'failure' ELSE 'success' END AS status,
  value / 20 AS duration_seconds, CAST(floor(value * 2500) AS BIGINT) AS events_loaded,
  user_id AS cases_loaded, least(1.0, value / 60) AS sla_adherence,
  'worker-' || (user_id % 4) AS instance FROM events)"""

COUNTERS = f"""{RUNS}, ct AS (SELECT instance, ts, run_id,
  count(*) FILTER (status = 'failure') OVER w AS failures, count(*) OVER w AS total,
  {", ".join(f"count(*) FILTER (duration_seconds <= {b!r}) OVER w AS b{i}"
             for i, b in enumerate(DURATION_BUCKETS))}
  FROM rn WINDOW w AS (PARTITION BY instance, date_trunc('day', ts) ORDER BY ts, run_id
    ROWS UNBOUNDED PRECEDING))"""


def grown(name: str) -> str:
    before = f"lag({name}) OVER w"
    return f"CASE WHEN {before} IS NULL THEN 0 WHEN {name} < {before} THEN {name} ELSE {name} - {before} END"


def increase_sql() -> str:
    return f"""{COUNTERS}, gr AS (SELECT instance, date_trunc('minute', ts) AS tm,
  {grown("failures")} AS g FROM ct WINDOW w AS (PARTITION BY instance ORDER BY ts, run_id)),
inc AS (SELECT instance, tm + to_minutes(k) AS window_end, sum(g) AS increase
  FROM gr, range(1, 16) AS r(k) GROUP BY 1, 2 HAVING sum(g) > 0)"""


def counter_quantile_sql() -> str:
    n = len(DURATION_BUCKETS)
    # A restart shows in the total as well as in the buckets.
    names = [*(f"b{i}" for i in range(n)), "total"]
    reset = " OR ".join(f"{x} < lag({x}) OVER w" for x in names)
    steps = ", ".join(
        f"CASE WHEN lag({x}) OVER w IS NULL THEN 0 WHEN {reset} THEN {x}"
        f" ELSE {x} - lag({x}) OVER w END AS {x}" for x in names)
    whens, lower, under = [], "0.0", "0"
    for i, b in enumerate(DURATION_BUCKETS):
        whens.append(f"WHEN b{i} >= total * 0.95 THEN {lower} + ({b!r} - {lower})"
                     f" * (total * 0.95 - {under}) / (b{i} - {under})")
        lower, under = repr(b), f"b{i}"
    sums = ", ".join(f"CAST(sum({x}) AS BIGINT) AS {x}" for x in names)
    return f"""WITH {COUNTERS}, gr AS (SELECT date_trunc('minute', ts) AS tm, {steps}
  FROM ct WINDOW w AS (PARTITION BY instance ORDER BY ts, run_id)),
s AS (SELECT tm + to_minutes(k) AS window_end, {sums} FROM gr, range(1, 16) AS r(k) GROUP BY 1)
SELECT {iso("window_end")} AS window_end, total AS runs,
  {r(f"CASE {' '.join(whens)} ELSE {DURATION_BUCKETS[-1]!r} END", "duration_quantile")}
FROM s WHERE total > 0"""


def constraint_sql() -> str:
    def rows(table, kind, columns, sql):
        return (f"SELECT '{table}' AS \"table\", '{kind}' AS kind, '{columns}' AS columns,"
                f" CAST(({sql}) AS BIGINT) AS violations")

    source = {"process_cases": "oc", "process_events": "ev"}
    held = {"oc": ["case_id", "created_at", "completed_at", "vendor_tier", "priority", "amount_usd",
                   "event_count", "rework_count", "cycle_time_hours", "sla_target_hours",
                   "sla_breached"],
            "ev": ["case_id", "event_index", "activity", "tm", "part", "amount_usd", "automated",
                   "processing_minutes", "resource_id", "resource_role"]}
    parts = []
    for table, short in source.items():
        for name in held[short]:
            if name in ("part",):
                continue
            column = {"resource_id": "'S'", "resource_role": "'Supplier'"}.get(name, name)
            parts.append(rows(table, "not null", {"tm": "timestamp"}.get(name, name),
                              f"SELECT count(*) FROM {short} WHERE {column} IS NULL"))
    for table, kind, columns, condition in SCHEMA_CONSTRAINTS:
        if kind == "check":
            parts.append(rows(table, kind, columns[0],
                              f"SELECT count(*) FROM {source[table]} WHERE NOT ({condition})"))
    for table, kind, keys in (("process_cases", "primary key", "case_id"),
                              ("process_events", "primary key", "case_id, event_index"),
                              ("process_events", "unique", "case_id, part")):
        parts.append(rows(table, kind, keys,
                          f"SELECT count(*) - count(DISTINCT ({keys})) FROM {source[table]}"))
    for table, other in (("process_cases", "ev"), ("process_events", "oc")):
        parts.append(rows(table, "foreign key", "case_id",
                          f"SELECT count(*) FROM {source[table]} WHERE case_id NOT IN"
                          f" (SELECT case_id FROM {other})"))
    return f"WITH {LINES}, {ORDER_CASES} {' UNION ALL '.join(parts)}"


def hold_sql(value: str, threshold: float, minutes: int, by: str = "") -> str:
    key, part = (f"{by}, ", f"PARTITION BY {by}") if by else ("", "")
    return f"""WITH {RUNS}, n AS (SELECT *, row_number() OVER (PARTITION BY
    {key}date_trunc('minute', ts) ORDER BY ts DESC, run_id DESC) AS newest FROM rn),
s AS (SELECT {key}date_trunc('minute', ts) AS tm, {value} AS v FROM n WHERE newest = 1),
f AS (SELECT *, v < {threshold} AS low FROM s),
g AS (SELECT *, row_number() OVER ({part} ORDER BY tm)
  - row_number() OVER (PARTITION BY {key}low ORDER BY tm) AS island FROM f)
SELECT {key}{iso("min(tm)")} AS low_from, {iso("max(tm)")} AS low_to, count(*) AS scrapes,
  {r("min(v)", "lowest") if value == "sla_adherence" else "min(v) AS lowest"}
FROM g WHERE low GROUP BY {key}island HAVING epoch(max(tm)) - epoch(min(tm)) >= {minutes * 60}"""


def duration_sql() -> str:
    below = [f"count(*) FILTER (duration_seconds <= {b!r})" for b in DURATION_BUCKETS]
    whens, lower, under = [], "0.0", "0"
    for i, b in enumerate(DURATION_BUCKETS):
        whens.append(
            f"WHEN c{i} >= n * 0.95 THEN {lower} + ({b!r} - {lower}) * (n * 0.95 - {under})"
            f" / (c{i} - {under})"
        )
        lower, under = repr(b), f"c{i}"
    counts = ", ".join(f"{c} AS c{i}" for i, c in enumerate(below))
    return f"""WITH {RUNS}, w AS (SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS start,
  count(*) AS n, {counts} FROM rn GROUP BY 1)
SELECT {iso("start")} AS window_start, n AS runs,
  {r(f"CASE {' '.join(whens)} ELSE {DURATION_BUCKETS[-1]!r} END", "duration_quantile")} FROM w"""


def drift_sql() -> str:
    parts = []
    for d in ("activity", "source_system"):
        parts.append(f"""SELECT '{d}' AS dimension, {d} AS label,
  count(*) FILTER (cur) / CAST((SELECT count(*) FROM e WHERE cur) AS DOUBLE) AS now,
  count(*) FILTER (NOT cur) / CAST((SELECT count(*) FROM e WHERE NOT cur) AS DOUBLE) AS then_
  FROM e GROUP BY 2""")
    return f"""WITH {click('day')}, e AS (SELECT *, tm >= TIMESTAMP '2024-01-16' AS cur FROM ev),
u AS ({' UNION ALL '.join(parts)})
SELECT dimension, label, {r("now", "current_share")}, {r("then_", "prior_share")},
  {r("now - then_", "share_delta")} FROM u"""


def oracle_queries() -> dict[str, str]:
    from tracewright.plans.queries import CLICK_STAGES, REPLICATIONS, TEXT_SECRETS

    day, week, wcs = click("day"), click("week"), click_cases("week")
    risk = f"{ORDERS}, {ORDER_FEATURES}, {SCORED}"
    day_cf = f"{day}, {conform(CLICK_IDEAL)}"
    scen = f"{week}, {wcs}, {LINKED}, {scenario_ctes(CLICK_STAGES, REPLICATIONS)}"
    slicers = "business_unit, country, vendor_tier, priority"
    enriched = f"""{week}, {wcs}, {conform(CLICK_IDEAL)}, {PERFORMANCE},
en AS (SELECT cs.*, fitness, conformant, touch_time_hours, estimated_wait_hours,
  automation_rate FROM cs LEFT JOIN cf USING (case_id) LEFT JOIN pf USING (case_id))"""
    secret = " UNION ALL ".join(
        f"SELECT {lit(label)} AS label, count(*) FILTER (regexp_matches(text, {lit(p)}))"
        " AS finding_count, count(*) AS scanned FROM documents"
        for label, p in TEXT_SECRETS.items()
    )
    findings = " UNION ALL ".join(
        f"SELECT doc_id AS doc, {lit(label)} AS label FROM documents"
        f" WHERE regexp_matches(text, {lit(p)})"
        for label, p in TEXT_SECRETS.items()
    )
    null_rows = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count,"
        f" count(*) FILTER (trim(CAST({c} AS VARCHAR)) = '') AS blank_count FROM oc"
        for c in ("case_id", "created_at", "completed_at", "priority", "event_count")
    )
    variant_cols = "variant_rank, variant, activity_count, case_count, "
    variant_cols += r("case_share", "case_share")
    seg = " UNION ALL ".join(
        f"SELECT '{d}' AS dimension, {s}.{d} AS member, cs.case_id, cs.sla_breached, st.wait_us"
        " FROM cs LEFT JOIN st ON st.case_id = cs.case_id"
        for d, s in (("business_unit", "cs"), ("priority", "cs"), ("vendor_tier", "cs"),
                     ("activity", "st"), ("resource_role", "st"))
    )
    bands = " UNION ALL ".join(
        f"SELECT {i} AS band_order, '{name}' AS risk_band, count(*) FILTER ({cond}) AS case_count,"
        f" round(count(*) FILTER ({cond}) / CAST(greatest(count(*), 1) AS DOUBLE), 4)"
        " AS case_share FROM sp"
        for i, (name, cond) in enumerate((
            ("Low", "risk_score <= 0.30"),
            ("Medium", "risk_score > 0.30 AND risk_score <= 0.60"),
            ("High", "risk_score > 0.60 AND risk_score <= 0.80"),
            ("Critical", "risk_score > 0.80")), start=1)
    )
    out = {
        # data quality
        "dq_summary": f"""WITH {day}, {SEQ} SELECT count(*) AS event_count,
  count(DISTINCT case_id) AS case_count, count(DISTINCT activity) AS activity_count,
  count(DISTINCT resource_id) AS resource_count,
  (SELECT count(DISTINCT variant) FROM sq) AS variant_count,
  {iso("min(tm)")} AS start_timestamp, {iso("max(tm)")} AS end_timestamp,
  count(*) - count(DISTINCT (case_id, event_index)) AS duplicate_case_event_keys,
  count(*) FILTER (case_id IS NULL) + count(*) FILTER (activity IS NULL)
    + count(*) FILTER (tm IS NULL) AS null_required_fields FROM ev""",
        "dq_violations": f"""WITH {LINES}, k AS (SELECT case_id, event_index FROM ev
  GROUP BY 1, 2 HAVING count(*) > 1)
SELECT count(*) AS row_count, (SELECT count(*) FROM k) AS duplicate_keys,
  count(*) FILTER (case_id IS NULL OR activity IS NULL) AS null_keys,
  count(*) FILTER (tm IS NULL) AS bad_timestamp,
  count(*) FILTER (event_index IS NULL) AS bad_event_index,
  count(*) FILTER (amount_usd IS NULL OR processing_minutes IS NULL) AS bad_numbers,
  count(*) FILTER (amount_usd < 0 OR processing_minutes < 0) AS negative_numbers,
  count(*) FILTER (lower(automated) NOT IN ('true','false','1','0')) AS bad_flag FROM ev""",
        "dq_case_violations": f"""WITH {ORDER_CASES}
SELECT count(*) AS row_count, count(*) - count(DISTINCT case_id) AS duplicate_keys,
  count(*) FILTER (created_at IS NULL) AS bad_created_at,
  count(*) FILTER (completed_at IS NULL) AS bad_completed_at,
  count(*) FILTER (completed_at < created_at) AS completed_first,
  count(*) FILTER (amount_usd IS NULL OR event_count IS NULL OR rework_count IS NULL
    OR cycle_time_hours IS NULL OR sla_target_hours IS NULL) AS bad_numbers,
  count(*) FILTER (amount_usd < 0 OR event_count < 0 OR rework_count < 0
    OR cycle_time_hours < 0 OR sla_target_hours < 0) AS negative_numbers,
  count(*) FILTER (sla_breached IS NULL) AS bad_flag FROM oc""",
        "dq_duplicate_keys": f"""WITH {LINES} SELECT case_id, event_index,
  count(*) AS row_count FROM ev GROUP BY 1, 2 HAVING count(*) > 1""",
        "dq_null_required": f"WITH {ORDER_CASES} {null_rows}",
        "dq_ts_regression": f"""WITH {LINES}, l AS (SELECT *, lag(tm) OVER (PARTITION BY case_id
  ORDER BY event_index, part, tm) AS prev FROM ev)
SELECT case_id, event_index, {iso("tm")} AS timestamp, {iso("prev")} AS previous_timestamp
FROM l WHERE tm < prev""",
        "dq_case_reconcile": """SELECT CAST(o_orderkey AS VARCHAR) AS case_id,
  'events' AS missing_from FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
UNION ALL SELECT DISTINCT CAST(l_orderkey AS VARCHAR), 'cases' FROM lineitem
  WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)""",
        "dq_count_reconcile": """SELECT CAST(l_orderkey AS VARCHAR) AS case_id,
  count(*) AS observed, max(l_linenumber) AS declared FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders)
GROUP BY l_orderkey HAVING count(*) <> max(l_linenumber)""",
        "dq_constraints": constraint_sql(),
        "dq_domain": f"""WITH {ORDER_CASES} SELECT
  count(*) FILTER (vendor_tier NOT IN ('A','B','C')) AS vendor_tier,
  count(*) FILTER (priority NOT IN ('Urgent','Standard','Strategic')) AS priority,
  count(*) FILTER (event_count <= 0) AS event_count,
  count(*) FILTER (rework_count < 0) AS rework_count,
  count(*) FILTER (amount_usd < 0) AS amount_usd,
  count(*) FILTER (cycle_time_hours < 0) AS cycle_time_hours,
  count(*) FILTER (sla_target_hours <= 0) AS sla_target_hours FROM oc""",
        "dq_text_violations": """WITH k AS (SELECT l_orderkey,
    CASE l_returnflag WHEN 'R' THEN NULL ELSE l_linenumber END AS i, count(*) AS n
  FROM lineitem GROUP BY 1, 2)
SELECT count(*) AS row_count, (SELECT count(*) FROM k WHERE n > 1) AS duplicate_keys,
  0 AS null_keys, count(*) FILTER (l_returnflag = 'A') AS bad_timestamp,
  count(*) FILTER (l_returnflag = 'R') AS bad_event_index,
  count(*) FILTER (l_linestatus = 'O') AS bad_numbers, 0 AS negative_numbers,
  count(*) FILTER (l_linestatus <> 'F') AS bad_flag FROM lineitem""",
        "dq_golden": f"""WITH m AS (
  SELECT 'orders' AS metric, (SELECT count(*) FROM orders) AS expected,
    (SELECT count(*) FROM orders) AS value
  UNION ALL SELECT 'lines', (SELECT sum(n) FROM (SELECT max(l_linenumber) AS n FROM lineitem
    GROUP BY l_orderkey)), (SELECT count(*) FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
  UNION ALL SELECT 'order_value',
    (SELECT CAST(sum(CAST(o_totalprice AS DECIMAL(14,2))) AS DOUBLE) FROM orders),
    (SELECT CAST(sum(CAST(l_extendedprice AS DECIMAL(14,2))) AS DOUBLE)
     FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
  UNION ALL SELECT 'closed_orders', (SELECT count(*) FROM orders WHERE o_orderstatus = 'F'),
    (SELECT count(*) FROM orders WHERE o_orderstatus = 'F'))
SELECT metric, {r("CAST(expected AS DOUBLE)", "expected")}, {r("CAST(value AS DOUBLE)", "value")},
  CAST(0.0001 AS DOUBLE) AS tolerance, abs(value - expected) <= 0.0001 AS passed FROM m""",
        "dq_secret_scan": secret,
        "dq_secret_findings": findings,
        # discovery
        "variants": f"WITH {day}, {VARIANTS} SELECT {variant_cols} FROM vr",
        "variant_coverage": f"""WITH {day}, {VARIANTS} SELECT variant_rank, case_count,
  {r("cumulative_share", "cumulative_share")} FROM vr""",
        "variants_conversations": f"""WITH {CHAT}, {VARIANTS} SELECT {variant_cols},
  {r("cumulative_share", "cumulative_share")} FROM vr""",
        "variants_orders": f"""WITH {ORDERS}, {VARIANTS} SELECT {variant_cols},
  {r("cumulative_share", "cumulative_share")} FROM vr""",
        "case_sequences": f"""WITH {day} SELECT case_id, activity, CAST(row_number() OVER
  (PARTITION BY case_id ORDER BY tm, event_index, activity) AS BIGINT) AS position FROM ev""",
        "variant_steps": f"""WITH {day}, {SEQ}, f AS (SELECT variant, min(case_id) AS case_id
  FROM sq GROUP BY 1), u AS (SELECT f.variant, unnest(steps) AS activity,
  generate_subscripts(steps, 1) AS position FROM f JOIN sq USING (case_id))
SELECT variant, CAST(position AS BIGINT) AS position, activity FROM u""",
        "dfg": f"WITH {day}, {LINKED} {dfg_select()}",
        "dfg_orders": f"WITH {ORDERS}, {LINKED} {dfg_select()}",
        "dfg_view": f"""WITH {day}, {LINKED} SELECT previous_activity AS source_activity,
  activity AS target_activity, count(*) AS transition_count,
  {r(f"sum(wait_us) / CAST(count(*) AS DOUBLE) / {H}", "mean_wait_hours", 2)}
FROM st GROUP BY 1, 2""",
        "activity_summary": f"""WITH {day} SELECT activity, count(*) AS event_count,
  count(DISTINCT case_id) AS case_count,
  {r("avg(CAST(automated AS INTEGER))", "automation_rate")},
  {r("sum(touch_us) / CAST(count(*) AS DOUBLE) / 60000000.0", "mean_processing_minutes")},
  {r("quantile_cont(touch_us, 0.5) / 60000000.0", "median_processing_minutes")},
  {r("count(DISTINCT case_id) / CAST((SELECT count(DISTINCT case_id) FROM ev) AS DOUBLE)",
     "case_coverage")} FROM ev GROUP BY activity""",
        "activity_view": f"""WITH {day} SELECT activity, count(*) AS event_count,
  count(DISTINCT case_id) AS case_count,
  {r("sum(touch_us) / CAST(count(*) AS DOUBLE) / 60000000.0", "mean_processing_minutes", 2)},
  {r("avg(CASE WHEN automated THEN 1.0 ELSE 0.0 END)", "automation_rate", 4)}
FROM ev GROUP BY activity""",
        "start_end_activities": f"""WITH {day}, {SEQ}, e AS (
  SELECT 'start' AS position, steps[1] AS activity FROM sq
  UNION ALL SELECT 'end', steps[len(steps)] FROM sq)
SELECT position, activity, count(*) AS case_count FROM e GROUP BY 1, 2""",
        "dfg_sample": f"""WITH {day}, ids AS (SELECT DISTINCT case_id FROM ev ORDER BY case_id
  LIMIT 2000), {LINKED}
SELECT (SELECT count(*) FROM ids) AS sample_cases,
  count(DISTINCT (previous_activity, activity)) AS dfg_edges FROM st
WHERE case_id IN (SELECT case_id FROM ids)""",
        "log_format": f"""WITH {day} SELECT case_id AS "case:concept:name",
  activity AS "concept:name", {iso("tm")} AS "time:timestamp", resource_id FROM ev""",
        "footprint": f"""WITH {ORDERS}, {LINKED}, e AS (SELECT previous_activity AS source,
  activity AS target, count(*) AS n FROM st GROUP BY 1, 2),
pairs AS (SELECT source, target FROM e UNION SELECT target, source FROM e)
SELECT p.source, p.target, coalesce(f.n, 0) AS forward_count, coalesce(g.n, 0) AS backward_count,
  CASE WHEN g.n IS NULL THEN '->' WHEN f.n IS NULL THEN '<-' ELSE '||' END AS relation
FROM pairs p LEFT JOIN e f ON f.source = p.source AND f.target = p.target
LEFT JOIN e g ON g.source = p.target AND g.target = p.source""",
        "model_edge_check": f"""WITH RECURSIVE {ORDERS}, {LINKED}, {model_ctes()},
e AS (SELECT previous_activity AS source, activity AS target, count(*) AS n
  FROM st GROUP BY 1, 2)
SELECT coalesce(e.source, m.source) AS source, coalesce(e.target, m.target) AS target,
  coalesce(n, 0) AS transition_count, CASE WHEN m.source IS NULL THEN 'log_only'
    WHEN n IS NULL THEN 'model_only' ELSE 'both' END AS status
FROM e FULL JOIN m ON e.source = m.source AND e.target = m.target""",
        "activity_drift": drift_sql(),
        # conformance
        "conformance_cases": f"""WITH {day_cf} SELECT case_id, {r("fitness", "fitness")},
  edit_distance, conformant, array_to_string(missing, ' | ') AS missing_activities,
  array_to_string(unexpected, ' | ') AS unexpected_activities,
  array_to_string(repeated, ' | ') AS repeated_activities FROM cf""",
        "deviations": dev(CLICK_IDEAL).replace("src", day, 1),
        "deviations_orders": dev(ORDER_IDEAL).replace("src", ORDERS, 1),
        "fitness_histogram": f"""WITH {day_cf} SELECT
  least(floor(fitness * 10 + 1e-9), 9) / 10 AS fitness_from, count(*) AS case_count
FROM cf GROUP BY 1""",
        "conformance_split": f"""WITH {day_cf} SELECT
  count(*) FILTER (conformant) AS conformant_cases,
  count(*) FILTER (NOT conformant) AS nonconformant_cases FROM cf""",
        "reordered_cases": f"""WITH {day_cf} SELECT case_id, {r("fitness", "fitness")},
  edit_distance FROM cf WHERE edit_distance > 0 AND len(missing) = 0 AND len(unexpected) = 0
  AND len(repeated) = 0""",
        "trace_distances": f"""WITH {day}, sq AS (SELECT case_id, string_agg({case_of(
            "activity", {a: lit(chr(65 + i)) for i, a in enumerate(CLICK_KINDS)}, "NULL")}, ''
    ORDER BY tm, event_index) AS code FROM ev GROUP BY case_id),
pr AS (SELECT case_id, code, lag(case_id) OVER w AS previous_case, lag(code) OVER w AS before FROM sq
  WINDOW w AS (PARTITION BY split_part(case_id, '|', 1) ORDER BY split_part(case_id, '|', 2)))
SELECT case_id, previous_case, CAST(levenshtein(code, before) AS INTEGER) AS edit_distance,
  {r("1 - levenshtein(code, before) / CAST(greatest(len(code), len(before)) AS DOUBLE)", "fitness")}
FROM pr WHERE previous_case IS NOT NULL""",
        # performance
        "transition_waits": f"""WITH {week}, {LINKED} SELECT case_id, previous_activity, activity,
  {r(f"wait_us / {H}", "wait_hours")}, resource_role, business_unit, department FROM st""",
        "bottlenecks": f"WITH {week}, {LINKED}, {BOTTLENECK} {BOTTLENECK_SELECT}",
        "bottlenecks_orders": f"WITH {ORDERS}, {LINKED}, {BOTTLENECK} {BOTTLENECK_SELECT}",
        "case_performance": f"""WITH {week}, {PERFORMANCE} SELECT case_id,
  {iso("created_at")} AS created_at, {iso("completed_at")} AS completed_at, event_count,
  unique_activity_count, {r("touch / 60000000.0", "processing_minutes")}, automated_event_count,
  {r("cycle_time_hours", "cycle_time_hours")}, {r("touch_time_hours", "touch_time_hours")},
  {r("estimated_wait_hours", "estimated_wait_hours")}, rework_event_count,
  {r("automation_rate", "automation_rate")} FROM pf""",
        "rework": f"""WITH {week}, c AS (SELECT case_id, activity, count(*) AS n FROM ev
  GROUP BY 1, 2 HAVING count(*) > 1)
SELECT activity, count(*) AS affected_cases, CAST(sum(n - 1) AS BIGINT) AS repeat_events,
  {r("avg(n)", "mean_occurrences")} FROM c GROUP BY 1""",
        "resource_workload": f"""WITH {week} SELECT resource_id, resource_role,
  count(*) AS event_count, count(DISTINCT case_id) AS case_count,
  {r(f"sum(touch_us) / {H}", "processing_hours")},
  {r("avg(CAST(automated AS INTEGER))", "automated_rate")},
  {r("sum(touch_us) / CAST((SELECT sum(touch_us) FROM ev) AS DOUBLE)", "workload_share")}
FROM ev GROUP BY 1, 2""",
        "sla_consumption": f"""WITH {wcs} SELECT case_id, business_unit, department, vendor_id,
  vendor_tier, priority, amount_usd, variant_ground_truth, event_count, rework_count,
  {r("cycle_time_hours", "cycle_time_hours")}, sla_target_hours, sla_breached,
  round(cycle_time_hours / nullif(sla_target_hours, 0), 4) AS sla_consumption_ratio FROM cs""",
        "sla_monthly": f"""WITH {ORDERS}, x AS (SELECT *,
  CAST(round(cycle_time_hours * 3600000000.0) AS BIGINT) AS us FROM cs)
SELECT {iso("date_trunc('month', completed_at)")} AS completed_month, business_unit, priority,
  count(*) AS case_count,
  {r("avg(CASE WHEN sla_breached THEN 0.0 ELSE 1.0 END)", "sla_adherence", 4)},
  {r(f"sum(us) / CAST(count(*) AS DOUBLE) / {H}", "mean_cycle_hours", 2)},
  {r(f"quantile_cont(us, 0.9) / {H}", "p90_cycle_hours", 2)}
FROM x GROUP BY date_trunc('month', completed_at), business_unit, priority""",
        "top_wait_transitions": f"""WITH {day}, {LINKED}, v AS (SELECT
  previous_activity AS source_activity, activity AS target_activity,
  count(*) AS transition_count,
  {r(f"sum(wait_us) / CAST(count(*) AS DOUBLE) / {H}", "mean_wait_hours", 2)}
  FROM st GROUP BY 1, 2)
SELECT * FROM v ORDER BY mean_wait_hours * transition_count DESC, source_activity,
  target_activity LIMIT 15""",
        "bu_sla_gap": f"""WITH {wcs} SELECT business_unit, count(*) AS cases,
  {r("avg(CASE WHEN sla_breached THEN 0.0 ELSE 1.0 END)", "sla_adherence", 4)},
  {r(f"sum(cycle_us) / CAST(count(*) AS DOUBLE) / {H}", "mean_cycle_hours", 2)}
FROM cs GROUP BY 1""",
        "rework_concentration": f"""WITH {wcs} SELECT variant_ground_truth, count(*) AS cases,
  CAST(sum(rework_count) AS BIGINT) AS repeat_events FROM cs WHERE rework_count > 0
GROUP BY 1""",
        "case_enriched": f"""WITH {enriched} SELECT case_id, {iso("created_at")} AS created_at,
  {iso("completed_at")} AS completed_at, business_unit, department, country, vendor_id,
  vendor_tier, material_category, amount_usd, priority, channel, variant_ground_truth,
  event_count, rework_count, {r("cycle_time_hours", "cycle_time_hours")}, sla_target_hours,
  sla_breached, {r("fitness", "fitness")}, conformant,
  {r("touch_time_hours", "touch_time_hours")},
  {r("estimated_wait_hours", "estimated_wait_hours")},
  {r("automation_rate", "automation_rate")} FROM en""",
        "kpis": f"WITH {week}, {wcs}, {conform(CLICK_IDEAL)}, {PERFORMANCE} {kpi_select()}",
        "kpis_orders": f"WITH {ORDERS}, {conform(ORDER_IDEAL)}, {PERFORMANCE} {kpi_select()}",
        "case_explorer": f"""WITH {week}, {wcs}, {conform(CLICK_IDEAL)}, {SEQ}
SELECT case_id, business_unit, country, vendor_tier, priority, amount_usd,
  {r("cycle_time_hours", "cycle_time_hours")}, sla_target_hours, sla_breached,
  {r("fitness", "fitness")}, conformant, CAST(edit_distance AS INTEGER) AS edit_distance,
  variant FROM cs LEFT JOIN cf USING (case_id) LEFT JOIN sq USING (case_id)""",
        "case_timeline": f"""WITH {week}, {wcs}, n AS (SELECT *, row_number() OVER
  (PARTITION BY case_id ORDER BY tm, event_index, activity) AS position FROM ev)
SELECT case_id, activity, {iso("tm")} AS timestamp, resource_id,
  {r("amount_usd", "processing_minutes")}, CAST(position AS BIGINT) AS position FROM n
WHERE case_id IN (SELECT case_id FROM cs)""",
        "segment_sla": f"""WITH {week}, {wcs}, {LINKED}, a AS ({seg}),
p AS (SELECT dimension, member, case_id, max(CAST(sla_breached AS INTEGER)) AS breached,
  sum(wait_us) AS wait_us FROM a WHERE member IS NOT NULL GROUP BY 1, 2, 3)
SELECT dimension, member, count(*) AS case_count,
  {r("avg(CASE WHEN breached = 1 THEN 0.0 ELSE 1.0 END)", "sla_adherence")},
  {r(f"coalesce(sum(wait_us), 0) / {H}", "total_wait_hours")} FROM p GROUP BY 1, 2""",
        "breach_transitions": f"""WITH {week}, {wcs}, {LINKED}
SELECT previous_activity AS source, activity AS target, count(*) AS transition_count,
  {r(f"sum(wait_us) / {H}", "total_wait_hours")} FROM st
WHERE case_id IN (SELECT case_id FROM cs WHERE sla_breached) GROUP BY 1, 2""",
        # SLA risk
        "sla_features": f"""WITH {ORDERS}, {ORDER_FEATURES} {CASES_SELECT},
  {iso("po_created_at")} AS po_created_at, {r("elapsed_to_po_hours", "elapsed_to_po_hours")},
  early_event_count, approval_count, early_rework_count,
  {r("early_manual_minutes", "early_manual_minutes")} FROM ft""",
        "sla_features_clicks": f"""WITH {week}, {wcs},
{features("purchase", "view", "error", "touch_us")} SELECT case_id,
  {iso("po_created_at")} AS po_created_at, {r("elapsed_to_po_hours", "elapsed_to_po_hours")},
  early_event_count, approval_count, early_rework_count,
  {r("early_manual_minutes", "early_manual_minutes")} FROM ft""",
        "temporal_split": f"""WITH {ORDERS} SELECT case_id, {iso("created_at")} AS created_at,
  row_number() OVER (ORDER BY created_at, case_id)
    <= greatest(1, least(count(*) OVER () - 1, CAST(floor(count(*) OVER () * 0.8) AS BIGINT)))
    AS is_train FROM cs""",
        "baseline_metrics": f"""WITH {risk}, {rank_sql("vendor_tier")}, {threshold_sql("vendor_tier")}
SELECT th.*, {r("roc_auc", "roc_auc")}, {r("average_precision", "average_precision")}
FROM th JOIN rk USING (vendor_tier)""",
        "baseline_metrics_total": f"""WITH {risk}, {rank_sql(None)}
SELECT {r("roc_auc", "roc_auc")}, {r("average_precision", "average_precision")} FROM rk""",
        "baseline_bands": f"WITH {risk} {bands}",
        "rule_scores": f"""WITH {risk} SELECT case_id, {iso("created_at")} AS created_at,
  business_unit, vendor_id, amount_usd, sla_breached, risk_score, predicted_breach, risk_band,
  priority, vendor_tier, country FROM sp""",
        "rule_queue": f"""WITH {risk} SELECT case_id, business_unit, vendor_id, amount_usd,
  risk_score, risk_band FROM sp WHERE risk_band IN ('High', 'Critical')""",
        "rule_subgroups": f"""WITH {risk}, sd AS ({" UNION ALL ".join(
            f"SELECT '{d}' AS dimension, {m} AS member, sla_breached, predicted_breach, risk_score"
            " FROM sp" for d, m in (
                ("priority", "priority"), ("vendor_tier", "vendor_tier"),
                ("business_unit", "business_unit"),
                ("created_month", "strftime(created_at, '%Y-%m')")))}),
{rank_sql("dimension, member", "sd")}, {threshold_sql("dimension, member", "sd")}
SELECT th.*, {r("roc_auc", "roc_auc")}, {r("average_precision", "average_precision")}
FROM th JOIN rk USING (dimension, member)""",
        "rule_measures": f"""WITH {risk} SELECT business_unit, count(*) AS scored_cases,
  count(*) FILTER (risk_band IN ('High', 'Critical')) AS high_risk_cases,
  {r("avg(risk_score)", "average_risk_score")},
  {r("count(*) FILTER (risk_band IN ('High', 'Critical')) / CAST(count(*) AS DOUBLE)",
     "high_risk_share")} FROM sp GROUP BY 1""",
        "rule_transitions": f"""WITH {risk}, {LINKED}
SELECT previous_activity AS source, activity AS target, count(*) AS transition_count,
  {r(f"sum(wait_us) / {H}", "total_wait_hours")} FROM st
WHERE case_id IN (SELECT case_id FROM sp WHERE risk_band IN ('High', 'Critical')) GROUP BY 1, 2""",
        # scenarios and the order process
        "whatif_observed": f"WITH {scen} SELECT * FROM wi",
        "scenario_outcomes": f"""WITH {scen} SELECT catalog_index, scenario, replication, cases,
  {", ".join(r(c, c) for c in ("mean_cycle_hours", "median_cycle_hours", "p90_cycle_hours",
    "sla_adherence", "manual_hours_per_case", "throughput_cases_per_8h"))} FROM ro""",
        "scenario_compare": f"""WITH {scen} SELECT catalog_index, scenario, description,
  {", ".join(r(c, c, 4) for c in ("one_time_investment_usd", "mean_cycle_hours",
    "median_cycle_hours", "p90_cycle_hours", "sla_adherence", "manual_hours_per_case",
    "throughput_cases_per_8h", "cycle_time_reduction_pct", "sla_adherence_uplift_pp",
    "manual_hours_saved_per_case", "estimated_annual_value_usd", "first_year_roi"))}
FROM cmp""",
        "scenario_recommendation": f"""WITH {scen} SELECT scenario AS recommended_scenario,
  {r("cycle_time_reduction_pct", "recommended_cycle_reduction_pct", 4)},
  {r("sla_adherence_uplift_pp", "recommended_sla_uplift_pp", 2)},
  {r("estimated_annual_value_usd", "estimated_annual_value_usd", 2)},
  {r("first_year_roi", "first_year_roi", 4)} FROM cmp
ORDER BY cmp.estimated_annual_value_usd DESC, catalog_index DESC LIMIT 1""",
        "scenario_measures": f"""WITH {scen} SELECT scenario,
  {r("mean_cycle_hours", "scenario_cycle_hours", 4)}, {r("sla_adherence", "scenario_sla", 4)},
  {r("estimated_annual_value_usd", "annual_value", 4)},
  {r("estimated_annual_value_usd", "annual_value_max", 4)},
  {r("first_year_roi", "first_year_roi", 4)},
  {r("1 - mean_cycle_hours / (SELECT mean_cycle_hours FROM b)",
     "cycle_improvement_vs_baseline", 4)},
  {r("100 * (sla_adherence - (SELECT sla_adherence FROM b))", "sla_uplift_vs_baseline_pp", 4)}
FROM cmp""",
        "order_process": f"WITH {ORDERS} {CASES_SELECT} FROM cs",
        "order_activities": f"""WITH {ORDERS} SELECT activity, resource_role, source_system,
  business_unit, count(*) AS event_count,
  {r("CAST(sum(CAST(amount_usd AS DECIMAL(14,2))) AS DOUBLE)", "amount_usd")},
  {iso("min(tm)")} AS first_at, {iso("max(tm)")} AS last_at FROM ev GROUP BY 1, 2, 3, 4""",
        # measures
        "measures_by_slicer": "WITH " + enriched + " " + measure_select(
            "en", slicers,
            "count(*) FILTER (conformant) AS conformant_cases, "
            + r("avg(fitness)", "conformance_fitness") + ", "
            + r("avg(automation_rate)", "automation_share") + ", "
            + r("count(*) FILTER (conformant) / CAST(count(*) AS DOUBLE)", "straight_through")
            + ",",
        ),
        "measures_rollup": f"WITH {wcs} "
        + measure_select("cs", slicers, grouping=f"ROLLUP ({slicers})"),
        "measures_cube": f"WITH {wcs} "
        + measure_select("cs", slicers, grouping=f"CUBE ({slicers})"),
        "process_measures": f"""WITH {day}, {LINKED}, {BOTTLENECK}, {VARIANTS}
SELECT {r("sum(total_wait_hours)", "total_wait_hours")},
  {r("max(bottleneck_score)", "top_bottleneck_score")},
  (SELECT max(case_count) FROM vr) AS top_variant_cases,
  round((SELECT max(case_share) FROM vr), 6) AS top_variant_share FROM bn""",
        # monitoring
        "runs_by_window": f"""WITH {RUNS} SELECT {iso("date_trunc('hour', ts)")} AS window_start,
  {iso("date_trunc('hour', ts) + INTERVAL 1 HOUR")} AS window_end, status, count(*) AS runs
FROM rn GROUP BY date_trunc('hour', ts), status""",
        "alert_failures": f"""WITH {RUNS}, f AS (SELECT ts, lag(ts) OVER (ORDER BY ts) AS prev
  FROM rn WHERE status = 'failure'),
g AS (SELECT ts, sum(CASE WHEN prev IS NULL OR ts > prev + INTERVAL 15 MINUTE THEN 1 ELSE 0 END)
  OVER (ORDER BY ts ROWS UNBOUNDED PRECEDING) AS island FROM f)
SELECT {iso("min(ts)")} AS condition_start,
  {iso("max(ts) + INTERVAL 15 MINUTE")} AS condition_end, count(*) AS failures,
  {iso("min(ts) + INTERVAL 2 MINUTE")} AS fired_at FROM g GROUP BY island""",
        "alert_hold_volume": hold_sql("events_loaded", 100000, 10),
        "alert_hold_adherence": hold_sql("sla_adherence", 0.7, 30),
        "duration_p95": duration_sql(),
        "alert_hold_by_instance": hold_sql("sla_adherence", 0.7, 30, "instance"),
        "alert_low_sessions": f"""WITH {RUNS}, l AS (SELECT *, lag(ts) OVER (PARTITION BY instance
  ORDER BY ts) AS prev FROM rn WHERE sla_adherence < 0.7),
g AS (SELECT *, sum(CASE WHEN prev IS NULL OR ts >= prev + INTERVAL 1800 SECOND THEN 1 ELSE 0 END)
  OVER (PARTITION BY instance ORDER BY ts ROWS UNBOUNDED PRECEDING) AS island FROM l)
SELECT instance, {iso("min(ts)")} AS low_from, {iso("max(ts)")} AS low_to, count(*) AS samples,
  {r("min(sla_adherence)", "lowest")} FROM g GROUP BY instance, island
HAVING epoch_us(max(ts)) // 1000000 - epoch_us(min(ts)) // 1000000 >= 1800""",
        "counter_increase": f"""WITH {increase_sql()}
SELECT instance, {iso("window_end")} AS window_end, CAST(increase AS BIGINT) AS increase FROM inc""",
        "counter_alerts": f"""WITH {increase_sql()}, p AS (SELECT *, lag(window_end) OVER (
  PARTITION BY instance ORDER BY window_end) AS prev FROM inc),
g AS (SELECT *, sum(CASE WHEN prev = window_end - INTERVAL 1 MINUTE THEN 0 ELSE 1 END) OVER (
  PARTITION BY instance ORDER BY window_end ROWS UNBOUNDED PRECEDING) AS island FROM p)
SELECT instance, {iso("min(window_end)")} AS condition_start,
  {iso("max(window_end)")} AS condition_end, CAST(max(increase) AS BIGINT) AS highest,
  {iso("min(window_end) + INTERVAL 2 MINUTE")} AS fired_at FROM g GROUP BY instance, island
HAVING min(window_end) + INTERVAL 2 MINUTE <= max(window_end)""",
        "counter_p95": counter_quantile_sql(),
        "latest_gauges": f"""WITH {RUNS}, l AS (SELECT ts, events_loaded, cases_loaded,
  sla_adherence AS a FROM rn ORDER BY ts DESC, run_id DESC LIMIT 1)
SELECT {iso("ts")} AS ts, events_loaded, cases_loaded, {r("a", "sla_adherence")},
  CASE WHEN a < 0.7 THEN 'red' WHEN a < 0.85 THEN 'orange' ELSE 'green' END AS adherence_band
FROM l""",
    }
    labels = " UNION ALL ".join(
        f"SELECT DISTINCT '{c}_' || {c} AS feature FROM tr WHERE {c} IS NOT NULL"
        for c in CATEGORICAL_FEATURES)
    numbers = " UNION ALL ".join(f"SELECT '{c}' AS feature" for c in NUMERIC_FEATURES)
    out["fit_certificate"] = f"""WITH {ORDERS}, tr AS (SELECT *, row_number() OVER (
  ORDER BY created_at, case_id) AS place, count(*) OVER () AS n FROM cs
  QUALIFY place <= greatest(1, least(n - 1, CAST(floor(n * 0.8) AS BIGINT))))
SELECT feature, CAST(0 AS DOUBLE) AS gradient FROM ({numbers} UNION ALL {labels}) f"""
    out["report_process_map"] = out["dfg_orders"] + """
ORDER BY transition_count DESC, source, target LIMIT 20"""
    out["report_top_variants"] = out["variants_orders"] + " WHERE variant_rank <= 12"
    out["report_deviations"] = out["deviations_orders"] + """
ORDER BY case_count DESC, deviation_type, activity LIMIT 20"""
    out["report_workload"] = out["resource_workload"].replace(week, ORDERS) + """
ORDER BY sum(touch_us) DESC, resource_id, resource_role LIMIT 15"""
    changes = ", ".join(
        part for m in ("roc_auc", "average_precision") for part in (
            r(f"c.{m}", m), r(f"p.{m}", f"approved_{m}"), r(f"c.{m} - p.{m}", f"{m}_change"))
    )
    recent = SCORED.replace("SELECT *, risk_score >=",
                            "SELECT *, created_at >= TIMESTAMP '2000-01-01' AS recent, risk_score >=")
    out["baseline_changes"] = f"""WITH {ORDERS}, {ORDER_FEATURES}, {recent},
{rank_sql("vendor_tier, recent")}
SELECT vendor_tier, {changes} FROM (SELECT * FROM rk WHERE recent) c
JOIN (SELECT * FROM rk WHERE NOT recent) p USING (vendor_tier)"""
    out["sql_directly_follows"] = out["dfg_view"]
    out["sql_case_performance"] = out["sla_consumption"]
    out["sql_sla_by_country"] = f"""WITH {wcs} SELECT country, vendor_tier, count(*) AS cases,
  count(*) FILTER (sla_breached) AS breached FROM cs GROUP BY 1, 2"""
    return out
