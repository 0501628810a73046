"""Repair keys: bad-layer selection, rates, summaries and outcome classes.

Stand-ins: the bad layers of an order are its lines with return flag 'R'
(the critic's verdict), the plan is the order's lines with the part name as
layer prompt (parts larger than 45 have an empty prompt).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from atelier.operators import repair as RP
from atelier.scenarios import scenario
from atelier.scenarios.retrieval import _LINE_ORDER
from atelier.session import table

_K = "CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT)"
_ORDER_SQL = ", ".join(_LINE_ORDER)
_BAD_ORDER = ["l_linenumber", *_LINE_ORDER]


def _plan(spark, d):
    li = table(spark, d, "lineitem")
    part = table(spark, d, "part")
    j = li.join(part, F.col("p_partkey") == F.col("l_partkey"))
    prompt = F.when(F.col("p_size") > 45, F.lit("")).otherwise(F.col("p_name"))
    return j.select("l_orderkey", F.col("l_linenumber").alias("layer_id"), prompt.alias("layer_prompt"), F.struct(*_LINE_ORDER).alias("pos"))


def _bad(spark, d):
    li = table(spark, d, "lineitem").filter("l_returnflag = 'R'")
    return li.select("l_orderkey", F.col("l_linenumber").alias("layer_id"), F.struct(*_BAD_ORDER).alias("bad_pos"))


_PLAN_SQL = f"""
plan AS (SELECT l_orderkey, l_linenumber AS layer_id, CASE WHEN p_size > 45 THEN '' ELSE p_name END AS prompt,
  row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_ORDER_SQL}) AS rn
  FROM lineitem JOIN part ON p_partkey = l_partkey),
fp AS (SELECT l_orderkey, layer_id, prompt FROM plan WHERE rn = 1),
sel AS (SELECT b.*, fp.prompt,
  CASE WHEN fp.prompt IS NOT NULL AND length(fp.prompt) > 0 THEN 'SELECTED' ELSE 'SKIPPED' END AS selection
  FROM lineitem b LEFT JOIN fp ON fp.l_orderkey = b.l_orderkey AND fp.layer_id = b.l_linenumber WHERE b.l_returnflag = 'R')
"""


@scenario(
    "repair_select",
    f"WITH {_PLAN_SQL} SELECT l_orderkey, l_linenumber AS layer_id, prompt AS layer_prompt, selection FROM sel",
)
def repair_select(spark, d):
    s = RP.repair_select(_bad(spark, d), _plan(spark, d), "l_orderkey", "layer_id", "layer_prompt", "pos")
    return s.select("l_orderkey", "layer_id", "layer_prompt", "selection")


_COUNTS_SQL = """
nb AS (SELECT l_orderkey, count(*) AS n_bad FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey),
nl AS (SELECT l_orderkey, count(*) AS n_layers FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey)
"""


@scenario(
    "refine_rate",
    f"WITH {_COUNTS_SQL} SELECT l_orderkey, n_bad, n_layers, CAST(n_bad AS DOUBLE) / n_layers AS refine_rate FROM nb JOIN nl USING (l_orderkey)",
)
def refine_rate(spark, d):
    s = RP.repair_summary(_bad(spark, d), _plan(spark, d), "l_orderkey", "bad_pos", "layer_id", "layer_prompt", "pos")
    return s.select("l_orderkey", F.col("n_bad").cast("bigint"), F.col("n_layers").cast("bigint"), "refine_rate")


@scenario(
    "repair_summary",
    f"""
WITH {_PLAN_SQL}, {_COUNTS_SQL},
rl AS (SELECT l_orderkey, string_agg(CAST(l_linenumber AS VARCHAR), ',' ORDER BY {', '.join(_BAD_ORDER)}) AS refined_layers FROM sel GROUP BY l_orderkey),
lp AS (SELECT l_orderkey, string_agg(k || '=' || v, ';' ORDER BY k) AS layer_prompt
  FROM (SELECT DISTINCT l_orderkey, CAST(l_linenumber AS VARCHAR) AS k, prompt AS v FROM sel WHERE selection = 'SELECTED') GROUP BY l_orderkey)
SELECT l_orderkey, CAST(n_bad AS DOUBLE) / n_layers AS refine_rate, refined_layers, coalesce(lp.layer_prompt, '') AS layer_prompt
FROM nb JOIN nl USING (l_orderkey) JOIN rl USING (l_orderkey) LEFT JOIN lp USING (l_orderkey)
""",
)
def repair_summary(spark, d):
    s = RP.repair_summary(_bad(spark, d), _plan(spark, d), "l_orderkey", "bad_pos", "layer_id", "layer_prompt", "pos")
    lp = F.array_join(F.transform(F.map_entries("layer_prompt"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return s.select(
        "l_orderkey", "refine_rate", F.array_join(F.col("refined_layers").cast("array<string>"), ",").alias("refined_layers"), lp.alias("layer_prompt")
    )


@scenario(
    "repair_run_status",
    f"""
WITH r AS (SELECT l_orderkey, ({', '.join(_BAD_ORDER)}) AS o, l_linestatus = 'F' AS ok FROM lineitem WHERE l_returnflag = 'R'),
f AS (SELECT l_orderkey, min(o) FILTER (WHERE NOT ok) AS ff FROM r GROUP BY l_orderkey)
SELECT l_orderkey, bool_and(ff IS NULL) AS ok, count(*) FILTER (WHERE ff IS NULL OR o < ff) AS replaced
FROM r JOIN f USING (l_orderkey) GROUP BY l_orderkey
""",
)
def repair_run_status(spark, d):
    li = table(spark, d, "lineitem").filter("l_returnflag = 'R'").withColumn("ok", F.col("l_linestatus") == "F")
    return RP.repair_run_status(li, "l_orderkey", _BAD_ORDER, "ok")


# ---------------------------------------------------------------- classification


@scenario(
    "verdict_status",
    f"""
WITH e AS (SELECT event_id, event_type <> 'error' AS call_ok, value >= 5 AS parsed, {_K} % 4 AS n_bad, user_id % 5 <> 0 AS regen_ok FROM events),
r AS (SELECT event_id, CASE WHEN NOT call_ok THEN 'CALL_FAILED' WHEN NOT parsed THEN 'VERDICT_INVALID' WHEN n_bad = 0 THEN 'NO_BAD_LAYERS'
  WHEN NOT regen_ok THEN 'REGENERATION_FAILED' ELSE 'REPAIRED' END AS reason FROM e)
SELECT event_id, reason IN ('NO_BAD_LAYERS', 'REPAIRED') AS ok, reason = 'REPAIRED' AS writes_summary, reason FROM r
""",
)
def verdict_status(spark, d):
    ev = table(spark, d, "events")
    status = F.when(F.col("value") < 5, F.lit("JSON_INVALID")).otherwise(F.lit("OK"))
    r = RP.verdict_status(F.col("event_type") != "error", status, F.expr(_K.replace("VARCHAR", "STRING")) % 4, F.col("user_id") % 5 != 0)
    return ev.select("event_id", r.alias("r")).select("event_id", "r.ok", "r.writes_summary", "r.reason")


@scenario(
    "image_outcome",
    f"""
WITH e AS (SELECT event_id, event_id % 7 <> 0 AS g, event_id % 5 <> 0 AS c, {_K} % 2 = 0 AS kc, value > 10 AS ed FROM events)
SELECT event_id,
  CASE WHEN NOT g THEN false WHEN NOT c THEN false WHEN NOT kc THEN true ELSE ed END AS ok,
  CASE WHEN NOT g THEN NULL WHEN NOT c OR NOT kc THEN 'temp' WHEN ed THEN 'edited' ELSE 'temp' END AS final_source,
  g AND c AND kc AND ed AS temp_left
FROM e
""",
)
def image_outcome(spark, d):
    ev = table(spark, d, "events")
    k = F.expr(_K.replace("VARCHAR", "STRING"))
    r = RP.image_outcome(F.col("event_id") % 7 != 0, F.col("event_id") % 5 != 0, k % 2 == 0, F.col("value") > 10)
    return ev.select("event_id", r.alias("r")).select("event_id", "r.ok", "r.final_source", "r.temp_left")


_KIND = f"CASE {_K} % 3 WHEN 0 THEN 'status' WHEN 1 THEN 'api' ELSE 'other' END"
_CODE = f"CASE WHEN {_K} % 2 = 0 THEN 410 ELSE 500 END"
_MSG = f"CASE WHEN {_K} % 5 = 0 THEN NULL ELSE 'message ' || CAST(event_id AS VARCHAR) END"


@scenario(
    "error_class",
    f"""
WITH e AS (SELECT event_id, {_KIND} AS kind, {_CODE} AS code, {_MSG} AS msg, 'raw ' || CAST(event_id AS VARCHAR) AS raw FROM events)
SELECT event_id,
  CASE WHEN kind = 'status' AND code = 410 THEN 'DEPRECATED' WHEN kind = 'status' THEN 'API_STATUS' WHEN kind = 'api' THEN 'API_ERROR' ELSE 'UNEXPECTED' END AS error_class,
  coalesce(msg, raw) AS error_text
FROM e
""",
)
def error_class(spark, d):
    ev = table(spark, d, "events")
    sub = lambda s: F.expr(s.replace("VARCHAR", "STRING"))
    r = RP.error_class(sub(_KIND), sub(_CODE), sub(_MSG), F.concat(F.lit("raw "), F.col("event_id").cast("string")))
    return ev.select("event_id", r.alias("r")).select("event_id", "r.error_class", "r.error_text")
