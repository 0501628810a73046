"""Retrieval keys: vectors, exact and approximate kNN, asset joins, the
flagship layout-prompt query."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from atelier.functions import chat as CH
from atelier.functions import text as T
from atelier.functions import vectors as V
from atelier.operators import ann as ANN
from atelier.operators import retrieve as RT
from atelier.operators.agg import first_by
from atelier.operators.encode import encode_text, hash_counts
from atelier.operators.layers import explode_layers, parse_plan_layers
from atelier.operators.runs import stage_outcome
from atelier.scenarios import scenario
from atelier.scenarios.text import _VARIANT_SQL, _status_case_sql
from atelier.session import materialize, scratch_path, table


def _dot_sql(a: str, b: str) -> str:
    return f"list_dot_product(list_transform({a}, lambda x: CAST(x AS DOUBLE)), list_transform({b}, lambda x: CAST(x AS DOUBLE)))"


@scenario(
    "l2_normalize",
    """
WITH s AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(vec_id % 7 + 1 AS DOUBLE)) AS v FROM embeddings),
n AS (SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS nv FROM s),
u AS (SELECT vec_id, list_transform(v, lambda x: x / nv) AS w FROM n)
SELECT vec_id, round(w[1], 6) AS first, round(sqrt(list_sum(list_transform(w, lambda x: x * x))), 6) AS norm FROM u
""",
)
def l2_normalize(spark, d):
    e = table(spark, d, "embeddings")
    w = V.l2_normalize(V.scale("embedding", (F.col("vec_id") % 7 + 1).cast("double")))
    u = e.select("vec_id", w.alias("w"))
    return u.select("vec_id", F.round(F.col("w")[0], 6).alias("first"), F.round(V.norm("w"), 6).alias("norm"))


def _library(spark, d):
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("pos"), "embedding")


@scenario(
    "knn_topk",
    f"""
WITH s AS (SELECT q.vec_id AS qid, l.vec_id AS pos, {_dot_sql('q.embedding', 'l.embedding')} AS sim FROM embeddings q, embeddings l),
r AS (SELECT qid, pos, sim, row_number() OVER (PARTITION BY qid ORDER BY sim DESC, pos) AS rank FROM s)
SELECT qid, rank, pos, round(sim, 6) AS sim FROM r WHERE rank <= 5
""",
)
def knn_topk(spark, d):
    q = table(spark, d, "embeddings").select(F.col("vec_id").alias("qid"), "embedding")
    r = RT.knn_topk(q, _library(spark, d), k=5, query_key="qid")
    return r.select("qid", "rank", "pos", F.round("sim", 6).alias("sim"))


def derived_queries(spark, d):
    """One query per embedding that has a successor: normalize(e_i + 0.5 e_(i+1))."""
    e = table(spark, d, "embeddings")
    a, b = e.alias("a"), e.alias("b")
    j = a.join(b, F.col("b.vec_id") == F.col("a.vec_id") + 1)
    v = V.l2_normalize(V.add(F.col("a.embedding"), F.col("b.embedding"), 0.5))
    return j.select(F.col("a.vec_id").alias("qid"), v.alias("embedding"))


_QUERIES_SQL = """
WITH pq AS (SELECT a.vec_id AS qid,
    list_transform(range(1, len(a.embedding) + 1), lambda i: CAST(a.embedding[i] AS DOUBLE) + 0.5 * CAST(b.embedding[i] AS DOUBLE)) AS v
  FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1),
qn AS (SELECT qid, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS nv FROM pq),
q AS (SELECT qid, list_transform(v, lambda x: x / nv) AS qv FROM qn)
"""

_TOP1_SQL = (
    _QUERIES_SQL
    + f""",
s AS (SELECT q.qid, l.vec_id AS pos, list_dot_product(q.qv, list_transform(l.embedding, lambda x: CAST(x AS DOUBLE))) AS sim FROM q, embeddings l),
top1 AS (SELECT qid, pos, sim FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY sim DESC, pos) AS rn FROM s) WHERE rn = 1)
"""
)


def _top1(spark, d):
    return RT.knn_topk(derived_queries(spark, d), _library(spark, d), k=1, query_key="qid").select("qid", "pos", "sim")


@scenario("top1", _TOP1_SQL + "SELECT qid, pos, round(sim, 6) AS sim FROM top1")
def top1(spark, d):
    return _top1(spark, d).select("qid", "pos", F.round("sim", 6).alias("sim"))


@scenario("similarity_format", _TOP1_SQL + "SELECT qid, pos, printf('%.4f', sim) AS similarity FROM top1")
def similarity_format(spark, d):
    return _top1(spark, d).select("qid", "pos", T.similarity_format("sim").alias("similarity"))


def _id_map(spark, d):
    """Library position -> element id; parts larger than 45 have no entry."""
    p = table(spark, d, "part").filter("p_size <= 45")
    return p.select(F.col("p_partkey").alias("pos"), F.concat(F.lit("part-"), F.col("p_partkey").cast("string")).alias("elem_id"))


@scenario(
    "asset_lookup",
    _TOP1_SQL
    + """
SELECT t.qid, t.pos, 'part-' || CAST(p.p_partkey AS VARCHAR) AS elem_id,
  CASE WHEN p.p_partkey IS NULL THEN 'NO_HIT' ELSE 'OK' END AS lookup_status
FROM top1 t LEFT JOIN (SELECT p_partkey FROM part WHERE p_size <= 45) p ON p.p_partkey = t.pos
""",
)
def asset_lookup(spark, d):
    hits = _top1(spark, d).select("qid", "pos")
    return RT.asset_lookup(hits, _id_map(spark, d), "pos", "elem_id").select("qid", "pos", "elem_id", "lookup_status")


def _line_layers(spark, d):
    li = table(spark, d, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.concat(F.lit("part-"), F.col("l_partkey").cast("string")).alias("elem_id")
    )


def _part_library(spark, d):
    return _id_map(spark, d).select("elem_id")


@scenario(
    "missing_assets",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 45)
""",
)
def missing_assets(spark, d):
    m = RT.missing_assets(_line_layers(spark, d), _part_library(spark, d), "elem_id")
    return m.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@scenario(
    "asset_gate",
    """
WITH f AS (SELECT l.*, p.p_partkey IS NOT NULL AS found FROM lineitem l
  LEFT JOIN (SELECT p_partkey FROM part WHERE p_size <= 45) p ON p.p_partkey = l.l_partkey)
SELECT l_orderkey, count(*) AS n_layers, count(*) FILTER (WHERE NOT found) AS n_missing, bool_and(found) AS ok,
  min(l_linenumber) FILTER (WHERE NOT found) AS first_missing_pos,
  arg_min('part-' || CAST(l_partkey AS VARCHAR), (l_linenumber, l_partkey)) FILTER (WHERE NOT found) AS first_missing_elem
FROM f GROUP BY l_orderkey
""",
)
def asset_gate(spark, d):
    g = RT.asset_gate(_line_layers(spark, d), _part_library(spark, d), "l_orderkey", ["l_linenumber", "l_partkey"], "elem_id")
    return g.select("l_orderkey", "n_layers", "n_missing", "ok", F.col("first_missing_pos").cast("int"), "first_missing_elem")


_LINE_ORDER = [
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
]


@scenario(
    "copy_manifest",
    f"""
SELECT l_orderkey, 'generated_images/layer' || CAST(l_linenumber AS VARCHAR) || '.png' AS dst,
  'part-' || CAST(l_partkey AS VARCHAR) || '.png' AS src
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(c + ' DESC' for c in _LINE_ORDER)}) AS rn FROM lineitem)
WHERE rn = 1
""",
)
def copy_manifest(spark, d):
    li = table(spark, d, "lineitem")
    hits = li.select(
        "l_orderkey",
        F.col("l_linenumber").alias("layer_id"),
        F.concat(F.lit("part-"), F.col("l_partkey").cast("string"), F.lit(".png")).alias("src"),
        F.struct(*_LINE_ORDER).alias("pos"),
    )
    return RT.copy_manifest(hits, "l_orderkey", "pos", "layer_id", "src").select("l_orderkey", "dst", "src")


# ---------------------------------------------------------------- model-side keys


@scenario(
    "encode_text",
    r"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+')) AS tok FROM documents),
h AS (SELECT doc_id, CAST('0x' || substr(md5(tok), 1, 2) AS BIGINT) % 128 AS b FROM t),
c AS (SELECT doc_id, b % 64 AS slot, sum(CASE WHEN b < 64 THEN 1 ELSE -1 END) AS v FROM h GROUP BY ALL),
g AS (SELECT d.doc_id, s.slot, CAST(coalesce(c.v, 0) AS BIGINT) AS v FROM documents d CROSS JOIN range(64) s(slot) LEFT JOIN c ON c.doc_id = d.doc_id AND c.slot = s.slot)
SELECT doc_id, 64 AS dim, CASE WHEN sum(v * v) > 0 THEN 1.0 ELSE 0.0 END AS norm, CASE WHEN sum(v * v) > 0 THEN 1.0 END AS cosine,
  string_agg(CAST(v AS VARCHAR), ',' ORDER BY slot) AS counts FROM g GROUP BY doc_id
""",
)
def encode_text_q(spark, d):
    """Signed token counts, the vector's length, and its cosine to the counts."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    e = encode_text(hash_counts(docs, "text", "n"), "text", "embedding")
    cosine = F.try_divide(V.dot("embedding", "n"), V.norm("n"))
    counts = F.array_join(F.transform("n", lambda x: x.cast("bigint").cast("string")), ",")
    return e.select("doc_id", F.size("embedding").cast("bigint").alias("dim"), F.round(V.norm("embedding"), 5).alias("norm"), F.round(cosine, 5).alias("cosine"), counts.alias("counts"))


@scenario("knn_ann")
def knn_ann(spark, d):
    r = RT.knn_ann(derived_queries(spark, d), _library(spark, d), k=1, query_key="qid")
    return r.select("qid", "rank", "pos", F.round("sim", 6).alias("sim"))


def _stored_index(spark, d):
    """Built on the vectors of even position; the others come in one addition,
    which is run twice."""
    path = scratch_path(spark, f"ann-{uuid.uuid4().hex}")
    library = _library(spark, d)
    ANN.build_index(library.filter("pos % 2 = 0"), path)
    for _ in range(2):
        ANN.add_vectors(library.filter("pos % 2 = 1"), path, "odd")
    return path


@scenario("ann_index")
def ann_index(spark, d):
    """A stored index searched with its defaults (tests assert its recall)."""
    r = ANN.search_index(derived_queries(spark, d), _stored_index(spark, d))
    return r.select("qid", "rank", "pos", F.round("sim", 6).alias("sim"))


@scenario("ann_index_all_cells", _TOP1_SQL + "SELECT qid, pos, round(sim, 6) AS sim FROM top1")
def ann_index_all_cells(spark, d):
    """Every cell searched: as exact as ``top1`` after the exact comparison."""
    r = ANN.search_index(derived_queries(spark, d), _stored_index(spark, d), nprobe=10_000)
    return r.select("qid", "pos", F.round("sim", 6).alias("sim"))


@scenario("knn_ann_all_cells", _TOP1_SQL + "SELECT qid, pos, round(sim, 6) AS sim FROM top1")
def knn_ann_all_cells(spark, d):
    """Every cell probed: as exact as ``top1``."""
    r = RT.knn_ann(derived_queries(spark, d), _library(spark, d), k=1, query_key="qid", n_cells=8, nprobe=8)
    return r.select("qid", "pos", F.round("sim", 6).alias("sim"))


def plan_documents(spark, d):
    """Planner-shaped text per conversation: the user turn is the request,
    each turn becomes an image layer whose prompt is the turn's text."""
    from atelier.scenarios.text import plan_texts

    return plan_texts(spark, d)


_LAYOUT_SQL = (
    f"WITH c AS (SELECT *, {_VARIANT_SQL} AS v FROM conversations),"
    + r"""
p AS (
  SELECT conv_id, any_value(v) AS v, arg_min(text, turn) FILTER (WHERE role = 'user') AS u,
    string_agg('{"layer_id": ' || turn || ', "layer_prompt": ' || CAST(to_json(text) AS VARCHAR) || '}', ', ' ORDER BY turn) AS body,
    string_agg('{"layer_id": ' || turn || ', "url": "generated_images/layer' || turn || '.png"}', ', ' ORDER BY turn) AS man
  FROM c GROUP BY conv_id),
t AS (SELECT conv_id, turn, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+')) AS tok FROM c WHERE v = 'CLEAN'),
h AS (SELECT conv_id, turn, CAST('0x' || substr(md5(tok), 1, 2) AS BIGINT) % 128 AS b FROM t),
k AS (SELECT conv_id, turn, b % 64 AS slot, sum(CASE WHEN b < 64 THEN 1 ELSE -1 END) AS n FROM h GROUP BY ALL),
e AS (SELECT vec_id, unnest(range(64)) AS slot, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
s AS (SELECT conv_id, turn, vec_id, sum(n * x) AS sim FROM k JOIN e USING (slot) GROUP BY ALL),
b AS (SELECT conv_id, turn, vec_id FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY sim DESC, vec_id) AS rn FROM s) WHERE rn = 1),
g AS (
  SELECT c.conv_id, count(*) AS n_layers, count(*) FILTER (WHERE p_partkey IS NULL) AS n_missing FROM c LEFT JOIN b ON b.conv_id = c.conv_id AND b.turn = c.turn
  LEFT JOIN part ON p_size <= 45 AND p_partkey = coalesce(b.vec_id, (SELECT min(vec_id) FROM embeddings)) WHERE v = 'CLEAN' GROUP BY c.conv_id)
SELECT p.conv_id, """
    + _status_case_sql()
    + r""" AS parse_status, coalesce(n_missing = 0, false) AS ok,
  CASE WHEN v <> 'CLEAN' THEN 'plan' WHEN n_missing > 0 THEN 'retrieval' END AS failed_stage, n_layers, n_missing,
  CASE WHEN n_missing = 0 THEN '<user_input>' || chr(10) || u || chr(10) || '</user_input>' || chr(10)
    || '<layout_thought>plan</layout_thought>' || chr(10) || '<image_generator>' || chr(10) || '[' || body || ']' || chr(10) || '</image_generator>' || chr(10)
    || '<image_generator_result>' || chr(10) || '[' || man || ']' || chr(10) || '</image_generator_result>' END AS layout_prompt
FROM p LEFT JOIN g USING (conv_id)
"""
)


@scenario("layout_prompts", _LAYOUT_SQL)
def layout_prompts(spark, d):
    """Flagship: plan text -> parsed layers -> text vectors -> nearest
    library vector -> element id -> all-or-nothing asset gate -> manifest
    -> layout prompt, one row for every conversation: a plan that doesn't
    parse or whose assets are missing has its first failed stage, and an empty
    plan has an empty manifest."""
    conv = table(spark, d, "conversations")
    plans = plan_documents(spark, d)
    parsed = parse_plan_layers(plans, "plan", ["conv_id"])
    layers = explode_layers(parsed, ["conv_id"])
    layers = layers.withColumn("qid", F.concat_ws(":", F.col("conv_id").cast("string"), F.col("pos").cast("string")))
    # parse and model stage: persisted once (reliable checkpoint) so the kNN counts and
    # the main job do not re-run them, and a lost executor never does
    layers = materialize(encode_text(layers, "layer_prompt", "embedding"))
    hits = RT.knn_topk(layers.select("qid", "embedding"), _library(spark, d), k=1, query_key="qid")
    found = RT.asset_lookup(hits.select("qid", "pos", "sim"), _id_map(spark, d), "pos", "elem_id")
    per_layer = layers.drop("embedding").join(found.select("qid", F.col("pos").alias("lib_pos"), "elem_id", "sim"), "qid", "left")
    gate = RT.asset_gate(per_layer.select("conv_id", "pos", "elem_id"), _part_library(spark, d), "conv_id", "pos", "elem_id")
    manifest = RT.layer_manifest(per_layer.select("conv_id", "pos", "layer_id"), "conv_id", "pos", "layer_id")
    user = first_by(conv.filter("role = 'user'").select("conv_id", "turn", "text"), "conv_id", "turn").select(
        "conv_id", F.col("text").alias("user_input")
    )
    out = plans.join(parsed.select("conv_id", F.col("status").alias("parse_status"), F.size("items").alias("_n")), "conv_id", "left")
    out = out.join(gate.select("conv_id", "n_layers", "n_missing", F.col("ok").alias("_gate")), "conv_id", "left")
    out = out.join(manifest, "conv_id", "left").join(user, "conv_id", "left")
    empty = F.col("_n") == 0
    out = (
        out.withColumn("_plan", F.col("parse_status") == "OK")
        .withColumn("_gate", F.coalesce("_gate", empty))
        .withColumn("manifest", F.coalesce("manifest", F.when(empty, F.lit("[]"))))
        .withColumn("n_layers", F.coalesce("n_layers", F.when(empty, F.lit(0).cast("bigint"))))
        .withColumn("n_missing", F.coalesce("n_missing", F.when(empty, F.lit(0).cast("bigint"))))
    )
    out = stage_outcome(out, [("plan", "_plan"), ("retrieval", "_gate")])
    prompt = F.when(F.col("ok"), CH.assemble_layout_prompt("user_input", "plan", "manifest"))
    return out.select("conv_id", "parse_status", "ok", "failed_stage", "n_layers", "n_missing", prompt.alias("layout_prompt"))
