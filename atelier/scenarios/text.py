"""Text keys: tags, strict JSON, verdicts, paths, payloads, HTML checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from atelier.constants import PY_WHITESPACE_CLASS
from atelier.functions import html as H
from atelier.functions import jsonparse as J
from atelier.functions import text as T
from atelier.operators.agg import ordered_concat
from atelier.operators import layers as LY
from atelier.plans import contract as C
from atelier.scenarios import scenario, sql_literal
from atelier.session import table

WS = PY_WHITESPACE_CLASS


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


# ---------------------------------------------------------------- tags


@scenario(
    "extract_tag",
    f"""
SELECT page_id,
  regexp_matches(html, '(?s)<title>(.*?)</title>') AS title_present,
  CASE WHEN regexp_matches(html, '(?s)<title>(.*?)</title>')
       THEN {sql_strip("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")} END AS title,
  regexp_matches(html, '(?s)<main>(.*?)</main>') AS main_present,
  CASE WHEN regexp_matches(html, '(?s)<main>(.*?)</main>')
       THEN {sql_strip("regexp_extract(html, '(?s)<main>(.*?)</main>', 1)")} END AS main
FROM pages
""",
)
def extract_tag(spark, d):
    p = table(spark, d, "pages")
    t, m = T.extract_tag("html", "title"), T.extract_tag("html", "main")
    return p.select(
        "page_id",
        t["present"].alias("title_present"),
        t["body"].alias("title"),
        m["present"].alias("main_present"),
        m["body"].alias("main"),
    )


_PAGE_TAGS = ("title", "h1", "article")


@scenario(
    "tag_multiplicity",
    "SELECT page_id, "
    + ", ".join(
        f"CAST(len(regexp_extract_all(html, '<{t}>')) AS BIGINT) AS {t}_open, "
        f"CAST(len(regexp_extract_all(html, '</{t}>')) AS BIGINT) AS {t}_close"
        for t in _PAGE_TAGS
    )
    + ", "
    + " AND ".join(
        f"len(regexp_extract_all(html, '<{t}>')) = 1 AND len(regexp_extract_all(html, '</{t}>')) = 1" for t in _PAGE_TAGS
    )
    + " AS ok FROM pages",
)
def tag_multiplicity(spark, d):
    m = C.tag_multiplicity(F.col("html"), _PAGE_TAGS)
    return table(spark, d, "pages").select("page_id", m.alias("m")).select("page_id", "m.*")


_ORDER_TAGS = ("head", "body", "article")


def _order_sql() -> str:
    conds = []
    prev = None
    for t in _ORDER_TAGS:
        o, c = f"instr(html, '<{t}>')", f"instr(html, '</{t}>')"
        conds += [f"{o} > 0", f"{c} > {o}"]
        if prev:
            conds.append(f"{o} > {prev}")
        prev = c
    return " AND ".join(conds)


@scenario(
    "tag_order",
    f"""
SELECT page_id, {_order_sql()} AS ordered,
  {_order_sql()} AND regexp_matches(html, '(?s)</head>{WS}*<body>') AS adjacent
FROM pages
""",
)
def tag_order(spark, d):
    p = table(spark, d, "pages")
    return p.select(
        "page_id",
        C.tag_order(F.col("html"), _ORDER_TAGS, adjacent=None).alias("ordered"),
        C.tag_order(F.col("html"), _ORDER_TAGS, adjacent=("head", "body")).alias("adjacent"),
    )


# ---------------------------------------------------------------- plan text with layers

# Plan text per conversation: an <image_generator> JSON array of
# {"layer_id": turn, "layer_prompt": text}; some conversations get a broken
# variant (decided by conv_id) so every parse status occurs.
_VARIANT_SQL = """
CASE WHEN conv_id % 13 = 0 THEN 'TAG_MISSING'
     WHEN conv_id % 5 = 0 THEN 'JUNK'
     WHEN conv_id % 7 = 0 THEN 'STRAY'
     WHEN conv_id % 11 = 0 THEN 'STRING_ID'
     ELSE 'CLEAN' END
"""
_STATUS_OF_VARIANT = {
    "TAG_MISSING": "TAG_MISSING",
    "JUNK": "JSON_INVALID",
    "STRAY": "JSON_INVALID",
    "STRING_ID": "SCHEMA_MISMATCH",
    "CLEAN": "OK",
}


def plan_texts(spark, d):
    """``(conv_id, plan)`` built by Spark from the conversation turns."""
    conv = table(spark, d, "conversations")
    lid = F.when(F.expr(_VARIANT_SQL) == "STRING_ID", F.concat(F.lit('"'), F.col("turn").cast("string"), F.lit('"'))).otherwise(
        F.col("turn").cast("string")
    )
    entries = conv.select(
        "conv_id",
        "turn",
        F.concat(F.lit('{"layer_id": '), lid, F.lit(', "layer_prompt": '), J.json_string(F.col("text")), F.lit("}")).alias("e"),
    )
    arr = ordered_concat(entries, "conv_id", "turn", "e", sep=", ", out="body")
    v = F.expr(_VARIANT_SQL)
    js = F.concat(F.lit("["), F.col("body"), F.lit("]"))
    js = F.when(v == "JUNK", F.concat(js, F.lit(" x"))).when(v == "STRAY", F.concat(js, F.lit("}"))).otherwise(js)
    tag = F.when(v == "TAG_MISSING", F.lit("image_gen")).otherwise(F.lit("image_generator"))
    plan = F.concat(F.lit("<layout_thought>plan</layout_thought>\n<"), tag, F.lit(">\n"), js, F.lit("\n</"), tag, F.lit(">"))
    return arr.select("conv_id", plan.alias("plan"))


def _status_case_sql() -> str:
    parts = " ".join(f"WHEN v = '{k}' THEN '{s}'" for k, s in _STATUS_OF_VARIANT.items())
    return f"CASE {parts} END"


@scenario(
    "parse_layers",
    f"""
WITH c AS (SELECT conv_id, count(*) AS n, {_VARIANT_SQL.replace('conv_id', 'conv_id')} AS v FROM conversations GROUP BY conv_id)
SELECT conv_id, {_status_case_sql()} AS status, CASE WHEN v = 'CLEAN' THEN n END AS n_layers FROM c
""",
)
def parse_layers(spark, d):
    p = plan_texts(spark, d)
    parsed = J.parse_layers(F.col("plan"))
    return p.select("conv_id", parsed["status"].alias("status"), F.size(parsed["items"]).cast("bigint").alias("n_layers")).withColumn(
        "n_layers", F.when(F.col("status") == "OK", F.col("n_layers"))
    )


@scenario(
    "explode_layers",
    f"""
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS pos, turn AS layer_id, text AS layer_prompt
FROM conversations WHERE ({_VARIANT_SQL}) = 'CLEAN'
""",
)
def explode_layers(spark, d):
    parsed = LY.parse_plan_layers(plan_texts(spark, d), "plan", ["conv_id"])
    return LY.explode_layers(parsed, ["conv_id"])


# ---------------------------------------------------------------- verdicts

_K = "CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT)"
_VERDICT_VARIANT = """
CASE WHEN event_id % 14 = 0 THEN 'NONE'
     WHEN event_id % 9 = 0 THEN 'STRAY'
     WHEN event_id % 10 = 0 THEN 'PROPS'
     WHEN event_id % 15 = 0 THEN 'NULL_BAD'
     WHEN event_id % 21 = 0 THEN 'STRING_BAD'
     ELSE 'BASE' END
"""


def _verdict_obj_sql(k: str) -> str:
    return (
        "'{\"bad_layers\": [' || CAST(" + k + " % 5 AS VARCHAR) || ', ' || CAST(user_id % 7 AS VARCHAR) || "
        "'], \"reason\": {\"' || CAST(" + k + " % 5 AS VARCHAR) || '\": \"' || event_type || '\"}}'"
    )


@scenario(
    "extract_verdict",
    f"""
WITH e AS (SELECT event_id, user_id, event_type, {_K} AS k, {_VERDICT_VARIANT} AS v FROM events)
SELECT event_id,
  CASE v WHEN 'NONE' THEN 'NO_JSON' WHEN 'STRAY' THEN 'JSON_INVALID' WHEN 'STRING_BAD' THEN 'SCHEMA_MISMATCH' ELSE 'OK' END AS status,
  CASE v WHEN 'BASE' THEN 2 WHEN 'PROPS' THEN 0 WHEN 'NULL_BAD' THEN 0 END AS n_bad,
  CASE v WHEN 'BASE' THEN CAST(k % 5 AS VARCHAR) || ',' || CAST(user_id % 7 AS VARCHAR) WHEN 'PROPS' THEN '' WHEN 'NULL_BAD' THEN '' END AS bad_layers,
  CASE v WHEN 'BASE' THEN event_type END AS first_reason
FROM e
""",
)
def extract_verdict(spark, d):
    ev = table(spark, d, "events")
    k = F.expr(_K.replace("VARCHAR", "STRING"))
    v = F.expr(_VERDICT_VARIANT)
    base = F.expr(_verdict_obj_sql("k").replace("VARCHAR", "STRING"))
    obj = (
        F.when(v == "NONE", F.lit("nothing to report"))
        .when(v == "STRAY", F.concat(base, F.lit(" }")))
        .when(v == "PROPS", F.col("props"))
        .when(v == "NULL_BAD", F.lit('{"bad_layers": null}'))
        .when(v == "STRING_BAD", F.lit('{"bad_layers": ["x"]}'))
        .otherwise(base)
    )
    txt = F.concat(F.lit("note "), obj, F.lit(" end"))
    r = J.extract_verdict(txt)
    out = ev.withColumn("k", k).select("event_id", r.alias("r"))
    first = F.element_at(F.col("r.reason"), F.element_at(F.col("r.bad_layers"), 1).cast("string"))
    return out.select(
        "event_id",
        F.col("r.status").alias("status"),
        F.size("r.bad_layers").cast("bigint").alias("n_bad"),
        F.array_join(F.col("r.bad_layers").cast("array<string>"), ",").alias("bad_layers"),
        F.when(F.size("r.bad_layers") > 0, first).alias("first_reason"),
    ).withColumn("n_bad", F.when(F.col("status") == "OK", F.col("n_bad")))


@scenario(
    "bool_verdict",
    "SELECT event_id, event_type IN ('view', 'purchase', 'signup') AS verdict FROM events",
)
def bool_verdict(spark, d):
    ev = table(spark, d, "events")
    answer = (
        F.when(F.col("event_type") == "view", F.lit(" True\n"))
        .when(F.col("event_type") == "click", F.lit("true."))
        .when(F.col("event_type") == "error", F.lit("FALSE"))
        .when(F.col("event_type") == "purchase", F.lit("\u00a0TRUE\u3000"))
        .otherwise(F.lit("truE"))
    )
    return ev.select("event_id", T.bool_verdict(answer).alias("verdict"))


# ---------------------------------------------------------------- payloads and paths


@scenario(
    "data_url",
    "SELECT item_id, 'data:image/png;base64,' || to_base64(encode(text)) AS url FROM benchmark",
)
def data_url(spark, d):
    b = table(spark, d, "benchmark")
    return b.select("item_id", T.data_url(F.encode("text", "UTF-8")).alias("url"))


@scenario("unbase64_payload", "SELECT item_id, text AS decoded, true AS roundtrip FROM benchmark")
def unbase64_payload(spark, d):
    b = table(spark, d, "benchmark")
    url = T.data_url(F.encode("text", "UTF-8"))
    dec = F.decode(T.unbase64_payload(url), "UTF-8")
    return b.select("item_id", dec.alias("decoded"), (dec == F.col("text")).alias("roundtrip"))


@scenario(
    "layer_url",
    """
SELECT conv_id, turn, 'generated_images/layer' || CAST(turn AS VARCHAR) || '.png' AS url,
  'generated_images/temp_layer' || CAST(turn AS VARCHAR) || '.png' AS temp_url
FROM conversations
""",
)
def layer_url(spark, d):
    c = table(spark, d, "conversations")
    return c.select("conv_id", "turn", T.layer_url("turn").alias("url"), T.layer_url("turn", temp=True).alias("temp_url"))


@scenario(
    "artifact_path",
    r"""
SELECT page_id, regexp_replace(url, '([^/.]\.*)\.[^./]*$', '\1') || '.png' AS png_path,
  regexp_extract(url, '[^/.]\.*(\.[^./]*)$', 1) AS ext
FROM pages
""",
)
def artifact_path(spark, d):
    p = table(spark, d, "pages")
    return p.select("page_id", T.artifact_path("url", ".png").alias("png_path"), T.path_extension("url").alias("ext"))


_LISTING_NAME = """
CASE page_id % 4 WHEN 0 THEN 'refined_' || CAST(page_id AS VARCHAR) || '.html'
                 WHEN 1 THEN 'refine_' || CAST(page_id AS VARCHAR) || '.html'
                 WHEN 2 THEN 'refined_' || CAST(page_id AS VARCHAR) || '.png'
                 ELSE 'reference_' || CAST(page_id AS VARCHAR) || '.png' END
"""


@scenario(
    "artifact_listing",
    f"SELECT name FROM (SELECT {_LISTING_NAME} AS name FROM pages) WHERE starts_with(name, 'refined_') AND ends_with(name, '.html')",
)
def artifact_listing(spark, d):
    from atelier.operators.files import artifact_listing as listing

    names = table(spark, d, "pages").select(F.expr(_LISTING_NAME.replace("VARCHAR", "STRING")).alias("name"))
    return listing(names, "name")


# ---------------------------------------------------------------- HTML checks

_VARIANTS_SQL = """
SELECT page_id, 0 AS variant, html FROM pages
UNION ALL SELECT page_id, 1, replace(html, 'class="ad"', 'class="ads"') FROM pages
UNION ALL SELECT page_id, 2, '```html' || chr(10) || html || chr(10) || '```' FROM pages
"""
_TOKEN = "ad"


def _variants(spark, d):
    p = table(spark, d, "pages").select("page_id", "html")
    v0 = p.select("page_id", F.lit(0).alias("variant"), "html")
    v1 = p.select("page_id", F.lit(1).alias("variant"), F.replace("html", F.lit('class="ad"'), F.lit('class="ads"')).alias("html"))
    v2 = p.select("page_id", F.lit(2).alias("variant"), F.concat(F.lit("```html\n"), "html", F.lit("\n```")).alias("html"))
    return v0.unionByName(v1).unionByName(v2)


def _container_sql(token: str) -> str:
    pat = H.class_token_pattern(token).replace("'", "''")
    return f"coalesce(regexp_matches(html, '{pat}'), false)"


def _outside_sql(token: str) -> str:
    pat = H.class_tag(token).replace("'", "''")
    cleaned = "regexp_replace(html, '(?is)<script\\b.*?</script>|<style\\b.*?</style>|<!--.*?-->', '', 'g')"
    before = f"regexp_extract({cleaned}, '(?is)<body[^>]*>(.*?){pat}', 1)"
    notags = f"regexp_replace({before}, '(?s)<[^>]*>', '', 'g')"
    return f"CAST(length({sql_strip(notags)}) AS BIGINT)"


@scenario(
    "html_contract",
    f"""
WITH v AS ({_VARIANTS_SQL}),
f AS (
  SELECT page_id, variant, {_container_sql(_TOKEN)} AS has_container,
    starts_with({sql_strip('html')}, '```') AS in_fence,
    starts_with({sql_strip('html')}, '<') AND ends_with({sql_strip('html')}, '>') AS only_html,
    {_outside_sql(_TOKEN)} AS outside_all
  FROM v)
SELECT page_id, variant, has_container, in_fence, only_html,
  CASE WHEN has_container THEN outside_all END AS outside_chars,
  has_container AND NOT in_fence AND only_html AND coalesce(CASE WHEN has_container THEN outside_all END = 0, false) AS ok
FROM f
""",
)
def html_contract(spark, d):
    v = _variants(spark, d)
    return v.select("page_id", "variant", H.html_contract(F.col("html"), _TOKEN).alias("c")).select("page_id", "variant", "c.*")


@scenario(
    "render_ready",
    f"WITH v AS ({_VARIANTS_SQL}) SELECT page_id, variant, {_container_sql(_TOKEN)} AS ready FROM v",
)
def render_ready(spark, d):
    v = _variants(spark, d)
    return v.select("page_id", "variant", H.render_ready(F.col("html"), _TOKEN).alias("ready"))


@scenario(
    "strip",
    f"""
SELECT conv_id, turn, {sql_strip("chr(160) || chr(12288) || chr(9) || text || chr(10) || chr(28) || chr(31) || ' '")} AS stripped
FROM conversations
""",
)
def strip_q(spark, d):
    c = table(spark, d, "conversations")
    padded = F.concat(F.lit("\u00a0\u3000\t"), F.col("text"), F.lit("\n\x1c\x1f "))
    return c.select("conv_id", "turn", T.strip(padded).alias("stripped"))


# ---------------------------------------------------------------- whole contract

# page variants by document: what is put around a container, and what is then outside of it
_AROUND = (
    ("", "", 0, 0),
    ("<html><head><title>t</title><style>p{}</style></head><body>", "</body></html>", 0, 0),
    ("<main><section>", "</section></main>", 0, 0),
    ("before", "", 6, 0),
    ("", " after ", 5, 0),
    ("<body>", "<p>after</p></body>", 5, 1),
    ("<img src='x.png'>", "", 0, 1),
    ("", "<img src='x.png'/>", 0, 1),
    ("<div></div>", "", 0, 1),
    ("<!-- note --><script>var t = '</div>';</script>", "<script>1</script>", 0, 0),
    ("<div><p>a</p>", "</div>", 1, 1),
)
_INNER = "'<div>' || replace(text, '<', '&lt;') || '<br><div><p>x</div></div>'"


def _pick(k: int) -> str:
    return "CASE doc_id % {n} {when} END".format(
        n=len(_AROUND), when=" ".join(f"WHEN {i} THEN {sql_literal(v[k]) if isinstance(v[k], str) else v[k]}" for i, v in enumerate(_AROUND))
    )


@scenario(
    "poster_contract",
    f"""SELECT doc_id, true AS has_container, CAST({_pick(2)} AS BIGINT) AS outside_chars, CAST({_pick(3)} AS BIGINT) AS outside_elements,
  ({_pick(2)}) = 0 AND ({_pick(3)}) = 0 AS ok
FROM documents""",
)
def poster_contract(spark, d):
    docs = table(spark, d, "documents")
    page = F.concat(F.expr(_pick(0)), F.lit("<div class='big poster'>"), F.expr(_INNER), F.lit("</div>"), F.expr(_pick(1)))
    page = F.when(F.expr(f"doc_id % {len(_AROUND)} IN (3, 4)"), F.concat(F.lit("<html>"), page, F.lit("</html>"))).otherwise(page)
    return docs.select("doc_id", H.poster_contract(page).alias("c")).select("doc_id", "c.*")
