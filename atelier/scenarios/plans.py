"""Plan-contract keys.

Stand-ins: a plan is a customer, its groups are the customer's orders
(``group_id = 'G' || o_orderkey % 50``, so ids repeat inside some plans),
the children are the parts of the order's open lines, the known layers are
the parts of size <= 45 (image layers up to 25, text layers above).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from atelier.constants import PY_WHITESPACE_CLASS as WS
from atelier.functions import jsonparse as J
from atelier.plans import contract as C
from atelier.scenarios import scenario
from atelier.session import table

_THEME = """
CASE o_orderkey % 9 WHEN 0 THEN 'single' WHEN 1 THEN 'one two three four five six seven'
     ELSE replace(o_orderpriority, '-', ' ') END
"""
_GID = "'G' || CAST(o_orderkey % 50 AS VARCHAR)"


def _groups(spark, d):
    o = table(spark, d, "orders")
    li = table(spark, d, "lineitem").filter("l_linestatus = 'O'")
    # children per order: an order has a handful of lines (bounded group)
    ch = li.groupBy("l_orderkey").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda x: x["l_partkey"]).alias("children")
    )
    g = o.join(ch, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return g.select(
        "o_custkey",
        "o_orderkey",
        F.expr(_GID.replace("VARCHAR", "STRING")).alias("group_id"),
        F.coalesce("children", F.array().cast("array<bigint>")).alias("children"),
        F.expr(_THEME).alias("theme"),
    )


def _words_sql(x: str) -> str:
    s = f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"
    return f"CASE WHEN {s} = '' THEN 0 ELSE len(regexp_split_to_array({s}, '{WS}+')) END"


_G_SQL = f"SELECT o_custkey, o_orderkey, {_GID} AS group_id, {_THEME} AS theme FROM orders"


@scenario(
    "group_schema",
    f"""
WITH g AS ({_G_SQL})
SELECT o_custkey, count(*) AS n_groups, CAST(0 AS BIGINT) AS missing_fields, count(group_id) - count(DISTINCT group_id) AS repeated_ids,
  count(*) FILTER (WHERE NOT ({_words_sql('theme')} BETWEEN 2 AND 6)) AS bad_themes,
  count(group_id) - count(DISTINCT group_id) = 0 AND count(*) FILTER (WHERE NOT ({_words_sql('theme')} BETWEEN 2 AND 6)) = 0 AS ok
FROM g GROUP BY o_custkey
""",
)
def group_schema(spark, d):
    return C.group_schema(_groups(spark, d), "o_custkey")


@scenario(
    "theme_words",
    f"WITH g AS ({_G_SQL}) SELECT o_orderkey, theme, {_words_sql('theme')} BETWEEN 2 AND 6 AS ok FROM g",
)
def theme_words(spark, d):
    g = _groups(spark, d)
    return g.select("o_orderkey", "theme", C.theme_words(F.col("theme")).alias("ok"))


def _known(spark, d):
    return table(spark, d, "part").filter("p_size <= 45").select(F.col("p_partkey").alias("layer_id"))


_CH_SQL = f"""
SELECT o.o_custkey, {_GID} AS group_id, l.l_partkey AS layer_id
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey WHERE l.l_linestatus = 'O'
"""


@scenario(
    "dangling_children",
    f"SELECT * FROM ({_CH_SQL}) WHERE layer_id NOT IN (SELECT p_partkey FROM part WHERE p_size <= 45)",
)
def dangling_children(spark, d):
    return C.dangling_children(_groups(spark, d), _known(spark, d), "o_custkey").select("o_custkey", "group_id", "layer_id")


@scenario(
    "ungrouped_layers",
    f"""
WITH layers AS (SELECT DISTINCT o.o_custkey, l.l_partkey AS layer_id FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey),
grouped AS (SELECT DISTINCT o_custkey, layer_id FROM ({_CH_SQL}))
SELECT o_custkey, layer_id, 'single-' || CAST(layer_id AS VARCHAR) AS group_id FROM (SELECT * FROM layers EXCEPT SELECT * FROM grouped)
""",
)
def ungrouped_layers(spark, d):
    o = table(spark, d, "orders")
    li = table(spark, d, "lineitem")
    layers = o.join(li, F.col("l_orderkey") == F.col("o_orderkey")).select("o_custkey", F.col("l_partkey").alias("layer_id"))
    return C.ungrouped_layers(layers, _groups(spark, d), "o_custkey").select("o_custkey", "layer_id", "group_id")


@scenario(
    "group_binding",
    f"""
WITH ch AS ({_CH_SQL}),
k AS (SELECT p_partkey AS layer_id, CASE WHEN p_size <= 25 THEN 'image' ELSE 'text' END AS kind FROM part WHERE p_size <= 45),
b AS (SELECT ch.*, k.kind FROM ch LEFT JOIN k USING (layer_id))
SELECT o_custkey, group_id,
  coalesce(array_to_string(list_sort(list_distinct(list(layer_id) FILTER (WHERE kind = 'image'))), ','), '') AS image_layers,
  coalesce(array_to_string(list_sort(list_distinct(list(layer_id) FILTER (WHERE kind = 'text'))), ','), '') AS text_layers,
  count(*) FILTER (WHERE kind IS NULL) AS unknown,
  count(*) FILTER (WHERE kind = 'image') > 0 AND count(*) FILTER (WHERE kind = 'text') > 0 AS binds
FROM b GROUP BY o_custkey, group_id
""",
)
def group_binding(spark, d):
    part = table(spark, d, "part")
    images = part.filter("p_size <= 25").select(F.col("p_partkey").alias("layer_id"))
    texts = part.filter("p_size > 25 AND p_size <= 45").select(F.col("p_partkey").alias("layer_id"))
    b = C.group_binding(_groups(spark, d), images, texts, "o_custkey")
    return b.select(
        "o_custkey",
        "group_id",
        F.array_join(F.col("image_layers").cast("array<string>"), ",").alias("image_layers"),
        F.array_join(F.col("text_layers").cast("array<string>"), ",").alias("text_layers"),
        "unknown",
        "binds",
    )


_KEY_CASES = "p_partkey % 10 = 0", "p_partkey % 7 = 0", "p_partkey % 11 = 0", "p_partkey % 13 = 0"
_CLEAN = [f for f in C.TEXT_FIELDS if f not in ("width", "font", "font_size", "capitalize")]


@scenario(
    "text_field_report",
    "SELECT f.field, p.elements, f.absent, f.nulls AS \"null\", f.mistyped FROM (SELECT count(*) AS elements FROM part) p, ("
    + " UNION ALL ".join(
        [f"SELECT 'width' AS field, count(*) FILTER ({_KEY_CASES[0]}) AS absent, 0 AS nulls, 0 AS mistyped FROM part", f"SELECT 'font', 0, count(*) FILTER ({_KEY_CASES[1]}), 0 FROM part"]
        + [f"SELECT '{f}', 0, 0, count(*) FILTER ({c}) FROM part" for f, c in (("font_size", _KEY_CASES[2]), ("capitalize", _KEY_CASES[3]))]
        + [f"SELECT '{f}', 0, 0, 0" for f in _CLEAN]
    )
    + ") f",
)
def text_field_report(spark, d):
    """Every part as a text element whose fields are now and then left out,
    null, or of another type."""
    given = {"layer_id": "1", "type": '"TextElement"', "height": "10", "opacity": "0.5", "text": '"a, \\"b\\""', "text_align": '"center"', "angle": "-0.25", "line_height": "1.0", "letter_spacing": "1e-3"}
    fixed = ", ".join(f'"{k}": {v}' for k, v in given.items())
    left_out, null, text, number = (F.expr(c) for c in _KEY_CASES)
    body = F.concat(
        F.lit(" [{" + fixed), F.when(left_out, "").otherwise(', "width": 12.5'), F.when(null, ', "font": null').otherwise(', "font": "Arial"'),
        F.when(text, ', "font_size": "12"').otherwise(', "font_size": 12'), F.when(number, ', "capitalize": 1').otherwise(', "capitalize": false'), F.lit("}]"),
    )
    checked = C.text_field_status(table(spark, d, "part").select("p_partkey", body.alias("block")), "p_partkey", "block")
    return C.text_field_report(checked).select("field", "elements", "absent", "null", "mistyped")


@scenario(
    "text_elements",
    """
SELECT p_partkey, CAST(0 AS BIGINT) AS epos, p_partkey AS layer_id, p_name AS text, p_brand AS font,
  CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE p_retailprice END AS width, CAST(p_size AS DOUBLE) AS font_size,
  p_size % 2 = 0 AS capitalize, CAST(CASE WHEN p_partkey % 10 = 0 THEN 1 ELSE 0 END AS BIGINT) AS missing
FROM part
""",
)
def text_elements(spark, d):
    p = table(spark, d, "part")
    el = F.struct(
        F.col("p_partkey").alias("layer_id"),
        F.lit("TextElement").alias("type"),
        F.when(F.col("p_partkey") % 10 != 0, F.col("p_retailprice")).alias("width"),
        F.col("p_size").cast("double").alias("height"),
        F.lit(1.0).alias("opacity"),
        F.col("p_name").alias("text"),
        F.col("p_brand").alias("font"),
        F.col("p_size").cast("double").alias("font_size"),
        F.lit("center").alias("text_align"),
        F.lit(0.0).alias("angle"),
        (F.col("p_size") % 2 == 0).alias("capitalize"),
        F.lit(1.0).alias("line_height"),
        F.lit(0.0).alias("letter_spacing"),
    )
    # JSON text as a planner would write it (a missing width is left out)
    js = p.select("p_partkey", F.to_json(F.array(el)).alias("js"))
    parsed = js.select("p_partkey", J.strict_json(F.col("js"), f"array<{J.TEXT_ELEMENT}>")["v"].alias("items"))
    flat = C.text_elements(parsed, "p_partkey", "items")
    return flat.select("p_partkey", "epos", "layer_id", "text", "font", "width", "font_size", "capitalize", "missing")
