"""Validators for the plan-document contract the planner is asked to follow.

A plan has four tagged blocks, each exactly once, in the order thought ->
grouping (right after the thought) -> image prompts -> text elements.
Groups have an id unique in the plan, children that are known layers and a
2-6 word theme; every layer belongs to a group or stands as its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atelier.constants import PLAN_TAGS, PY_WHITESPACE_CLASS
from atelier.functions.jsonparse import TEXT_ELEMENT
from atelier.functions.text import _col, strip, tag_count
from atelier.functions.variants import ABSENT, MISTYPED, NULL, field_status


def tag_multiplicity(text, tags: Sequence[str] = PLAN_TAGS) -> Column:
    """``struct(<tag>_open, <tag>_close ..., ok)``: counts of each opening and
    closing tag; ok when all are exactly 1."""
    fields, ok = [], F.lit(True)
    for t in tags:
        o, c = tag_count(text, t), tag_count(text, t, closing=True)
        fields += [o.alias(f"{t}_open"), c.alias(f"{t}_close")]
        ok = ok & (o == 1) & (c == 1)
    return F.struct(*fields, F.coalesce(ok, F.lit(False)).alias("ok"))


def tag_order(text, tags: Sequence[str] = PLAN_TAGS, adjacent: tuple[str, str] | None = (PLAN_TAGS[0], PLAN_TAGS[1])) -> Column:
    """True when each tag's first opening follows the previous tag's first
    closing, and -- for ``adjacent`` -- only whitespace lies between the
    first block's close and the second block's open."""
    col = _col(text)
    ok = F.lit(True)
    prev_close = None
    for t in tags:
        o = F.instr(col, f"<{t}>")
        c = F.instr(col, f"</{t}>")
        ok = ok & (o > 0) & (c > o)
        if prev_close is not None:
            ok = ok & (o > prev_close)
        prev_close = c
    if adjacent:
        a, b = adjacent
        gap = rf"(?s)</{a}>{PY_WHITESPACE_CLASS}*<{b}>"
        ok = ok & col.rlike(gap)
    return F.coalesce(ok, F.lit(False))


def theme_words(theme, lo: int = 2, hi: int = 6) -> Column:
    """Word count of the stripped theme is within ``[lo, hi]``."""
    s = strip(theme)
    n = F.when(s == "", F.lit(0)).otherwise(F.size(F.split(s, f"{PY_WHITESPACE_CLASS}+")))
    return F.coalesce(n.between(lo, hi), F.lit(False))


def explode_groups(plans: DataFrame, id_col: str, groups: str) -> DataFrame:
    """``(id, gpos, group_id, children, theme)`` from an array of groups."""
    return plans.select(id_col, F.posexplode(groups).alias("gpos", "_g")).select(
        id_col, F.col("gpos").cast("bigint").alias("gpos"), "_g.group_id", "_g.children", "_g.theme"
    )


def group_schema(groups: DataFrame, id_col: str) -> DataFrame:
    """Per plan: groups, missing fields, repeated ``group_id``s, bad themes."""
    return groups.groupBy(id_col).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_groups"),
        F.count_if(F.col("group_id").isNull() | F.col("children").isNull() | F.col("theme").isNull()).cast("bigint").alias("missing_fields"),
        (F.count(F.col("group_id")) - F.count_distinct(F.col("group_id"))).cast("bigint").alias("repeated_ids"),
        F.count_if(~theme_words(F.col("theme"))).cast("bigint").alias("bad_themes"),
    ).withColumn("ok", (F.col("missing_fields") == 0) & (F.col("repeated_ids") == 0) & (F.col("bad_themes") == 0))


def group_children(groups: DataFrame, id_col: str | None) -> DataFrame:
    keys = [id_col] if id_col else []
    return groups.select(*keys, "group_id", F.explode("children").alias("layer_id"))


def dangling_children(groups: DataFrame, layers: DataFrame, id_col: str | None = None) -> DataFrame:
    """Children that are no known layer (left anti join).  ``layers`` holds
    ``layer_id`` (and ``id_col`` when layers are per plan)."""
    ch = group_children(groups, id_col)
    keys = ["layer_id"] + ([id_col] if id_col and id_col in layers.columns else [])
    return ch.join(layers.select(*keys).distinct(), keys, "left_anti")


def ungrouped_layers(layers: DataFrame, groups: DataFrame, id_col: str) -> DataFrame:
    """Layers in no group, each turned into its own singleton group
    (``group_id = 'single-<layer_id>'``)."""
    ch = group_children(groups, id_col).select(id_col, "layer_id").distinct()
    lone = layers.select(id_col, "layer_id").distinct().join(ch, [id_col, "layer_id"], "left_anti")
    return lone.withColumn("group_id", F.concat(F.lit("single-"), F.col("layer_id").cast("string")))


def group_binding(groups: DataFrame, images: DataFrame, texts: DataFrame, id_col: str) -> DataFrame:
    """Per group: its image layers and text layers (sorted ids), and whether
    it binds at least one of each.  Group size is bounded by one plan."""
    ch = group_children(groups, id_col)
    # layers are per plan when they carry the plan id, else global
    keys = [id_col, "layer_id"] if id_col in images.columns else ["layer_id"]
    img = images.select(*keys).distinct().withColumn("_kind", F.lit("image"))
    txt = texts.select(*keys).distinct().withColumn("_kind", F.lit("text"))
    kinds = img.unionByName(txt)
    bound = ch.join(kinds, keys, "left")
    return bound.groupBy(id_col, "group_id").agg(
        F.array_sort(F.collect_set(F.when(F.col("_kind") == "image", F.col("layer_id")))).alias("image_layers"),
        F.array_sort(F.collect_set(F.when(F.col("_kind") == "text", F.col("layer_id")))).alias("text_layers"),
        F.count_if(F.col("_kind").isNull()).cast("bigint").alias("unknown"),
    ).withColumn("binds", (F.size("image_layers") > 0) & (F.size("text_layers") > 0))


TEXT_FIELDS = [f.split(":")[0] for f in TEXT_ELEMENT[len("struct<"):-1].split(",")]


def text_elements(elements: DataFrame, id_col: str, items: str) -> DataFrame:
    """Flatten text elements to a typed table with ``missing`` = number of
    NULL (absent or mistyped) fields per element."""
    flat = elements.select(id_col, F.posexplode(items).alias("epos", "_e")).select(
        id_col, F.col("epos").cast("bigint").alias("epos"), *[F.col("_e")[f].alias(f) for f in TEXT_FIELDS]
    )
    missing = sum((F.col(f).isNull().cast("int") for f in TEXT_FIELDS), F.lit(0))
    return flat.withColumn("missing", missing.cast("bigint"))


def text_field_status(blocks: DataFrame, id_col: str, block: str, fields: str = TEXT_ELEMENT) -> DataFrame:
    """Per element of a JSON array (the body of a text block): ``id_col``,
    ``epos``, ``element`` (VARIANT) and ``status``, a struct of each field's
    status: OK, ABSENT, NULL or MISTYPED.  A block that is no JSON array has no
    elements."""
    items = F.try_variant_get(F.try_parse_json(F.col(block)), "$", "array<variant>")
    flat = blocks.select(id_col, F.posexplode(items).alias("epos", "element"))
    kinds = [f.split(":") for f in fields[len("struct<") : -1].split(",")]
    status = F.struct(*[field_status(F.col("element"), name, kind).alias(name) for name, kind in kinds])
    return flat.select(id_col, F.col("epos").cast("bigint").alias("epos"), "element", status.alias("status"))


def text_field_report(checked: DataFrame, fields: Sequence[str] = TEXT_FIELDS) -> DataFrame:
    """One row per field over all elements of ``text_field_status``: ``elements``,
    ``absent``, ``null``, ``mistyped``, and ``types``, the type that holds all
    values of the field."""
    aggs = [F.count(F.lit(1)).alias("elements")]
    for f in fields:
        aggs += [F.count_if(F.col(f"status.{f}") == s).alias(f"{f}__{s}") for s in (ABSENT, NULL, MISTYPED)]
        aggs.append(F.schema_of_variant_agg(F.try_variant_get("element", f"$.{f}", "variant")).alias(f"{f}__types"))
    rows = F.array(*[F.struct(F.lit(f).alias("field"), F.col("elements"), *[F.col(f"{f}__{s}").alias(n) for s, n in ((ABSENT, "absent"), (NULL, "null"), (MISTYPED, "mistyped"), ("types", "types"))]) for f in fields])
    return checked.agg(*aggs).select(F.inline(rows))


def plan_report(flags: DataFrame, id_col: str, rules: Sequence[str]) -> DataFrame:
    """One row per rule: plans checked and plans failing it (``flags`` has a
    boolean column per rule, true = passed)."""
    long = flags.select(id_col, *[F.col(r).cast("boolean").alias(r) for r in rules]).unpivot([id_col], list(rules), "rule", "passed")
    return long.groupBy("rule").agg(
        F.count(F.lit(1)).cast("bigint").alias("plans"), F.count_if(~F.coalesce(F.col("passed"), F.lit(False))).cast("bigint").alias("failing")
    )
