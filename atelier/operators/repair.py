"""Image repair analytics and outcome classification.

Bad layers come from the critic's verdict; each is matched to its prompt in
the plan (first plan entry wins), regenerated, and summarised.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atelier.constants import STATUS_DEPRECATED
from atelier.functions.text import _col
from atelier.operators.agg import first_by, order_struct
from atelier.operators.runs import ROUND_SALTS

SELECTED = "SELECTED"
SKIPPED = "SKIPPED"


def plan_prompts(plan: DataFrame, id_col: str, layer_id: str, prompt: str, pos) -> DataFrame:
    """First prompt per (example, layer id) in plan order."""
    return first_by(plan.select(id_col, layer_id, prompt, *([pos] if isinstance(pos, str) else pos)), [id_col, layer_id], pos).select(
        id_col, layer_id, prompt
    )


def repair_select(bad: DataFrame, plan: DataFrame, id_col: str, layer_id: str = "layer_id", prompt: str = "layer_prompt", plan_pos="pos") -> DataFrame:
    """Each bad layer with its prompt; no prompt or an empty one -> SKIPPED."""
    prompts = plan_prompts(plan, id_col, layer_id, prompt, plan_pos)
    out = bad.join(prompts, [id_col, layer_id], "left")
    sel = F.col(prompt).isNotNull() & (F.length(F.col(prompt)) > 0)
    return out.withColumn("selection", F.when(sel, F.lit(SELECTED)).otherwise(F.lit(SKIPPED)))


def refine_rate(n_bad, n_layers) -> Column:
    """``len(bad_layers) / len(layers)``; an empty plan gives NULL, not an error."""
    return F.try_divide(_col(n_bad).cast("double"), _col(n_layers).cast("double"))


def repair_summary(
    bad: DataFrame,
    plan: DataFrame,
    id_col: str,
    bad_pos: str = "bad_pos",
    layer_id: str = "layer_id",
    prompt: str = "layer_prompt",
    plan_pos: str = "pos",
    reasons: DataFrame | None = None,
) -> DataFrame:
    """Per example with at least one bad layer: ``refine_rate`` (duplicates
    and skipped layers count), the bad layer list in verdict order, the
    reasons and the ``layer -> prompt`` map of the selected layers, plus the
    summary as JSON text.

    The lists are per verdict, i.e. bounded by one model response.
    """
    sel = repair_select(bad, plan, id_col, layer_id, prompt, plan_pos)
    per_bad = sel.groupBy(id_col).agg(
        F.count(F.lit(1)).alias("n_bad"),
        F.transform(F.sort_array(F.collect_list(F.struct(F.col(bad_pos), F.col(layer_id)))), lambda x: x[layer_id]).alias(
            "refined_layers"
        ),
        F.map_from_entries(
            F.array_sort(
                F.array_distinct(
                    F.collect_list(F.when(F.col("selection") == SELECTED, F.struct(F.col(layer_id).cast("string").alias("k"), F.col(prompt).alias("v"))))
                )
            )
        ).alias("layer_prompt"),
    )
    n_plan = plan.groupBy(id_col).agg(F.count(F.lit(1)).alias("n_layers"))
    out = per_bad.join(n_plan, id_col, "left").withColumn("n_layers", F.coalesce(F.col("n_layers"), F.lit(0)))
    if reasons is not None:
        out = out.join(reasons, id_col, "left")
    else:
        out = out.withColumn("reason", F.create_map().cast("map<string,string>"))
    out = out.withColumn("refine_rate", refine_rate("n_bad", "n_layers"))
    summary = F.to_json(F.struct("refine_rate", "refined_layers", "reason", "layer_prompt"))
    return out.withColumn("summary_json", summary)


def repair_run_status(regens: DataFrame, id_col: str, order, ok: str) -> DataFrame:
    """Regenerations run in verdict order and stop at the first failure:
    ``(id, ok, replaced)``; ``replaced`` counts the layers regenerated before
    the failure.  Aggregates and a salted join, no per-id window."""
    r = regens.select(F.col(id_col), order_struct(order).alias("_o"), F.col(ok).alias("_ok"))
    ff = r.groupBy(id_col).agg(F.min(F.when(~F.col("_ok"), F.col("_o"))).alias("_ff"))
    # a copy of the per-id row for each salt, so that a hot id spreads over tasks
    salts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(ROUND_SALTS - 1).cast("bigint")))
    part = (
        r.withColumn("_salt", F.pmod(F.xxhash64("_o"), F.lit(ROUND_SALTS)))
        .join(ff.withColumn("_salt", salts), [id_col, "_salt"])
        .groupBy(id_col, "_salt")
        .agg(F.count_if(F.col("_ff").isNull() | (F.col("_o") < F.col("_ff"))).alias("_n"), F.bool_and(F.col("_ff").isNull()).alias("_all"))
    )
    return part.groupBy(id_col).agg(F.bool_and("_all").alias("ok"), F.sum("_n").cast("bigint").alias("replaced"))


# ------------------------------------------------------------ classification

DEPRECATED = "DEPRECATED"
API_STATUS = "API_STATUS"
API_ERROR = "API_ERROR"
UNEXPECTED = "UNEXPECTED"


def error_class(kind, status_code, message, raw) -> Column:
    """``struct(error_class, error_text)`` of a failed model call.

    ``kind`` is ``'status'`` (HTTP status error), ``'api'`` (other API error)
    or anything else (unexpected).  The text is the message when present,
    else the raw string form.
    """
    k = _col(kind)
    cls = (
        F.when((k == "status") & (_col(status_code) == STATUS_DEPRECATED), F.lit(DEPRECATED))
        .when(k == "status", F.lit(API_STATUS))
        .when(k == "api", F.lit(API_ERROR))
        .otherwise(F.lit(UNEXPECTED))
    )
    return F.struct(cls.alias("error_class"), F.coalesce(_col(message), _col(raw)).alias("error_text"))


def image_outcome(generated, checked, key_colour, edited) -> Column:
    """The five paths of one layer regeneration, as
    ``struct(ok, final_source, temp_left)``:

    generate fails -> not ok, nothing written; colour check call fails ->
    temp image promoted, not ok; no key colour -> temp promoted, ok; key
    colour and edit ok -> edited image, ok, temp left behind; edit fails ->
    temp promoted, not ok.
    """
    g, c, kc, e = (F.coalesce(_col(x), F.lit(False)) for x in (generated, checked, key_colour, edited))
    ok = F.when(~g, False).when(~c, False).when(~kc, True).otherwise(e)
    src = F.when(~g, F.lit(None).cast("string")).when(~c | ~kc, F.lit("temp")).when(e, F.lit("edited")).otherwise(F.lit("temp"))
    temp_left = g & c & kc & e
    return F.struct(ok.alias("ok"), src.alias("final_source"), temp_left.alias("temp_left"))


def verdict_status(call_ok, verdict_status_col, n_bad, regen_ok) -> Column:
    """Image-repair stage result as ``struct(ok, writes_summary, reason)``.

    call failed -> fail; verdict not parsable -> fail; no bad layers -> ok
    without summary; a regeneration failed -> fail (earlier layers already
    replaced); else ok with summary.
    """
    call = F.coalesce(_col(call_ok), F.lit(False))
    parsed = F.coalesce(_col(verdict_status_col) == "OK", F.lit(False))
    nb = F.coalesce(_col(n_bad), F.lit(0))
    regen = F.coalesce(_col(regen_ok), F.lit(False))
    reason = (
        F.when(~call, F.lit("CALL_FAILED"))
        .when(~parsed, F.lit("VERDICT_INVALID"))
        .when(nb == 0, F.lit("NO_BAD_LAYERS"))
        .when(~regen, F.lit("REGENERATION_FAILED"))
        .otherwise(F.lit("REPAIRED"))
    )
    ok = reason.isin("NO_BAD_LAYERS", "REPAIRED")
    return F.struct(ok.alias("ok"), (reason == "REPAIRED").alias("writes_summary"), reason.alias("reason"))
