"""Plan documents -> one row per image layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atelier.functions.jsonparse import OK, parse_layers


def parse_plan_layers(df: DataFrame, text: str, keep: Sequence[str], tag: str = "image_generator") -> DataFrame:
    """``(keep..., status, items)``: the strict parse of each plan's layer block."""
    return df.select(*keep, parse_layers(F.col(text), tag).alias("_r")).select(*keep, "_r.status", "_r.items")


def explode_layers(parsed: DataFrame, keep: Sequence[str], items: str = "items", outer: bool = False) -> DataFrame:
    """One row per layer in list order, duplicates kept: ``(keep..., pos,
    layer_id, layer_prompt)``.  Only plans with status OK have items; with
    ``outer`` every plan keeps at least one row (``pos`` NULL when empty)."""
    src = parsed if outer else parsed.filter(F.col("status") == OK)
    fn = F.posexplode_outer if outer else F.posexplode
    return src.select(*keep, fn(items).alias("pos", "_l")).select(
        *keep,
        F.col("pos").cast("bigint").alias("pos"),
        F.col("_l.layer_id").alias("layer_id"),
        F.col("_l.layer_prompt").alias("layer_prompt"),
    )
