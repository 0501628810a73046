"""Skew-safe building blocks shared by the operators.

Rules kept throughout the library:

* "first"/"last" row per key is an aggregate (``min_by``/``max_by`` on a
  unique order struct), never a ``row_number`` window: aggregates combine
  map-side, so a key holding a third of all rows is reduced before the
  shuffle instead of landing whole in one task.
* Ordered text per key is built in two levels: bounded chunks of the order
  column first, then the chunk strings.
* A broadcast hint is only given behind a row-count check.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cols(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def order_struct(order: str | Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in _cols(order)])


def _pick(df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str], fn) -> DataFrame:
    keys = _cols(keys)
    rest = [c for c in df.columns if c not in keys]
    picked = fn(F.struct(*[F.col(c) for c in rest]), order_struct(order)).alias("_row")
    return df.groupBy(*keys).agg(picked).select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


def first_by(df: DataFrame, keys, order) -> DataFrame:
    """The row with the smallest ``order`` per key (order must be unique per key)."""
    return _pick(df, keys, order, F.min_by)


def last_by(df: DataFrame, keys, order) -> DataFrame:
    """The row with the largest ``order`` per key (order must be unique per key)."""
    return _pick(df, keys, order, F.max_by)


def ordered_concat(
    df: DataFrame,
    keys: str | Sequence[str],
    pos: str,
    value: str,
    sep: str = "",
    out: str = "text",
    chunk_rows: int = 1024,
    null_policy: str = "propagate",
) -> DataFrame:
    """``value`` strings of each key joined by ``sep`` in ascending ``pos``.

    ``pos`` is numeric and unique within a key.  Level one joins chunks of
    ``chunk_rows`` consecutive positions (a hot key is spread over many
    groups and tasks); level two joins the chunk strings of a key.  With
    ``null_policy='propagate'`` a NULL value makes the key's result NULL,
    with ``'skip'`` NULL values are left out.
    """
    keys = _cols(keys)
    chunk = F.floor(F.col(pos) / F.lit(chunk_rows)).alias("_chunk")
    level1 = (
        df.select(*keys, F.col(pos).alias("_pos"), F.col(value).alias("_val"), chunk)
        .groupBy(*keys, "_chunk")
        .agg(
            F.array_join(
                F.transform(F.sort_array(F.collect_list(F.struct("_pos", "_val"))), lambda x: x["_val"]), sep
            ).alias("_part"),
            F.min("_pos").alias("_first"),
            F.max(F.col("_val").isNull()).alias("_has_null"),
        )
    )
    level2 = level1.groupBy(*keys).agg(
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct("_first", "_part"))), lambda x: x["_part"]), sep
        ).alias("_text"),
        F.max("_has_null").alias("_has_null"),
    )
    if null_policy == "propagate":
        text = F.when(~F.col("_has_null"), F.col("_text"))
    elif null_policy == "skip":
        text = F.col("_text")
    else:
        raise ValueError("null_policy is 'propagate' or 'skip'")
    return level2.select(*keys, text.alias(out))
