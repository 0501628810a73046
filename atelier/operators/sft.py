"""Supervised fine-tuning data: prompt/completion pairs and length budgets."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atelier.constants import CHATML_END_LINE, PLAN_TAGS, PLANNER_SYSTEM_PROMPT, SFT_MAX_LENGTH
from atelier.functions.chat import CHATML, ChatTemplate, chat_messages, chat_render
from atelier.functions.text import tag_count

TRAINING_SCHEMA = "prompt string, layout_thought string, grouping string, image_generator string, generate_text string"
REJECTED_NULL_BLOCK = "REJECTED_NULL_BLOCK"


def sft_pairs(
    df: DataFrame,
    blocks: Sequence[str] = PLAN_TAGS,
    prompt: str = "prompt",
    system: str = PLANNER_SYSTEM_PROMPT,
    template: ChatTemplate = CHATML,
    end: str = CHATML_END_LINE,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``(keep..., status, prompt, completion)``.

    prompt = rendered ``[system, user]`` chat plus the generation prompt;
    completion = the blocks joined by newlines plus the end marker.  A NULL
    block or prompt rejects the row (status ``REJECTED_NULL_BLOCK``, NULL
    pair) instead of being skipped -- ``concat`` propagates NULL on purpose.
    """
    p = chat_render(chat_messages(system, F.col(prompt)), template)
    parts: list[Column] = []
    for i, b in enumerate(blocks):
        if i:
            parts.append(F.lit("\n"))
        parts.append(F.col(b))
    completion = F.concat(*parts, F.lit(end))
    ok = p.isNotNull() & completion.isNotNull()
    return df.select(
        *keep,
        F.when(ok, F.lit("OK")).otherwise(F.lit(REJECTED_NULL_BLOCK)).alias("status"),
        F.when(ok, p).alias("prompt"),
        F.when(ok, completion).alias("completion"),
    )


def char_length(c: Column) -> Column:
    return F.length(c).cast("bigint")


def sft_budget(
    df: DataFrame,
    prompt: str = "prompt",
    completion: str = "completion",
    max_length: int = SFT_MAX_LENGTH,
    length_fn: Callable[[Column], Column] = char_length,
) -> DataFrame:
    """Lengths against the training budget.  Rows are cut at ``max_length``
    and the loss covers the completion only, so the kept completion is what
    fits after the prompt.  ``length_fn`` maps a string column to a length
    (characters by default, ``token_length`` for tokens)."""
    pl = length_fn(F.col(prompt)).cast("bigint")
    cl = length_fn(F.col(completion)).cast("bigint")
    return df.withColumns(
        {
            "prompt_len": pl,
            "completion_len": cl,
            "over_budget": (pl + cl) > F.lit(max_length),
            "kept_completion_len": F.greatest(F.lit(0).cast("bigint"), F.least(cl, F.lit(max_length) - pl)),
        }
    )


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _slices(*columns: pa.Array, rows: int = 256, size: int = 1 << 20) -> Iterator[list[pa.Array]]:
    """Consecutive rows of the columns, of about ``size`` bytes of text."""
    n = len(columns[0])
    ends = sum(np.cumsum(np.asarray(pc.fill_null(pc.binary_length(c), 0), np.int64)) for c in columns)
    i = 0
    while i < n:
        until = int(np.searchsorted(ends, (ends[i - 1] if i else 0) + size, "right"))
        j = min(max(until, i + 1), i + rows, n)
        yield [c.slice(i, j - i) for c in columns]
        i = j


def _token_ids(path: str, texts: pa.Array) -> list[list[int] | None]:
    """Ids of each text, without the tokenizer's own additions; None for null."""
    part = texts.to_pylist()
    made = _tokenizer(path).encode_batch_fast([t or "" for t in part], add_special_tokens=False)
    return [None if t is None else e.ids for t, e in zip(part, made, strict=True)]


def token_length(path: str) -> Callable[[Column], Column]:
    """A ``length_fn`` that counts the tokens of a tokenizer file (a path on
    every machine)."""

    def run(texts: pa.Array) -> pa.Array:
        return pa.array([None if ids is None else len(ids) for (part,) in _slices(texts) for ids in _token_ids(path, part)], pa.int64())

    return lambda c: F.arrow_udf(run, "bigint")(c.cast("string"))


def sft_tokens(df: DataFrame, path: str, prompt: str = "prompt", completion: str = "completion", max_length: int = SFT_MAX_LENGTH, out: str = "tokens") -> DataFrame:
    """Adds ``out``: the training example as token ids, cut at ``max_length``.

    ``ids``: prompt and completion, what fits; ``n_prompt`` and
    ``n_completion``: before the cut; the loss covers ``[loss_start,
    loss_end)``, the completion's ids that are left (none if the prompt alone
    fills the budget).  NULL for a pair with a null side.  Both sides are
    tokenized apart, so that the border is one between tokens.
    """

    kind = pa.struct([("ids", pa.list_(pa.int32())), *((n, pa.int64()) for n in ("n_prompt", "n_completion", "loss_start", "loss_end"))])

    def example(p: list[int] | None, c: list[int] | None) -> dict | None:
        if p is None or c is None:
            return None
        start = min(len(p), max_length)
        ids = (p + c)[:max_length]
        return {"ids": ids, "n_prompt": len(p), "n_completion": len(c), "loss_start": start, "loss_end": max(start, len(ids))}

    def run(prompts: pa.Array, completions: pa.Array) -> pa.Array:
        # a slice's ids are Python numbers, those of a whole batch never
        made = [pa.array([example(p, c) for p, c in zip(_token_ids(path, a), _token_ids(path, b), strict=True)], kind) for a, b in _slices(prompts, completions)]
        return pa.concat_arrays(made) if made else pa.array([], kind)

    schema = "ids array<int>, n_prompt bigint, n_completion bigint, loss_start bigint, loss_end bigint"
    return df.withColumn(out, F.arrow_udf(run, schema)(F.col(prompt).cast("string"), F.col(completion).cast("string")))


def training_columns(df: DataFrame, blocks: Sequence[str] = PLAN_TAGS) -> DataFrame:
    """Per training row: each block non-null, and each tagged exactly once
    with its own tag (``<b>`` and ``</b>`` once each)."""
    cols = {}
    all_ok = F.lit(True)
    for b in blocks:
        present = F.col(b).isNotNull()
        tagged = (tag_count(F.col(b), b) == 1) & (tag_count(F.col(b), b, closing=True) == 1)
        cols[f"{b}_present"] = present
        cols[f"{b}_tagged"] = F.coalesce(tagged, F.lit(False))
        all_ok = all_ok & present & F.coalesce(tagged, F.lit(False))
    cols["row_ok"] = all_ok
    return df.withColumns(cols)


def training_report(checked: DataFrame, blocks: Sequence[str] = PLAN_TAGS) -> DataFrame:
    """Null and tag-failure counts per block, one row per block."""
    aggs = []
    for b in blocks:
        aggs += [
            F.count_if(~F.col(f"{b}_present")).alias(f"{b}__nulls"),
            F.count_if(~F.col(f"{b}_tagged")).alias(f"{b}__untagged"),
        ]
    wide = checked.agg(*aggs)
    stack = ", ".join(f"'{b}', `{b}__nulls`, `{b}__untagged`" for b in blocks)
    return wide.selectExpr(f"stack({len(blocks)}, {stack}) as (block, nulls, untagged)").select(
        "block", F.col("nulls").cast("bigint"), F.col("untagged").cast("bigint")
    )
