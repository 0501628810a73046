"""Sinks: tables keyed by id instead of one file per example."""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atelier.sources.committed import write_committed


def write_intake(df: DataFrame, path: str) -> None:
    """Persist the intake (fixes the file-order positions for later runs)."""
    df.write.mode("overwrite").parquet(path)


def write_layout_prompts(df: DataFrame, path: str, partition_by: str | None = "shard") -> None:
    """``(id, layout_prompt[, shard])`` as parquet, partitioned by shard so a
    shard's run reads only its folder."""
    w = df.write.mode("overwrite")
    if partition_by and partition_by in df.columns:
        w = w.partitionBy(partition_by)
    w.parquet(path)


def write_artifacts(df: DataFrame, path: str, stage: str, round_: int = 0, key: str | None = None) -> None:
    """Append ``(id, path, ok, stage, round, ...)`` to the artifact lineage:
    a path that ``df`` doesn't have is NULL, and an artifact is ok unless
    ``df`` says otherwise.  ``key`` names the job: run again under the same key
    it adds nothing more (see ``committed``)."""
    out = df.withColumn("round", F.lit(round_))
    for name, value in (("path", F.lit(None).cast("string")), ("ok", F.lit(True))):
        if name not in df.columns:
            out = out.withColumn(name, value)
    write_committed(out, path, f"{stage}-{round_}-{key or uuid.uuid4().hex}", ("stage", stage))


def copy_stage(df: DataFrame, new_stage: str) -> DataFrame:
    """A stage that is a byte copy of another (repair changes image files,
    not the HTML): the same rows with a new ``stage`` literal."""
    return df.withColumn("stage", F.lit(new_stage))


def write_repair_summary(df: DataFrame, path: str) -> None:
    """Summaries only for examples with at least one bad layer."""
    df.filter(F.size("refined_layers") > 0).write.mode("overwrite").json(path)


def write_ledger(df: DataFrame, path: str, run_id: str | None = None, status: str = "success", key: str | None = None) -> str:
    """Append ``(id, pos, status, stage, ts, run_id)``; returns the run id.

    The rows appear together when the job commits, and once: the same job run
    again with the same run id and ``key`` (the status, unless a run writes its
    successes or failures in several jobs) adds nothing more.  Without a run id
    each call is a run of its own.

    ``pos`` and ``stage`` (where a failure happened) are taken from ``df`` if
    it has them; a ``status`` column there goes before the argument.  The
    failures in force are those of the latest run, see ``current_failures``.
    """
    rid = run_id or f"{_dt.datetime.now(_dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    has = lambda c, kind: F.col(c).cast(kind) if c in df.columns else F.lit(None).cast(kind)
    out = df.select(
        F.col("id").cast("string").alias("id"),
        has("pos", "bigint").alias("pos"),
        F.coalesce(has("status", "string"), F.lit(status)).alias("status"),
        has("stage", "string").alias("stage"),
        F.current_timestamp().alias("ts"),
    )
    write_committed(out, path, f"{rid}-{key or status}", ("run_id", rid))
    return rid
