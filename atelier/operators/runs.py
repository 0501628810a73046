"""Run bookkeeping: intake, sharding, resume ledgers, duplicate ids, rounds,
stage outcomes and their counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from atelier.functions.jsonparse import STRICT_OPTIONS, strict_json
from atelier.functions.text import strip
from atelier.operators.agg import _cols, order_struct
from atelier.session import written

# Intake statuses.
BLANK = "BLANK"
MALFORMED = "MALFORMED"
MISSING_KEY = "MISSING_KEY"
MISTYPED = "MISTYPED"
OK = "OK"

# Ledger statuses.
SUCCESS = "success"
FAILURE = "failure"
PENDING = "pending"


def _schema(value_schema: T.StructType | str) -> T.StructType:
    return value_schema if isinstance(value_schema, T.StructType) else T.StructType.fromDDL(value_schema)


def intake_lines(
    lines: DataFrame,
    line: str = "value",
    required: Sequence[str] = ("id", "prompt"),
    value_schema: T.StructType | str = "id string, prompt string",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Classify JSONL lines and type the good ones.

    status: BLANK (empty or whitespace), MALFORMED (not one JSON value as
    ``json.loads`` reads it), MISSING_KEY (not an object, or a required key
    absent), MISTYPED (a field of ``value_schema`` is there, not null, and not
    of its type), OK.  A key with an explicit ``null`` is present (the value
    column is then NULL, see ``has_null``).  Output: ``keep`` columns,
    ``status``, ``has_null`` and the fields of ``value_schema`` (a
    ``StructType`` or its DDL).
    """
    schema = _schema(value_schema)
    raw = F.col(line)
    read = lines.select(
        *keep,
        raw.alias("_line"),
        strip(raw).alias("_s"),
        strict_json(raw, schema.simpleString(), stripped=False).alias("_p"),
        F.from_json(raw, "map<string,string>", STRICT_OPTIONS).alias("_m"),
    )
    keys, typed = F.coalesce(F.map_keys("_m"), F.array().cast("array<string>")), F.col("_p.v")
    has = lambda k: F.array_contains(keys, k)
    value = lambda k: F.get(F.map_values("_m"), F.array_position(keys, k).cast("int") - 1)
    missing = ~F.startswith(F.col("_s"), F.lit("{"))
    for k in required:
        missing = missing | ~has(k)
    mistyped = F.lit(False)
    for f in schema.names:
        mistyped = mistyped | (has(f) & value(f).isNotNull() & typed[f].isNull())
    status = (
        F.when(F.col("_line").isNull() | (F.col("_s") == ""), F.lit(BLANK))
        .when(~F.col("_p.valid"), F.lit(MALFORMED))
        .when(missing, F.lit(MISSING_KEY))
        .when(mistyped, F.lit(MISTYPED))
        .otherwise(F.lit(OK))
    )
    null = F.lit(False)
    for k in required:
        null = null | (has(k) & value(k).isNull())
    good = F.col("status") == OK
    # one generated row per line: a filter on the status, pushed below the parses, would repeat them for each of its terms
    out = read.select(*keep, F.inline(F.array(F.struct(status.alias("status"), null.alias("_null"), typed.alias("_t")))))
    return out.select(*keep, "status", F.when(good, F.col("_null")).alias("has_null"), *[F.when(good, F.col("_t")[f]).alias(f) for f in schema.names])


def prompt_intake(spark, path: str, required=("id", "prompt"), value_schema: T.StructType | str = "id string, prompt string"):
    """JSONL prompt set -> ``(good, quarantine)`` DataFrames.

    ``pos`` numbers the lines from 0 in file order: by file path, then by the
    line's place in the file, whatever order the splits are read in.  The
    lines are written once to the shared folder, so that the numbers are the
    same in both results and in every later run over them.
    """
    meta = spark.read.text(path).select("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("n"), "value")
    lines = written(meta, "lines")
    blocks = lines.groupBy("file_path", "file_block_start").agg(F.min("n").alias("first"), F.count(F.lit(1)).alias("size"))
    # one row per file split
    before = Window.orderBy("file_path", "file_block_start").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("base", F.coalesce(F.sum("size").over(before), F.lit(0)))
    placed = lines.join(blocks, ["file_path", "file_block_start"]).select(
        F.col("file_path").alias("file"), (F.col("base") + F.col("n") - F.col("first")).alias("pos"), "value"
    )
    out = intake_lines(placed, "value", required, value_schema, keep=("file", "pos"))
    return out.filter(F.col("status") == OK), out.filter(F.col("status") != OK)


def locally_numbered(df: DataFrame, id_col: str, pos_col: str, out: str, partitions: int | None = None) -> DataFrame:
    """``df`` range-partitioned and sorted by ``(string(id), pos)``; ``out``
    holds the partition (from bit 33 on) and the row's number in it.  Every
    evaluation samples new bounds: write the result before it is used twice."""
    p = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.withColumn("_sid", F.col(id_col).cast("string")).repartitionByRange(p, F.col("_sid"), F.col(pos_col))
    return ranged.sortWithinPartitions("_sid", pos_col).withColumn(out, F.monotonically_increasing_id()).drop("_sid")


def shard_stride(
    df: DataFrame,
    id_col: str,
    pos_col: str,
    num_shards: int,
    shard_index: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Global stable order by ``(string(id), pos)``; row *r* (0-based) goes
    to shard ``r % num_shards``.  Adds ``rank`` and ``shard``; with
    ``shard_index`` keeps only that shard.

    No single-partition window: the rows are range-partitioned on the order
    key (a hot id is split by ``pos``), each partition is sorted and numbered
    locally, and a table of per-partition counts (one row per partition,
    broadcast) turns local numbers into global ranks.  The bounds of a range
    partitioning are sampled anew whenever it is planned, so the numbered rows
    are written once to the shared folder and counts and ranks both come from
    there.  ``(string(id), pos)`` should be unique; the order of ties is open.
    """
    if num_shards < 1:
        raise ValueError("num_shards >= 1")
    mid = "_mid"
    numbered = written(locally_numbered(df, id_col, pos_col, mid, partitions), "numbered")
    pid, local = F.shiftright(mid, 33), F.col(mid).bitwiseAND(F.lit((1 << 33) - 1))
    counts = numbered.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # one row per partition: the window below is over `p` rows only
    offsets = counts.select("_pid", (F.sum("_n").over(w) - F.col("_n")).alias("_off"))
    ranked = numbered.withColumn("_pid", pid).join(F.broadcast(offsets), "_pid").withColumn("rank", F.col("_off") + local)
    out = ranked.withColumn("shard", F.pmod(F.col("rank"), F.lit(num_shards)).cast("int")).drop(mid, "_pid", "_off")
    if shard_index is not None:
        out = out.filter(F.col("shard") == shard_index)
    return out


def run_counts(df: DataFrame, shard: str = "shard", vectors: DataFrame | None = None, id_map: DataFrame | None = None) -> DataFrame:
    """Rows per shard plus the total (shard NULL), in one rollup; with
    ``vectors`` and ``id_map`` also the number of index vectors and of map
    entries, on every row."""
    out = df.rollup(shard).agg(F.count(F.lit(1)).alias("n"))
    for name, side in (("n_vectors", vectors), ("n_map", id_map)):
        if side is not None:
            out = out.crossJoin(F.broadcast(side.agg(F.count(F.lit(1)).alias(name))))  # one row
    return out


def ledger_ids(ledger: DataFrame, id_col: str = "id", status: str | None = None) -> DataFrame:
    """Ledger rows -> distinct stripped non-empty ids (set semantics); with
    ``status`` only rows of that status, where the ledger records one (a row
    that records none is a success)."""
    if status is not None and "status" in ledger.columns:
        ledger = ledger.filter(F.coalesce("status", F.lit(SUCCESS)) == status)
    return ledger.select(strip(F.col(id_col).cast("string")).alias(id_col)).filter(F.col(id_col) != "").distinct()


def resume_pending(df: DataFrame, ledger: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows whose id no success in the ledger names (left anti join on the
    string id): a failed id is tried again.  The ledger grows with every run,
    so the join is left to AQE, which knows its size."""
    done = ledger_ids(ledger, id_col, SUCCESS).withColumnRenamed(id_col, "_lid")
    return df.join(done, F.col(id_col).cast("string") == F.col("_lid"), "left_anti")


def taken_ids(ledger: DataFrame, run_id: str, id_col: str = "id") -> DataFrame:
    """Ids that another run than ``run_id`` has taken (status ``pending``) and
    that haven't failed since."""
    if not {"status", "run_id", "ts"} <= set(ledger.columns):
        return ledger.select(F.col(id_col).cast("string").alias(id_col)).limit(0)
    others = ledger.filter(F.col("status").isin(PENDING, FAILURE) & ~F.col("run_id").eqNullSafe(F.lit(run_id)))
    # of one instant, the failure is the later
    last = F.max(F.struct("ts", (F.col("status") == FAILURE).alias("failed")))
    key = strip(F.col(id_col).cast("string"))
    return others.groupBy(key.alias(id_col)).agg(last.alias("_last")).filter("not _last.failed").select(id_col)


def current_failures(ledger: DataFrame, id_col: str = "id") -> DataFrame:
    """Failed ids of the latest run, the one with the latest time (each run
    starts its list of failures anew)."""
    latest = ledger.agg(F.max(F.struct("ts", "run_id")).alias("last")).select("last.run_id")
    return ledger_ids(ledger.join(F.broadcast(latest), "run_id", "left_semi"), id_col, FAILURE)


def promote_success(attempted: DataFrame, failed: DataFrame, id_col: str = "id") -> DataFrame:
    """Attempted ids that are not among this run's failures."""
    att = ledger_ids(attempted, id_col)
    bad = ledger_ids(failed, id_col)
    return att.join(bad, id_col, "left_anti")


def duplicate_id_policy(attempts: DataFrame, id_col: str, order, ok: str) -> DataFrame:
    """Outcome of an id that appears several times in one run.

    After a success the later copies are skipped (the ledger has the id);
    after a failure every copy runs and none can be promoted.  So the id's
    outcome is its first attempt's; attempts = 1 if that succeeded, else all.
    """
    first_ok = F.min_by(F.col(ok), order_struct(order))
    n = F.count(F.lit(1))
    return attempts.groupBy(id_col).agg(
        first_ok.alias("ok"),
        F.when(first_ok, F.lit(1)).otherwise(n).cast("bigint").alias("attempts"),
        n.cast("bigint").alias("copies"),
    )


#: Tasks over which the rounds of one id spread.
ROUND_SALTS = 8


def last_good_round(
    rounds: DataFrame,
    id_col: str,
    order,
    ok: str,
    path: str,
    input_path: Column | str | None = None,
) -> DataFrame:
    """Refinement stops at the first failed round; the current artifact is
    the path of the last round before it, else the input artifact.

    The first failure per id is a map-side aggregate.  The rounds before it
    are then counted per (id, salt) against a copy of the per-id row for each
    salt, so the rounds of a hot id spread over ``ROUND_SALTS`` tasks, and the
    few salted rows are combined per id.
    """
    o = order_struct(order)
    r = rounds.select(F.col(id_col), o.alias("_o"), F.col(ok).alias("_ok"), F.col(path).alias("_path"))
    salt = F.pmod(F.xxhash64("_o"), F.lit(ROUND_SALTS))
    first_fail = r.groupBy(id_col).agg(
        F.min(F.when(~F.col("_ok"), F.col("_o"))).alias("_ff"),
        F.count(F.lit(1)).alias("n_rounds"),
    )
    salted = first_fail.select(id_col, "_ff", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(ROUND_SALTS - 1).cast("bigint"))).alias("_salt"))
    part = (
        r.withColumn("_salt", salt)
        .join(salted, [id_col, "_salt"])
        .filter(F.col("_ff").isNull() | (F.col("_o") < F.col("_ff")))
        .groupBy(id_col, "_salt")
        .agg(F.count(F.lit(1)).alias("_n"), F.max("_o").alias("_last_o"), F.max_by("_path", "_o").alias("_last"))
    )
    good = part.groupBy(id_col).agg(F.sum("_n").alias("good_rounds"), F.max_by("_last", "_last_o").alias("_last"))
    out = first_fail.join(good, id_col, "left")
    fallback = F.lit(None).cast("string") if input_path is None else (F.lit(input_path) if isinstance(input_path, str) else input_path)
    return out.select(
        id_col,
        F.col("n_rounds").cast("bigint").alias("n_rounds"),
        F.coalesce(F.col("good_rounds"), F.lit(0)).cast("bigint").alias("good_rounds"),
        F.col("_ff").isNull().alias("all_ok"),
        F.coalesce(F.col("_last"), fallback).alias("current_path"),
    )


def refine_all_ok(rounds: DataFrame, keys, ok: str) -> DataFrame:
    """Success only if every round succeeded."""
    return rounds.groupBy(*_cols(keys)).agg(F.bool_and(ok).alias("all_ok"), F.count(F.lit(1)).cast("bigint").alias("rounds"))


# ---------------------------------------------------------------- outcomes

STRICT = "strict"
LENIENT = "lenient"
# Stages whose failure only warns under the lenient (single prompt) policy.
SOFT_STAGES = ("image_repair", "layout_refine")


def stage_outcome(df: DataFrame, stages: Sequence[tuple[str, str]], policy: str = STRICT, soft: Sequence[str] = SOFT_STAGES) -> DataFrame:
    """First failing stage decides the example.

    ``stages`` is ``[(stage_name, ok_column), ...]`` in pipeline order; a
    NULL ok means the stage did not run (treated as failed).  Strict: any
    failure fails.  Lenient: failures of ``soft`` stages become warnings.
    Adds ``ok``, ``failed_stage`` and ``warnings`` (comma list or NULL).
    """
    if policy not in (STRICT, LENIENT):
        raise ValueError("policy is 'strict' or 'lenient'")
    hard = [(n, c) for n, c in stages if policy == STRICT or n not in soft]
    warn = [(n, c) for n, c in stages if policy == LENIENT and n in soft]
    failed = F.lit(None).cast("string")
    for name, c in reversed(hard):
        failed = F.when(~F.coalesce(F.col(c), F.lit(False)), F.lit(name)).otherwise(failed)
    warnings = F.concat_ws(",", *[F.when(~F.coalesce(F.col(c), F.lit(False)), F.lit(n)) for n, c in warn]) if warn else F.lit("")
    return df.withColumn("failed_stage", failed).withColumn("ok", F.col("failed_stage").isNull()).withColumn(
        "warnings", F.when(warnings != "", warnings)
    )


def outcome_counts(outcomes: DataFrame, stage: str = "failed_stage", ok: str = "ok") -> DataFrame:
    """Examples per first failing stage (NULL = passed) and the share.  The
    grouped table has one row per stage, so the share window is tiny."""
    counts = outcomes.groupBy(stage).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"), F.count_if(~F.col(ok)).cast("bigint").alias("failures")
    )
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))
