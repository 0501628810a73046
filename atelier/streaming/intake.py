"""Incremental prompt intake with Structured Streaming.

New JSONL prompt files in a folder are taken batch by batch.  The ledger is the
only state that decides: an id with a success there is done, one that another
batch took (``pending``) and that hasn't failed since is in work, and any other
is written to the pending table and taken, in the ledger, by this batch.  A
batch commits its ledger rows once, under its own number, so a micro-batch that
is repeated after a fault takes the same ids again and adds nothing twice.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atelier.operators.runs import OK, PENDING, _schema, intake_lines, resume_pending, taken_ids
from atelier.sources.scans import read_ledger
from atelier.sources.sinks import write_ledger


def stream_intake(
    spark: SparkSession,
    source_dir: str,
    ledger_path: str,
    sink_path: str,
    checkpoint: str,
    required=("id", "prompt"),
    value_schema: str = "id string, prompt string",
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    name: str = "intake",
):
    """Start the stream; returns the ``StreamingQuery``.

    Each micro-batch: classify lines, keep OK rows, drop ids that the ledger at
    ``ledger_path`` has as done or taken (no such path means that nothing is;
    any other fault is raised), write ``(id, prompt)`` to ``sink_path`` under
    ``batch_id=<n>`` and the distinct ids to the ledger as pending, with the run
    id ``name-<n>``.  A stream that starts over with an empty checkpoint needs
    another ``name``.
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = reader.load(source_dir)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        good = intake_lines(batch, "value", required, value_schema).filter(F.col("status") == OK)
        run = f"{name}-{batch_id}"
        ledger = read_ledger(batch.sparkSession, ledger_path)
        pending = resume_pending(good, ledger, "id")
        taken = taken_ids(ledger, run).withColumnRenamed("id", "_taken")
        pending = pending.join(taken, F.col("id").cast("string") == F.col("_taken"), "left_anti")
        # the lines are parsed once: the sink and the ledger both take the kept rows
        pending = pending.select(*_schema(value_schema).names).persist(StorageLevel.DISK_ONLY)
        # a retried micro-batch rewrites only its own partition: idempotent
        (
            pending.withColumn("batch_id", F.lit(batch_id))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(sink_path)
        )
        mine = batch.sparkSession.read.schema(_schema(value_schema)).parquet(f"{sink_path}/batch_id={batch_id}") if not pending.isEmpty() else pending
        write_ledger(mine.select("id").distinct(), ledger_path, run_id=run, status=PENDING)
        pending.unpersist()

    writer = lines.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
