"""Scans of the on-disk inputs (prompt sets, training sets, vector index,
id map, image library, ledgers, artifacts)."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from atelier.functions.text import strip
from atelier.operators.runs import prompt_intake  # noqa: F401  (re-exported)
from atelier.operators.sft import TRAINING_SCHEMA
from atelier.session import written
from atelier.sources import json_array
from atelier.sources.committed import read_committed
from atelier.sources.storage import list_files, open_fs

#: Rows of a ledger, one per id and outcome of a run.
LEDGER_SCHEMA = "id string, pos bigint, status string, stage string, ts timestamp, run_id string"


def training_scan(spark: SparkSession, path: str) -> DataFrame:
    """JSONL training set with the explicit five-string schema."""
    return spark.read.schema(TRAINING_SCHEMA).json(path)


def vector_scan(spark: SparkSession, path: str, pos: str = "pos", vec: str = "embedding") -> DataFrame:
    """Parquet vector table ``(pos bigint, embedding array<float>)``."""
    df = spark.read.parquet(path)
    return df.select(F.col(pos).cast("bigint").alias("pos"), F.col(vec).cast("array<float>").alias("embedding"))


#: Bytes of a JSON array that one task scans.
ARRAY_SPLIT = 64 << 20


def id_map_scan(spark: SparkSession, path: str, split: int = ARRAY_SPLIT) -> DataFrame:
    """One JSON array of element ids -> ``(pos, elem_id)`` rows.

    The file is cut into byte ranges of ``split``.  A first pass counts each
    range's quotation marks and commas, from which follow, for every range,
    whether it begins inside a string and how many elements come before it (a
    row per range); a second one parses the elements that begin in the range.
    Strings may hold escapes, commas and brackets; null stays null, numbers are
    read as text; an element that is an array or object raises.
    """
    fs, at = open_fs(path)
    size = fs.get_file_info(at).size
    if size is None:
        raise FileNotFoundError(path)
    n = max(1, -(-size // split))
    ranges = spark.range(0, n, 1, min(n, 10_000)).select("id", (F.col("id") * split).alias("begin"))
    counted = written(ranges.mapInArrow(partial(json_array.count, path, split, size), "id bigint, begin bigint, quotes bigint, outside bigint, inside bigint"), "ranges")
    before = Window.orderBy("id").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    placed = counted.withColumn("odd", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    placed = placed.withColumn("first", F.coalesce(F.sum(F.when(F.col("odd") == 1, F.col("inside")).otherwise(F.col("outside"))).over(before), F.lit(0)))
    return placed.select("begin", "odd", "first").repartition(n, "begin").mapInArrow(partial(json_array.elements, path, split, size), "pos bigint, elem_id string")


def library_scan(spark: SparkSession, root: str, suffix: str = ".png") -> DataFrame:
    """Which element ids have a file: ``(elem_id, path)``; folders are listed
    in tasks, level by level, and file contents are not read."""
    files = list_files(spark, root).filter(F.endswith("path", F.lit(suffix)))
    name = F.substring_index("path", "/", -1)
    return files.select(F.substr(name, F.lit(1), F.length(name) - len(suffix)).alias("elem_id"), "path")


def ledger_scan(spark: SparkSession, path: str) -> DataFrame:
    """Ledger text files -> distinct stripped non-empty ids."""
    s = strip(F.col("value"))
    return spark.read.text(path).select(s.alias("id")).filter(F.col("id") != "").distinct()


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The committed rows of the ledger at ``path`` (see ``write_ledger``),
    empty if there is no such path; any other fault is raised."""
    return read_committed(spark, path, LEDGER_SCHEMA)


def read_artifacts(spark: SparkSession, path: str, schema: str = "id string, round int, path string, ok boolean, stage string") -> DataFrame:
    """The committed rows of the artifact lineage (see ``write_artifacts``)."""
    return read_committed(spark, path, schema)


def artifact_scan(spark: SparkSession, path: str) -> DataFrame:
    """Text artifacts ``(path, text)`` of all folders below; undecodable bytes become U+FFFD."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.expr("make_valid_utf8(cast(content as string))").alias("text"))


def image_bytes_scan(spark: SparkSession, path: str, suffix: str = ".png") -> DataFrame:
    """Raw image bytes ``(path, content)`` of all folders below."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}").load(path).select("path", "content")
