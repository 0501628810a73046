"""A table of Parquet files of which only committed ones count.

``df.write.format("committed")`` (batch, or as the sink of a stream) writes each
task's rows to a file of its own in ``path/folder`` and, when all tasks are
done, one entry to ``path/_log`` that names the files.  The entry is the
commit: it is named by ``key``, and a second job with the same key (a job run
again, a micro-batch repeated after a restart) finds it and withdraws its own
files.  So a retried job adds its rows once, and a job that failed adds none: files
that a lost task leaves are named by no entry.

Options: ``path``; ``folder`` below it, such as ``run_id=7`` (a partition
column, which the rows then lack); ``key``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import suppress
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage

from atelier.sources.storage import open_fs, publish

_LOG = "run string, files array<string>, n_rows bigint"


@dataclass
class Written(WriterCommitMessage):
    """A task's file, relative to the table (None without rows)."""

    file: str | None
    rows: int


class _Files:
    """What batch and stream writers share; lives in tasks and on the driver."""

    def __init__(self, options: dict):
        self.path, self.folder, self.key = options["path"].rstrip("/"), options.get("folder", ""), options["key"]

    def begin(self) -> None:
        """A table has a log from its first job on, so that files of a job that
        fails never count.  Plain Parquet files that are there already do."""
        fs, at = open_fs(f"{self.path}/_log/created.json")
        if fs.get_file_info(at).type != pa.fs.FileType.File:
            _, top = open_fs(self.path)
            there = fs.get_file_info(pa.fs.FileSelector(top, recursive=True, allow_not_found=True))
            names = [f.path[len(top.rstrip("/")) + 1 :] for f in there if f.type == pa.fs.FileType.File and f.path.endswith(".parquet")]
            plain = [n for n in names if not any(p[:1] in "._" for p in n.split("/"))]
            publish(fs, at, iter([json.dumps({"run": None, "files": plain, "n_rows": None}).encode()]))

    def write_rows(self, batches: Iterator[pa.RecordBatch]) -> Written:
        name = "/".join(p for p in (self.folder, f"part-{uuid.uuid4().hex}.parquet") if p)
        fs, at = open_fs(f"{self.path}/{name}")
        folder, _, base = at.rpartition("/")
        hidden, rows, writer = f"{folder}/.{base}", 0, None
        try:
            for batch in batches:
                if writer is None:
                    fs.create_dir(folder, recursive=True)
                    writer = pq.ParquetWriter(hidden, batch.schema, filesystem=fs)
                writer.write_batch(batch)
                rows += batch.num_rows
            if writer is None:
                return Written(None, 0)
            writer.close()
            fs.move(hidden, at)
        except BaseException:
            with suppress(OSError):
                fs.delete_file(hidden)
            raise
        return Written(name, rows)

    def publish(self, messages: list[Written | None], key: str) -> None:
        fs, at = open_fs(f"{self.path}/_log/{quote(key, safe='')}.json")
        if fs.get_file_info(at).type == pa.fs.FileType.File:
            self.withdraw(messages)
            return
        done = [m for m in messages if m]
        entry = {"run": key, "files": [m.file for m in done if m.file], "n_rows": sum(m.rows for m in done)}
        publish(fs, at, iter([json.dumps(entry).encode()]))

    def withdraw(self, messages: list[Written | None]) -> None:
        for m in messages:
            if m and m.file:
                fs, at = open_fs(f"{self.path}/{m.file}")
                with suppress(OSError):
                    fs.delete_file(at)


class _BatchWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.files = _Files(options)
        self.files.begin()

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return self.files.write_rows(iterator)

    def commit(self, messages: list) -> None:
        self.files.publish(messages, self.files.key)

    def abort(self, messages: list) -> None:
        self.files.withdraw(messages)


class _StreamWriter(DataSourceStreamArrowWriter):
    """Each micro-batch is a commit of its own."""

    def __init__(self, options: dict):
        self.files = _Files(options)
        self.files.begin()

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return self.files.write_rows(iterator)

    def commit(self, messages: list, batchId: int) -> None:  # noqa: N803
        self.files.publish(messages, f"{self.files.key}-{batchId}")

    def abort(self, messages: list, batchId: int) -> None:  # noqa: N803
        self.files.withdraw(messages)


class CommittedTable(DataSource):
    @classmethod
    def name(cls) -> str:
        return "committed"

    def schema(self) -> str:
        raise NotImplementedError("read the table with read_committed")

    def writer(self, schema, overwrite: bool) -> _BatchWriter:
        return _BatchWriter(dict(self.options))

    def streamWriter(self, schema, overwrite: bool) -> _StreamWriter:  # noqa: N802
        return _StreamWriter(dict(self.options))


def write_committed(df: DataFrame, path: str, key: str, partition: tuple[str, str] | None = None) -> None:
    """Adds the rows of ``df`` to the table at ``path`` unless ``key`` did so
    before.  ``partition``: a column of one value, kept as a folder's name."""
    df.sparkSession.dataSource.register(CommittedTable)
    folder = f"{partition[0]}={quote(partition[1], safe='')}" if partition else ""
    rows = df.drop(partition[0]) if partition else df
    rows.write.format("committed").option("path", path).option("folder", folder).option("key", key).mode("append").save()


def commits(spark: SparkSession, path: str) -> DataFrame | None:
    """The log of the table at ``path``: a row per commit, and one with a null
    ``run`` for what was there before; None without a log."""
    try:
        return spark.read.schema(_LOG).json(f"{path.rstrip('/')}/_log")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_committed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The committed rows of the table at ``path``; empty if there is no such
    path.  A folder of plain Parquet files without a log is read as it is."""
    log = commits(spark, path)
    if log is None:
        try:
            return spark.read.parquet(path)
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return spark.createDataFrame([], schema)
    names = [name for row in log.select("files").toLocalIterator() for name in row.files]  # as many as tasks wrote
    found = spark.createDataFrame([], schema)
    for in_folders in (True, False):  # files in partition folders, and plain ones
        some = [f"{path.rstrip('/')}/{name}" for name in names if ("/" in name) == in_folders]
        if some:
            found = found.unionByName(spark.read.schema(schema).option("basePath", path).parquet(*some))
    return found
