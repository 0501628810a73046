"""Single files in Spark tasks: writing, copying and listing them.

Tasks open file systems with ``pyarrow.fs`` (local, ``hdfs``, ``s3``, ``gs``).
A file appears under its name only when it is whole: it is written under a
hidden temporary name in its folder and renamed, so a task that dies or runs
again leaves no half file, and files that are there already are left alone.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from contextlib import suppress
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from atelier.session import written

CHUNK = 8 << 20
COPIED, EXISTS, MISSING, FAILED = "COPIED", "EXISTS", "MISSING", "FAILED"
_STATUS = "status string, n_bytes bigint, sha256 string, error string"
_STATUS_ARROW = pa.struct([("status", pa.string()), ("n_bytes", pa.int64()), ("sha256", pa.string()), ("error", pa.string())])


def open_fs(path: str) -> tuple[pa.fs.FileSystem, str]:
    """File system and path of a URI, or of an absolute local path."""
    return pa.fs.FileSystem.from_uri(quote(path, safe="/:@%=") if "://" in path or path.startswith("file:") else path)


def _is_file(fs: pa.fs.FileSystem, path: str) -> bool:
    return fs.get_file_info(path).type == pa.fs.FileType.File


def publish(fs: pa.fs.FileSystem, path: str, chunks: Iterator[bytes]) -> None:
    """Writes a file under a hidden name and renames it when it is whole."""
    folder, _, name = path.rpartition("/")
    fs.create_dir(folder, recursive=True)
    part = f"{folder}/.{name}.{uuid.uuid4().hex}"
    try:
        with fs.open_output_stream(part, compression=None) as out:
            for chunk in chunks:
                out.write(chunk)
        fs.move(part, path)
    except BaseException:
        with suppress(OSError):
            fs.delete_file(part)
        raise


def _chunks(fs: pa.fs.FileSystem, path: str) -> Iterator[bytes]:
    with fs.open_input_stream(path, compression=None) as source:
        while chunk := source.read(CHUNK):
            yield chunk


def _digest(chunks: Iterator[bytes], size: list[int], digest) -> Iterator[bytes]:
    for chunk in chunks:
        size[0] += len(chunk)
        digest.update(chunk)
        yield chunk


def _put(where: tuple, chunks) -> dict:
    """One file: what became of it.  ``chunks`` is called only if it's not there."""
    size, digest = [0], hashlib.sha256()
    try:
        fs, path = where
        if _is_file(fs, path):
            for _ in _digest(_chunks(fs, path), size, digest):
                pass
            return {"status": EXISTS, "n_bytes": size[0], "sha256": digest.hexdigest(), "error": None}
        publish(fs, path, _digest(chunks(), size, digest))
        return {"status": COPIED, "n_bytes": size[0], "sha256": digest.hexdigest(), "error": None}
    except FileNotFoundError:
        return {"status": MISSING, "n_bytes": None, "sha256": None, "error": None}
    except Exception as e:  # a row's fault is that row's status
        return {"status": FAILED, "n_bytes": None, "sha256": None, "error": f"{type(e).__name__}: {e}"}


def _stepped(df: DataFrame, step, *columns: Column) -> DataFrame:
    """``df`` with the status fields that ``step`` gives for the columns' values."""

    def run(first: pa.Array, second: pa.Array) -> pa.Array:
        pairs = zip(first.to_pylist(), second.to_pylist(), strict=True)
        return pa.array([step(a, b) for a, b in pairs], _STATUS_ARROW)

    call = F.arrow_udf(run, _STATUS).asNondeterministic()
    return written(df.select("*", call(*columns).alias("_done")), "files").select(*df.columns, "_done.*")


def write_files(df: DataFrame, root: str, path: str = "path", content: str = "content") -> DataFrame:
    """Writes each row's ``content`` (binary or text) to ``root/path``; returns
    the rows with ``status`` (COPIED, EXISTS, FAILED), ``n_bytes``, ``sha256``
    and ``error``.  Paths must be distinct; a file that exists stays."""

    def step(name: str | None, data: bytes | None) -> dict:
        if name is None or data is None:
            return {"status": MISSING, "n_bytes": None, "sha256": None, "error": None}
        return _put(open_fs(f"{root}/{name}"), lambda: iter([data]))

    return _stepped(df, step, F.col(path).cast("string"), F.col(content).cast("binary"))


def copy_files(manifest: DataFrame, src_root: str, dst_root: str, id_col: str = "id", dst: str = "dst", src: str = "src", partitions: int | None = None) -> DataFrame:
    """Copies ``src_root/src`` to ``dst_root/id/dst`` for every row of a
    manifest (see ``copy_manifest``: one row per destination).

    Returns the manifest with ``status``, ``n_bytes``, ``sha256`` and ``error``:
    COPIED, EXISTS (a run before did it; its digest is read again), MISSING (no
    such source, or a null in the row) or FAILED with the error.  A second run
    copies only what the first one didn't, so a run that was cut short is simply
    run again.  Files are dealt over the tasks by their destination and go
    through a task in chunks; none passes the driver.
    """
    n = partitions or int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    target = F.concat(F.col(id_col).cast("string"), F.lit("/"), F.col(dst))

    def step(to: str | None, source: str | None) -> dict:
        if to is None or source is None:
            return {"status": MISSING, "n_bytes": None, "sha256": None, "error": None}
        fs, at = open_fs(f"{src_root}/{source}")
        return _put(open_fs(f"{dst_root}/{to}"), lambda: _chunks(fs, at))

    return _stepped(manifest.repartition(n, id_col, dst), step, target, F.col(src))


def _scheme(root: str) -> str:
    return root.partition("://")[0] + "://" if "://" in root else "file:" if root.startswith("file:") else ""


def list_files(spark: SparkSession, root: str, partitions: int | None = None) -> DataFrame:
    """All files below ``root``: ``(path, size)``, by listings in tasks.

    Goes down level by level: each task lists some folders, the files among
    what it finds are results and the folders are listed next.  The driver
    learns how many folders a level has, not their names; hidden names (``.``
    and ``_`` in front) don't count.  A root that doesn't exist raises.
    """
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    fs, top = open_fs(root)
    if fs.get_file_info(top).type != pa.fs.FileType.Directory:
        raise FileNotFoundError(root)
    prefix = _scheme(root)
    if prefix not in ("", "file:", "file://"):  # Arrow's paths name the host or bucket, too, but for hdfs
        prefix = root[: root.index(top)] if top in root else prefix

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch["path"].to_pylist():
                found = [f for f in open_fs(root)[0].get_file_info(pa.fs.FileSelector(folder)) if f.base_name[:1] not in "._"]
                for i in range(0, len(found), 10_000):
                    some = found[i : i + 10_000]
                    is_file = [f.type == pa.fs.FileType.File for f in some]
                    yield pa.RecordBatch.from_pydict({"path": [f.path for f in some], "size": [f.size if k else None for f, k in zip(some, is_file, strict=True)]}, pa.schema([("path", pa.string()), ("size", pa.int64())]))

    folders, files = spark.createDataFrame([(top,)], "path string"), None
    while True:
        level = written(folders.mapInArrow(inside, "path string, size bigint"), "listing")
        mine = level.filter("size is not null")
        files = mine if files is None else files.unionAll(mine)
        folders = level.filter("size is null").select("path")
        if folders.isEmpty():
            return files.select(F.concat(F.lit(prefix), "path").alias("path"), "size")
        folders = folders.repartition(n, "path")
