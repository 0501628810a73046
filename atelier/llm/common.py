"""Helpers shared by the operators: column naming, checked broadcasts,
written intermediate tables, prefix sums, and a flat numpy view of Arrow text.
"""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from atelier.session import scratch_root

#: ASCII white space that separates words: \x20 and \x09-\x0D.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows up to which a per-source, per-language or per-shard table is broadcast.
SMALL_ROWS = 20_000


# --------------------------------------------------------------------------
# DataFrames


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession, what: str) -> str:
    """A new folder name under ``spark.checkpoint.dir``, which all executors
    see.  Without that setting a cluster raises; a local session makes one."""
    return f"{(_GROUP.get() or scratch_root(spark)).rstrip('/')}/{what}-{uuid.uuid4().hex}"


#: Folder of the group of written tables that is open in this thread.
_GROUP: ContextVar[str | None] = ContextVar("group", default=None)


@contextmanager
def short_lived(spark: SparkSession, what: str) -> Iterator[None]:
    """Tables written inside go to a folder of their own, which goes at the
    end: nothing that is used later may read them.  A file system that Arrow
    can't open keeps the folder."""
    folder = shared_dir(spark, what)
    before = _GROUP.set(folder)
    try:
        yield
    finally:
        _GROUP.reset(before)
    with suppress(pa.ArrowInvalid, FileNotFoundError):
        fs, path = pa.fs.FileSystem.from_uri(folder)
        fs.delete_dir(path)


def written(df: DataFrame, what: str, path: str | None = None) -> DataFrame:
    """``df`` written to the shared folder (or to ``path``) and read again:
    later steps start from files that survive a lost executor."""
    path = path or shared_dir(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns of these names, whatever their case."""
    gone = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


def with_struct(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with one result column; a column of that name is replaced."""
    keep = [c for c in df.columns if c.lower() != name.lower()]
    return df.select(*[F.col(f"`{c}`") for c in keep], value.alias(name))


def join_small(big: DataFrame, small: DataFrame, key: str, n_small: int, by: list[str], how: str = "inner", salt: int = 32) -> DataFrame:
    """Join a table to one with a row per key.

    ``n_small`` is the counted size of ``small``: it is broadcast up to
    ``SMALL_ROWS`` rows.  Beyond that both sides are dealt by (key, salt), each
    small row repeated ``salt`` times, so that a hot key spreads over tasks; a
    merge join, as Spark would size the repeated rows as if each came once.
    The salt is a hash of the columns ``by``, so a task that runs again deals
    its rows as before.
    """
    if n_small <= SMALL_ROWS:
        return big.join(F.broadcast(small), key, how)
    salted = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    return big.withColumn("_salt", F.pmod(F.xxhash64(*by), F.lit(salt)).cast("int")).join(salted.hint("merge"), [key, "_salt"], how).drop("_salt")


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str, label: str, classes: list[int], most: int) -> tuple[DataFrame, dict[int, int]]:
    """Rows of ``docs`` with a label, at most ``most`` labels of each class by
    the order of their key's hash, and the count of all labels by class.

    The labels are sampled before they meet the documents, so what is
    broadcast is bounded by ``most`` rows a class, and the documents are read
    once and not shuffled.
    """
    labels = labels.select(key, F.col(label).cast("int").alias(label)).filter(F.col(key).isNotNull() & F.col(label).isin(*classes))
    counts = {r[0]: r[1] for r in labels.groupBy(label).count().collect()}
    some = None
    for k in classes:
        part = labels.filter(F.col(label) == k).orderBy(F.xxhash64(key), key).limit(most)
        some = part if some is None else some.union(part)
    return written(docs.join(F.broadcast(some), key), "labelled"), counts


def numbered(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """``df`` with its rows' places 0, 1, 2, ... in an order that leaves no
    ties, by a range partitioning: what is broadcast is a count per partition."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    dealt = written(dealt, "numbered")
    part = F.shiftright("_at", 33)
    sizes = dealt.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    sizes = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return dealt.withColumn("_part", part).join(F.broadcast(sizes), "_part").withColumn(out, F.col("_before") + F.col("_at") - F.shiftleft(F.col("_part"), 33)).drop("_part", "_at", "_before")


def running_totals(df: DataFrame, group: str, order: str, value: str, out: str, block: int = 1000) -> DataFrame:
    """Exclusive running total of ``value`` by ``order`` (0, 1, 2, ... within
    the group), in two levels so that no task holds more than one block of a
    group's rows and one total per block."""
    b = df.withColumn("_block", F.floor(F.col(order) / block))
    inner = Window.partitionBy(group, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    totals = b.groupBy(group, "_block").agg(F.sum(value).alias("_total"))
    outer = Window.partitionBy(group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(group, "_block", F.coalesce(F.sum("_total").over(outer), F.lit(0)).alias("_base"))
    inside = b.withColumn("_inside", F.coalesce(F.sum(value).over(inner), F.lit(0)))
    return inside.join(bases, [group, "_block"]).withColumn(out, F.col("_base") + F.col("_inside")).drop("_block", "_base", "_inside")


#: What a Python worker keeps between batches and tasks, for one operator.
_KEPT: dict[object, object] = {}


def kept(name: object, make: Callable[[], object]):
    """A worker's tables: made once under ``name``, until an operator with
    other tables, or with none (see ``release``), runs in that worker."""
    if name not in _KEPT:
        release()
        _KEPT[name] = make()
    return _KEPT[name]


def release() -> None:
    """Gives back the memory of tables that another operator has left in a
    worker, which Spark uses again for whatever comes next."""
    if _KEPT:
        _KEPT.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        with suppress(OSError, AttributeError):
            ctypes.CDLL(None).malloc_trim(0)


def arrow_struct(fn: Callable[..., list], schema: T.StructType, tables: bool = False) -> Callable[..., Column]:
    """An Arrow UDF that returns a struct; ``fn`` gets Arrow arrays and gives
    one Arrow array per field.  Marked non-deterministic so that a filter on
    its result doesn't make Spark evaluate it twice.  ``tables``: whether it
    uses ``kept`` ones."""
    from pyspark.sql.pandas.types import to_arrow_type

    names = [f.name for f in schema.fields]
    kinds = [to_arrow_type(f.dataType) for f in schema.fields]

    def run(it: Iterator[tuple]) -> Iterator[pa.Array]:
        if not tables:
            release()
        for arrays in it:
            arrays = arrays if isinstance(arrays, tuple) else (arrays,)
            out = [a if a.type == k else a.cast(k) for a, k in zip(fn(*arrays), kinds, strict=True)]
            yield pa.StructArray.from_arrays(out, names=names)

    def one(a: pa.Array) -> pa.Array:
        return next(run(iter([(a,)])))

    def two(a: pa.Array, b: pa.Array) -> pa.Array:
        return next(run(iter([(a, b)])))

    import inspect

    wide = len(inspect.signature(fn).parameters) == 2
    return F.arrow_udf(two if wide else one, schema).asNondeterministic()


# --------------------------------------------------------------------------
# text in numpy

GAP = np.zeros(256, bool)
GAP[[9, 10, 11, 12, 13, 32]] = True

_GEN = np.random.Generator(np.random.PCG64(20240607))
BYTE_CODE = _GEN.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LOWER_CODE = BYTE_CODE.copy()
LOWER_CODE[65:91] = BYTE_CODE[97:123]

_BASE = 0x9E3779B97F4A7C15
#: Powers are products of one of the first 2^16 and one of every 2^16th.
_STEP = 1 << 16


def _run(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


_LOW = _run(_BASE, _STEP)
_LOW_INVERSE = _run(pow(_BASE, -1, 2**64), _STEP)


def _high(n: int, base: int) -> np.ndarray:
    return _run(pow(base, _STEP, 2**64), n // _STEP + 1)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Text:
    """Consecutive rows of a string column as one byte array."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        self.data, self.off, self.n = data, off, len(off) - 1

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and row of every word."""
        gap = GAP[self.data]
        first = np.zeros(len(gap) + 1, bool)
        first[self.off] = True
        solid = ~gap
        start = solid.copy()
        start[1:] &= gap[:-1] | first[1:-1]
        end = solid
        end[:-1] &= gap[1:] | first[1:-1]
        s = np.flatnonzero(start)
        return s, np.flatnonzero(end) + 1, np.searchsorted(self.off, s, "right") - 1

    def rows_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.off, at, "right") - 1

    def sums(self, code: np.ndarray) -> np.ndarray:
        """Running sums from which ``hashes`` takes the hash of any span."""
        c = np.zeros(len(self.data) + 1, np.uint64)
        for k, power in enumerate(_high(len(self.data), _BASE)):
            part = self.data[k * _STEP : (k + 1) * _STEP]
            np.multiply(code[part], _LOW[: len(part)] * power, out=c[1 + k * _STEP : 1 + k * _STEP + len(part)])
        return np.cumsum(c, out=c)

    @staticmethod
    def hashes(sums: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        """64-bit hash of the bytes of each span."""
        inverse = _LOW_INVERSE[s % _STEP] * _high(len(sums), pow(_BASE, -1, 2**64))[s // _STEP]
        return mix((sums[e] - sums[s]) * inverse + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def row_sums(self, weight: np.ndarray) -> np.ndarray:
        """Sum of a value per byte over each row."""
        c = np.zeros(len(weight) + 1, np.int64)
        np.cumsum(weight, out=c[1:])
        return c[self.off[1:]] - c[self.off[:-1]]


def texts(column: pa.Array, most: int = 512 << 10) -> Iterator[Text]:
    """Runs of rows of at most ``most`` bytes of text; a longer text is a run
    of its own.  Null counts as empty.  Yields at least one run."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    buffers = column.buffers()
    off = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    at = 0
    while True:
        to = max(at + 1, int(np.searchsorted(off, off[at] + most, "right")) - 1) if len(column) else 0
        yield Text(data[off[at] : off[to]], off[at : to + 1] - off[at])
        at = to
        if at >= len(column):
            return


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from its flat values and the length of each list."""
    off = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off), pa.array(values, kind))
