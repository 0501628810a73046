"""Repeated passages by content-defined chunking.

A gear hash rolls over the bytes of a text; a chunk ends where the hash is
greatest among its neighbours, so that cuts depend on the bytes nearby only
and come back in step right after an insertion.  Chunks with equal digests in
different documents are repeats; runs of them with enough words are repeated
passages, of which each chunk stays in the first document that holds it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from atelier.llm import common as C

#: Bytes that the gear hash spans; a cut is the greatest hash within REACH on
#: both sides, so chunks have over REACH bytes, about twice that on average.
SPAN, REACH = 16, 16
#: Words that a run of repeated chunks must hold.  A passage loses up to a
#: chunk and a span at either end, so passages of over 50 words are found.
LEAST_WORDS = 25
_GAP = SPAN + REACH

GEAR = np.random.Generator(np.random.PCG64(99)).integers(0, 2**32, 256, dtype=np.uint32)

CHUNKS = T.StructType(
    [T.StructField(n, T.ArrayType(k)) for n, k in (("digest", T.LongType()), ("start", T.LongType()), ("end", T.LongType()), ("words", T.IntegerType()))]
)


def gear(b: np.ndarray, real: np.ndarray) -> np.ndarray:
    """The sum over the last SPAN bytes of each byte's code, shifted by its
    distance; built by doubling.  Bytes between documents count 0."""
    h = np.where(real, GEAR[b], np.uint32(0))
    n = 1
    while n < SPAN:
        longer = h.copy()
        longer[n:] += h[:-n] << np.uint32(n)
        h, n = longer, 2 * n
    return np.where(real, h, np.uint32(0))


def cuts(h: np.ndarray) -> np.ndarray:
    """Positions of the hashes that are greatest within REACH."""
    m, n = h, 1
    while n < REACH:
        m, n = np.maximum(m[:-n], m[n:]), 2 * n
    at = np.arange(REACH, len(h) - REACH)
    return at[(h[at] > m[at - REACH]) & (h[at] >= m[at + 1]) & (h[at] > 0)]


def _chunked(t: C.Text) -> list[np.ndarray]:
    row = np.repeat(np.arange(t.n), np.diff(t.off))
    new = np.arange(len(t.data)) + _GAP * (row + 1)
    size = len(t.data) + _GAP * (t.n + 2)
    stream, real = np.zeros(size, np.uint8), np.zeros(size, bool)
    stream[new], real[new] = t.data, True
    back = np.cumsum(real)  # stream position to the bytes up to and with it
    ends = np.unique(np.concatenate([back[cuts(gear(stream, real))], t.off[1:][np.diff(t.off) > 0]]))
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    of = t.rows_of(starts)
    digest = C.Text.hashes(t.sums(C.BYTE_CODE), starts, ends)
    head = np.zeros(len(t.data) + 1, np.int64)
    np.cumsum((t.data & 0xC0) != 0x80, out=head[1:])
    base = head[t.off[of]]
    s, _, _ = t.words()
    words = np.searchsorted(s, ends) - np.searchsorted(s, starts)
    return [np.bincount(of, minlength=t.n), digest.view(np.int64), head[starts] - base, head[ends] - base, words]


def chunks(text: pa.Array) -> list[pa.Array]:
    got = [_chunked(t) for t in C.texts(text) if t.n]
    if not got:
        return [pa.array([], pa.list_(k)) for k in (pa.int64(), pa.int64(), pa.int64(), pa.int32())]
    n, *cols = (np.concatenate(x) for x in zip(*got, strict=True))
    return [C.lists(c, n, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.int32()), strict=True)]


def repeated_passages(rows: DataFrame, rid: str = "rid", key: str = "key", text: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """Passages that other documents share: ``rid``, ``key``, ``start`` and
    ``end`` (code points, end exclusive), ``n_words``, and ``first``: whether
    this document is the least by (key, rid) that holds its chunks.

    A stretch of shared chunks counts if it has ``least_words``; it is given in
    parts, one for each change of ``first``, and ``n_words`` is that of the
    whole stretch.  So each chunk is first in one document only, and a common
    line next to a passage doesn't change whose the passage is.

    ``rid`` is unique; null keys come first.  Null and empty texts have no
    passages.  Repeats within one document only don't count.  The count per
    digest has a map side, and a digest of very many chunks is met again in a
    join of two plain shuffles, which adaptive execution can split.
    """
    made = rows.select(F.col(rid).alias("rid"), F.col(key).alias("key"), C.arrow_struct(chunks, CHUNKS)(F.col(text).cast("string")).alias("c"))
    made = C.written(made, "chunks")
    each = made.select("rid", "key", F.posexplode(F.arrays_zip("c.digest", "c.start", "c.end", "c.words")).alias("i", "x"))
    each = each.select("rid", "key", "i", "x.digest", "x.start", "x.end", "x.words")
    holders = each.groupBy("digest").agg(F.min("rid").alias("a"), F.max("rid").alias("b"), F.min(F.struct("key", "rid"))["rid"].alias("least"))
    shared = C.written(holders.filter("a < b").select("digest", "least"), "shared")
    found = each.join(shared, "digest").select("rid", "key", "i", "start", "end", "words", (F.col("rid") == F.col("least")).alias("first"))
    number = lambda *by: F.col("i") - F.row_number().over(Window.partitionBy(*by).orderBy("i"))  # noqa: E731  the same in consecutive chunks
    parts = found.withColumn("run", number("rid")).withColumn("part", number("rid", "first")).groupBy("rid", "run", "first", "part").agg(
        F.first("key").alias("key"), F.min("start").alias("start"), F.max("end").alias("end"), F.sum("words").alias("words")
    )
    passages = parts.withColumn("n_words", F.sum("words").over(Window.partitionBy("rid", "run")))
    return passages.filter(F.col("n_words") >= least_words).select("rid", "key", "start", "end", "n_words", "first")


def _without_spans(text: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for t, cut in zip(text.to_pylist(), spans.to_pylist(), strict=True):
        if t is None or not cut:
            out.append(t)
            continue
        at, kept = 0, []
        for x in sorted(cut, key=lambda x: x["start"]):
            kept.append(t[at : x["start"]])
            at = x["end"]
        out.append("".join([*kept, t[at:]]))
    return pa.array(out, pa.string())


def substring_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", out: str = "repeats") -> DataFrame:
    """``docs`` without the later copies of repeated passages, and an array
    column ``out`` of the passages removed (start, end in the old text).

    Every row stays, and each shared chunk in the row of the least key, of
    equal keys in the first row read.  A column named ``out`` is replaced.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = C.written(docs.select(F.monotonically_increasing_id().alias("rid"), row.alias("row")), "rows")
    base = rows.select("rid", F.col(f"row.`{key}`").alias("key"), F.col(f"row.`{text}`").cast("string").alias("text"))
    spans = repeated_passages(base).filter("not first").groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    got = rows.join(spans, "rid", "left").withColumn("spans", F.coalesce("spans", F.array().cast("array<struct<start:bigint,end:bigint>>")))
    cut = F.arrow_udf(_without_spans, T.StringType())(F.col(f"row.`{text}`").cast("string"), "spans")
    keep = [c for c in docs.columns if c.lower() != out.lower()]
    return got.select(*[(cut if c == text else F.col(f"row.`{c}`")).alias(c) for c in keep], F.col("spans").alias(out))
