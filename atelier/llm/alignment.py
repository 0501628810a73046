"""Alignment of two tokenizers over a corpus, with corpus-wide counts of their
pairs of tokens.

Every text is cut by both tokenizers; where tokens of both end at the same byte
a group ends, and the last token of either side in it are linked.  How often two
ids are linked anywhere, and which of an id's partners is linked most often,
takes an external count:

* each task buffers its links, sorts them by (B id, A id, document) and writes
  them as zstandard runs, one for each radix of the B id;
* some runs of a radix are merged through a heap, which counts every pair of
  them; the counts of all merges add up to those of the corpus, and in B-major
  order to each B id's maximum;
* every merge gets the totals of its own pairs back, and its runs are streamed
  once more into contributions to the documents.

A pair that holds a third of all links has one counter per merge, and its
documents stay spread over all runs.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from atelier.llm import bpe as B
from atelier.llm import common as C

#: Radixes of the B id, links that a task buffers, and runs that are merged together.
RADIXES, BUFFER_LINKS, MERGED_RUNS = 8, 2_000_000, 16
#: Bytes of text that are aligned at once.
SLICE = 1 << 20
#: A pair is (B id) * PAIR + (A id).
PAIR = 1 << 21
#: Bits for the documents of one run.
ROW_BITS = 21


class Pieces:
    """A sentencepiece model and its pieces' bytes."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = []
        for i in range(self.model.get_piece_size()):
            p = self.model.id_to_piece(i)
            pieces.append(bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode())
        self.size = np.array([len(p) for p in pieces], np.int64)
        self.offset = np.cumsum(self.size) - self.size
        self.blob = np.frombuffer(b"".join(pieces), np.uint8)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        made = self.model.encode(texts, num_threads=1)
        counts = np.array([len(m) for m in made], np.int64)
        return np.fromiter((i for m in made for i in m), np.int64, int(counts.sum())), counts

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = self.size[ids]
        return self.blob[B.ragged(self.offset[ids], size)], size


def _decimals(ids: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of every id in decimal with each ending: ``, | ;`` or none."""
    made = [f"{i}{end}".encode() for i in range(ids) for end in (",", "|", ";", "")]
    size = np.array([len(m) for m in made], np.int64)
    return np.frombuffer(b"".join(made), np.uint8), np.cumsum(size) - size, size


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of each row's run of ``values``."""
    total = np.concatenate([[0], np.cumsum(values)])
    end = np.cumsum(counts)
    return total[end] - total[end - counts]


def _tables(a_path: str, b_path: str) -> tuple:
    a, b = B.ByteBpe(a_path), Pieces(b_path)
    return a, b, _decimals(max(len(a.size), len(b.size)))


class Aligned:
    """Tokens, groups and links of consecutive non-empty texts."""

    def __init__(self, a: B.ByteBpe, b: Pieces, texts: pa.Array):
        spaced = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts.cast(pa.large_string()), pa.scalar("", pa.large_string()))
        self.n = len(texts)
        ids_a, n_a = B.encoded(a, spaced, special=False)
        ids_b, n_b = b.encode(texts.to_pylist())
        data, size_a = a.decode(ids_a)
        other, size_b = b.decode(ids_b)
        # rows whose pieces are not the text's bytes have no tokens
        bytes_a, bytes_b = _sums(size_a, n_a), _sums(size_b, n_b)
        good = bytes_a == bytes_b
        same = data[B.ragged((np.cumsum(bytes_a) - bytes_a)[good], bytes_a[good])] == other[B.ragged((np.cumsum(bytes_b) - bytes_b)[good], bytes_b[good])]
        good[np.flatnonzero(good)[_sums((~same).astype(np.int64), bytes_a[good]) > 0]] = False
        if not good.all():
            in_a, in_b = np.repeat(good, n_a), np.repeat(good, n_b)
            ids_a, size_a, ids_b, size_b = ids_a[in_a], size_a[in_a], ids_b[in_b], size_b[in_b]
            n_a, n_b = n_a * good, n_b * good
        self.n_a, self.n_b = n_a, n_b
        end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
        self.ends_a, self.ends_b = np.isin(end_a, end_b, assume_unique=True), np.isin(end_b, end_a, assume_unique=True)
        self.ids_a, self.ids_b = ids_a.astype(np.int64), ids_b
        self.n_links = _sums(self.ends_a.astype(np.int64), n_a)
        self.pairs = self.ids_b[self.ends_b] * PAIR + self.ids_a[self.ends_a]

    def groups(self, decimals: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pa.Array:
        """``a1,a2|b1;a3|b2,b3`` of each row."""
        na, nb = len(self.ids_a), len(self.ids_b)
        # in a group B's tokens follow A's
        group_a, group_b = np.cumsum(self.ends_a) - self.ends_a, np.cumsum(self.ends_b) - self.ends_b
        first_b = np.concatenate([[0], np.flatnonzero(self.ends_b) + 1])
        after_a = np.flatnonzero(self.ends_a) + 1
        code = np.empty(na + nb, np.int64)
        code[np.arange(na) + first_b[group_a]] = self.ids_a * 4 + self.ends_a
        kind = np.where(self.ends_b, 2, 0)
        kind[(np.cumsum(self.n_b) - 1)[self.n_b > 0]] = 3
        code[np.arange(nb) + after_a[group_b]] = self.ids_b * 4 + kind
        blob, offset, size = decimals
        size = size[code]
        return B.binaries(blob[B.ragged(offset[code], size)], _sums(size, self.n_a + self.n_b)).cast(pa.large_string())


class Runs:
    """A task's buffered links; full buffers become one run for each radix."""

    def __init__(self, most: int = BUFFER_LINKS, radixes: int = RADIXES):
        self.most, self.radixes = most, radixes
        self.made = 0
        self._clear()

    def _clear(self) -> None:
        self.links, self.rids, self.n, self.rows = [], [], 0, 0

    def add(self, rids: np.ndarray, n_links: np.ndarray, pairs: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
        """Takes rows and their links; yields (run, radix, blob) if full."""
        row = np.repeat(np.arange(len(rids)) + self.rows, n_links)
        self.links.append(pairs << ROW_BITS | row)
        self.rids.append(rids)
        self.n += len(pairs)
        self.rows += len(rids)
        if self.n >= self.most or self.rows >= (1 << ROW_BITS) - (1 << 16):
            yield from self.flush()

    def flush(self) -> Iterator[tuple[int, int, bytes]]:
        if self.n:
            key = np.sort(np.concatenate(self.links))
            first = np.flatnonzero(np.diff(key, prepend=-1))
            times = np.diff(first, append=len(key))
            key, rids = key[first], np.concatenate(self.rids)
            radix = (key >> ROW_BITS) // PAIR % self.radixes
            for k in range(self.radixes):
                at = np.flatnonzero(radix == k)
                if len(at):
                    yield self.made, k, pack_run(key[at] >> ROW_BITS, key[at] & (1 << ROW_BITS) - 1, times[at], rids)
            self.made += 1
        self._clear()


def pack_run(pairs: np.ndarray, rows: np.ndarray, times: np.ndarray, rids: np.ndarray) -> bytes:
    """Sorted records as two zstandard frames: pairs with their number of
    documents and links; then documents, times and the documents' ids."""
    import zstandard

    zipped = zstandard.ZstdCompressor(level=3, write_checksum=True)
    first = np.flatnonzero(np.diff(pairs, prepend=-1))
    docs = np.diff(first, append=len(pairs))
    head = np.concatenate([np.diff(pairs[first], prepend=0), docs, np.add.reduceat(times, first)]).astype("<i8")
    body = rows.astype("<u4").tobytes() + times.astype("<u4").tobytes() + np.diff(rids, prepend=0).astype("<i8").tobytes()
    head, body = zipped.compress(head.tobytes()), zipped.compress(body)
    return np.array([len(first), len(pairs), len(head)], "<i8").tobytes() + head + body


def run_head(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs, documents and links of each pair."""
    import zstandard

    n, _, size = np.frombuffer(blob, "<i8", 3)
    head = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[24 : 24 + size]), "<i8").reshape(3, n)
    return np.cumsum(head[0]), head[1], head[2]


def run_body(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and times of each record, and the ids of the rows."""
    import zstandard

    _, n, size = (int(x) for x in np.frombuffer(blob, "<i8", 3))
    body = zstandard.ZstdDecompressor().decompress(blob[24 + size :])
    rows, times = np.frombuffer(body, "<u4", 2 * n).reshape(2, n)
    return rows, times, np.cumsum(np.frombuffer(body, "<i8", -1, 8 * n))


def merge_counts(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of some runs in order and their links, by a heap over the
    runs."""
    heads = [run_head(b) for b in blobs]
    merged = heapq.merge(*[zip(p.tolist(), n.tolist(), strict=True) for p, _, n in heads])
    out = [(pair, sum(n for _, n in same)) for pair, same in groupby(merged, itemgetter(0))]
    both = np.array(out, np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _slices(text: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``SLICE`` bytes of text."""
    size = np.cumsum(pc.binary_length(text).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(text):
        base = int(size[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(size, base + SLICE, "right")))
        yield at, to
        at = to


def _align(a_path: str, b_path: str, schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a, b, decimals = C.kept(("pair", a_path, b_path), lambda: _tables(a_path, b_path))
    runs = Runs()
    task = TaskContext.get().partitionId()

    def rows(**columns) -> pa.RecordBatch:
        n = len(next(iter(columns.values())))
        made = [columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in schema]
        return pa.RecordBatch.from_arrays([c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(made, schema, strict=True)], schema=schema)

    def packed(found: Iterator[tuple[int, int, bytes]]) -> Iterator[pa.RecordBatch]:
        for run, radix, blob in found:
            yield rows(run=[task << 32 | run], radix=[radix], blob=[blob])

    for batch in batches:
        batch = pa.RecordBatch.from_arrays([c.fill_null("") if f.name == "text" else c for c, f in zip(batch.columns, batch.schema, strict=True)], names=batch.schema.names)
        for s, e in _slices(batch["text"]):
            part = batch.slice(s, e - s)
            some = np.flatnonzero(pc.binary_length(part["text"]).to_numpy(zero_copy_only=False) > 0)
            made = Aligned(a, b, part["text"].take(pa.array(some)))
            rids = part["rid"].to_numpy()
            counts = {name: np.zeros(e - s, np.int64) for name in ("n_a", "n_b", "n_links")}
            for name, n in counts.items():
                n[some] = getattr(made, name)
            texts = made.groups(decimals)
            texts = texts if len(some) == e - s else _spread(texts, some, e - s)
            yield rows(rid=part["rid"], key=part["key"], groups=texts, **counts)
            yield from packed(runs.add(rids[some], made.n_links, made.pairs))
    yield from packed(runs.flush())


def _spread(values: pa.Array, at: np.ndarray, n: int) -> pa.Array:
    """``values`` at the places ``at`` of n, empty strings elsewhere."""
    index = np.full(n, len(values))
    index[at] = np.arange(len(values))
    return pa.concat_arrays([values, pa.array([""], values.type)]).take(pa.array(index))


def align_tokenizers(docs: DataFrame, a: str, b: str, key: str = "doc_id", text: str = "text", keep: dict[str, Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """Documents and pairs of two tokenizers' alignment.

    ``a`` is a byte-level BPE file, read as for a text behind a blank; ``b`` a
    sentencepiece model, which adds that blank.  Special tokens' strings are
    ordinary text.  Documents: ``key``, ``n_a``, ``n_b`` (tokens), ``n_groups``,
    ``n_links``, ``n_best`` (links whose pair is its B id's most frequent, ties
    included), ``count_sum`` (sum of the links' pair counts) and what ``keep``
    makes of ``groups``, the text ``a1,a2|b1;a3|b2,b3`` (by default the text
    itself; it is several times as long as the document and is not stored
    unless kept).  Pairs: ``a_id``, ``b_id``, ``links``, ``best``.

    Texts that are null, empty or not spelt by their tokens have no tokens:
    zeros and an empty text.  Each row counts by itself, repeated rows and keys,
    null keys and ties included; other columns are not read; an empty table
    gives two empty tables.
    """
    kind = docs.schema[key].dataType
    keep = keep or {"groups": F.col("groups")}
    fields = T.StructType().add("rid", "long").add("key", kind).add("n_a", "long").add("n_b", "long").add("n_links", "long").add("groups", "string").add("run", "long").add("radix", "integer").add("blob", "binary")
    from functools import partial

    from pyspark.sql.pandas.types import to_arrow_schema

    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    made = rows.mapInArrow(partial(_align, a, b, to_arrow_schema(fields)), fields)
    kept = [c.alias(f"keep_{i}") for i, c in enumerate(keep.values())]
    made = C.written(made.select(*[f for f in fields.names if f != "groups"], *kept), "aligned")

    runs = made.filter("run is not null").select("run", "radix", "blob")
    merges = -(-runs.select("run").distinct().count() // MERGED_RUNS)
    runs = runs.select("radix", F.pmod(F.xxhash64("run"), F.lit(max(merges, 1))).cast("int").alias("part"), "blob")

    def count(group: tuple, table: pa.Table) -> pa.Table:
        pairs, links = merge_counts(table["blob"].to_pylist())
        n = len(pairs)
        return pa.table({"radix": pa.array([group[0].as_py()] * n, pa.int32()), "part": pa.array([group[1].as_py()] * n, pa.int32()), "pair": pairs, "links": links})

    partial_counts = C.written(runs.groupBy("radix", "part").applyInArrow(count, "radix int, part int, pair long, links long"), "counts")
    side = F.expr(f"pair div {PAIR}L")
    totals = partial_counts.groupBy("pair").agg(F.sum("links").alias("links"))
    most = totals.groupBy(side.alias("b_id")).agg(F.max("links").alias("most"))  # a row per id of B's vocabulary at most
    totals = C.written(totals.withColumn("b_id", side).join(F.broadcast(most), "b_id").select("pair", "b_id", "links", (F.col("links") == F.col("most")).alias("best")), "pairs")

    def contribute(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(right["pair"].to_numpy())
        pair, links, best = (right[c].to_numpy()[order].astype(np.int64) for c in ("pair", "links", "best"))
        out = []
        for blob in left["blob"].to_pylist():
            mine, documents, _ = run_head(blob)
            at = np.repeat(np.searchsorted(pair, mine), documents)
            records, times, rids = run_body(blob)
            sums = [np.zeros(len(rids), np.int64), np.zeros(len(rids), np.int64)]
            np.add.at(sums[0], records, times * best[at])
            np.add.at(sums[1], records, times * links[at])
            some = np.flatnonzero(sums[1])
            out.append((rids[some], sums[0][some], sums[1][some]))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3
        return pa.table(dict(zip(("rid", "n_best", "count_sum"), columns, strict=True)))

    back = partial_counts.select("radix", "part", "pair").join(totals.select("pair", "links", "best"), "pair")
    given = runs.groupBy("radix", "part").cogroup(back.groupBy("radix", "part")).applyInArrow(contribute, "rid long, n_best long, count_sum long")
    given = given.groupBy("rid").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    documents = made.filter("run is null").join(given, "rid", "left").select(
        F.col("key").alias(key), "n_a", "n_b", F.col("n_links").alias("n_groups"), "n_links",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")], *[F.col(f"keep_{i}").alias(name) for i, name in enumerate(keep)],
    )
    pairs = totals.select(F.expr(f"pair % {PAIR}L").alias("a_id"), "b_id", "links", "best")
    return documents, pairs
