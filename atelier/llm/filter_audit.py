"""What each filter of a chain removes, in every order of the chain.

Four filters look at a text alone, the fifth at copies of it.  A copy is found
by tries: each task inserts its texts into a compressed trie whose terminals
hold the least document id, so that a text which many rows share leaves the
task once.  These texts are range-partitioned by a prefix that is lengthened
where too many share it, and the tries of the ranges hold the least id of the
whole table.  Every document then has a mask of the filters that it fails, and
the audit of all orders needs only the documents of each part and mask.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atelier.llm import common as C

FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 200, 50, 2
SYMBOLS = b"#$%&*|"
#: Bytes of text that a trie holds before it is handed on.
TRIE_BYTES = 16 << 20
#: Shares of a shuffle partition's mean bytes that may have one prefix, bytes
#: that always may, and the prefix lengths tried.
SHARES, RANGE_BYTES, PREFIXES = 4, 1 << 20, (16, 64, 256, 1024)


class Trie:
    """A compressed (radix) trie over byte strings.

    A node is ``[children, least, entry]``: children by first byte as ``(label,
    node)``; a terminal holds the least id of its text (None if none has an id)
    and its number.
    """

    def __init__(self) -> None:
        self.root: list = [{}, None, -1]
        self.size = self.bytes = 0

    def insert(self, text: bytes, key: int | None) -> int:
        """Adds a text; returns its number, counted by distinct texts."""
        node, at = self.root, 0
        while at < len(text):
            found = node[0].get(text[at])
            if found is None:
                leaf: list = [{}, None, -1]
                node[0][text[at]] = (text[at:], leaf)
                self.bytes += len(text) - at
                node, at = leaf, len(text)
                break
            label, below = found
            if text.startswith(label, at):
                node, at = below, at + len(label)
                continue
            # the edge parts where the text does
            k = _common(label, text, at)
            middle: list = [{label[k]: (label[k:], below)}, None, -1]
            node[0][label[0]] = (label[:k], middle)
            node, at = middle, at + k
        if node[2] < 0:
            node[2] = self.size
            self.size += 1
        if key is not None and (node[1] is None or key < node[1]):
            node[1] = key
        return node[2]

    def terminals(self) -> Iterator[tuple[bytes, int | None, int]]:
        """Text, least id and number of every terminal."""
        todo: list = [(b"", self.root)]
        while todo:
            text, node = todo.pop()
            if node[2] >= 0:
                yield text, node[1], node[2]
            todo += [(text + label, below) for label, below in node[0].values()]

    def least(self) -> list[int | None]:
        """The least id of each text by its number."""
        out: list = [None] * self.size
        todo = [self.root]
        while todo:
            node = todo.pop()
            if node[2] >= 0:
                out[node[2]] = node[1]
            todo += [below for _, below in node[0].values()]
        return out


def _common(label: bytes, text: bytes, at: int) -> int:
    """How many bytes of ``label`` agree with ``text`` from ``at`` on; not all."""
    low, high = 0, min(len(label), len(text) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if label[low:middle] == text[at + low : at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


def text_masks(view: C.Text) -> np.ndarray:
    """Bits of the filters A to D that each text fails."""
    s, e, row = view.words()
    words = np.bincount(row, minlength=view.n)
    mark = view.hashes(view.sums(C.BYTE_CODE), s, e)
    order = np.lexsort((mark, row))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(row[order]) != 0) | (mark[order][1:] != mark[order][:-1])
    distinct = np.bincount(row[order][new], minlength=view.n)
    data = view.data
    capitals = view.row_sums((data - np.uint8(65)) < 26)
    chars = view.row_sums((data & 0xC0) != 0x80)
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    fails = [words < LEAST_WORDS, 100 * distinct < LEAST_DISTINCT * words, 100 * capitals > MOST_CAPITALS * chars, view.row_sums(symbol[data]) > 0]
    return sum(f.astype(np.int64) << k for k, f in enumerate(fails))


_ROW = pa.schema([("key", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("number", pa.int64()), ("least", pa.int64()), ("size", pa.int64()), ("text", pa.binary())])


def _insert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of documents (key, part, mask, number of their text) and, when a
    trie is full, of its texts (number, least id, text)."""
    trie, base = Trie(), TaskContext.get().partitionId() << 36

    def texts() -> Iterator[pa.RecordBatch]:
        held: list = []
        size = 0
        for text, least, number in trie.terminals():
            held.append((base + number, least, text))
            size += len(text)
            if size > 1 << 20:
                yield _texts(held)
                held, size = [], 0
        if held:
            yield _texts(held)

    C.release()
    for batch in batches:
        keys = batch["key"].to_pylist()
        at = 0
        for view in C.texts(batch["text"]):
            if not view.n:
                continue
            masks = text_masks(view)
            raw, off = view.data.tobytes(), view.off.tolist()
            numbers = [base + trie.insert(raw[off[i] : off[i + 1]], keys[at + i]) for i in range(view.n)]
            part = batch.slice(at, view.n)
            made = {"key": part["key"], "part": part["part"], "mask": pa.array(masks, pa.int32()), "number": pa.array(numbers, pa.int64())}
            yield _rows(view.n, made)
            at += view.n
            if trie.bytes >= TRIE_BYTES:
                yield from texts()
                base += trie.size
                trie = Trie()
    yield from texts()


def _rows(n: int, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in _ROW], schema=_ROW)


def _texts(held: list) -> pa.RecordBatch:
    numbers, least, text = zip(*held, strict=True)
    size = pa.array([len(t) for t in text], pa.int64())
    return _rows(len(held), {"number": pa.array(numbers, pa.int64()), "least": pa.array(least, pa.int64()), "size": size, "text": pa.array(text, pa.binary())})


def _least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number and least id of texts that come sorted by ``prefix``, of which
    equal texts have the same: a full trie is let go where the prefix changes."""
    schema = pa.schema([("number", pa.int64()), ("least", pa.int64())])
    trie, held, last = Trie(), [], None

    def found() -> Iterator[pa.RecordBatch]:
        least = trie.least()
        for i in range(0, len(held), 10_000):
            some = held[i : i + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in some], pa.int64()), pa.array([least[t] for _, t in some], pa.int64())], schema=schema)

    C.release()
    parts = (batch.slice(i, 500) for batch in batches for i in range(0, batch.num_rows, 500))
    for batch in parts:
        for prefix, number, least, text in zip(*(batch[c].to_pylist() for c in ("prefix", "number", "least", "text")), strict=True):
            if trie.bytes >= TRIE_BYTES and prefix != last:
                yield from found()
                trie, held = Trie(), []
            last = prefix
            held.append((number, trie.insert(text, least)))
    yield from found()


def _prefixed(texts: DataFrame, partitions: int) -> DataFrame:
    """``texts`` with ``prefix``: as short a beginning as few enough bytes
    share, or the longest that is tried.  The prefixes that are lengthened are
    ``SHARES`` times the partitions at most, by the bytes that each has."""
    spark = texts.sparkSession
    total = texts.agg(F.sum("size")).first()[0] or 0
    most = max(RANGE_BYTES, total // (SHARES * partitions))
    open_ = texts.select("text", "size")
    prefix = F.substring("text", 1, PREFIXES[0])
    for short, long in zip(PREFIXES[:-1], PREFIXES[1:], strict=True):
        beginning = F.substring("text", 1, short)
        heavy = open_.groupBy(beginning.alias("_heavy")).agg(F.sum("size").alias("size"), F.count("*").alias("n")).filter(f"size > {most} and n > 1").select("_heavy").collect()
        if not heavy:
            break
        heavy = F.broadcast(spark.createDataFrame([(bytes(r[0]),) for r in heavy], "_heavy binary"))
        open_ = open_.join(heavy, beginning == F.col("_heavy"), "left_semi")
        texts = texts.join(heavy.withColumn(f"_deep{long}", F.lit(True)), beginning == F.col("_heavy"), "left").drop("_heavy")
        prefix = F.when(F.col(f"_deep{long}"), F.substring("text", 1, long)).otherwise(prefix)
    return texts.withColumn("prefix", prefix).select("prefix", "number", "least", "text")


def filter_masks(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """Per document: ``key``, ``part``, ``mask``: bit k is set if the document
    fails filter k of ``ABCDE``.

    A: under 200 words; B: distinct words under half of the words; C: capitals
    A-Z over 2 % of the characters; D: one of ``#$%&*|``; E: the text of a
    smaller key anywhere in the table.  Words lie between ASCII white space.
    Null texts count as empty; a null part is the empty one; a null key is
    neither smaller nor greater than another, and rows of one key are not each
    other's copies.  An empty table gives none; other columns are not read.
    """
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    made = C.written(rows.mapInArrow(_insert, "key long, part string, mask int, number long, least long, size long, text binary"), "tries")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = _prefixed(made.filter("size is not null").select("number", "least", "size", "text"), n)
    dealt = texts.repartitionByRange(n, "prefix").sortWithinPartitions("prefix")
    least = dealt.mapInArrow(_least, "number long, least long")
    members = made.filter("size is null").select("key", "part", "mask", "number")
    copy = F.coalesce(F.col("key") > F.col("least"), F.lit(False))
    return members.join(least, "number").select(F.col("key").alias(key), "part", (F.col("mask") + F.when(copy, 16).otherwise(0)).cast("int").alias("mask"))


def interaction_audit(masks: DataFrame, flags: DataFrame, key: str = "doc_id") -> DataFrame:
    """A row per part, order of the filters and step: ``kept``, ``removed``,
    ``redundant``, ``unique_fails``, ``good_lost``, ``toxic_lost``, ``shapley``.

    ``flags (key, quality, toxic)`` marks documents; a document is good or
    toxic if any of its rows says 1.  Keys without a row and null keys are
    neither.  What reaches the orders is a row per part: the documents, good
    and toxic ones of each of the 32 masks.
    """
    marks = flags.groupBy(F.col(f"`{key}`").cast("long").alias("_key")).agg(F.max(F.expr("int(quality = 1)")).alias("good"), F.max(F.expr("int(toxic = 1)")).alias("toxic"))
    joined = masks.join(marks, F.col(key) == F.col("_key"), "left")
    cells = joined.groupBy("part", "mask").agg(F.count("*").alias("n"), F.sum(F.coalesce("good", F.lit(0))).alias("good"), F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic"))
    per = [F.sum(F.when(F.col("mask") == m, F.col(c)).otherwise(0)).alias(f"{c}{m}") for c in ("n", "good", "toxic") for m in range(32)]
    wide = cells.groupBy("part").agg(*per)
    wide = wide.select("part", *[F.array(*[f"{c}{m}" for m in range(32)]).alias(c) for c in ("n", "good", "toxic")])

    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    steps = wide.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.array(*map(F.lit, range(1, 6)))))
    steps = steps.withColumn("bit", F.expr(f"shiftleft(1, locate(substring(filter_order, step, 1), '{FILTERS}') - 1)"))
    steps = steps.withColumn("before", F.expr(f"aggregate(sequence(1, 5), 0, (a, i) -> a + if(i < step, shiftleft(1, locate(substring(filter_order, i, 1), '{FILTERS}') - 1), 0))"))

    def total(cell: str, condition: str) -> str:
        return f"aggregate(sequence(0, 31), 0L, (a, m) -> a + if({condition}, {cell}, 0L))"

    here = "m & bit > 0 and m & before = 0"
    return steps.selectExpr(
        "part", "filter_order", "step",
        total("n[m]", "m & (before | bit) = 0") + " as kept", total("n[m]", here) + " as removed",
        total("n[m]", "m & bit > 0 and m & before > 0") + " as redundant", total("n[m]", "m = bit") + " as unique_fails",
        total("good[m]", here) + " as good_lost", total("toxic[m]", here) + " as toxic_lost",
        # of the 120 orders a filter comes first among the failed ones in 120 / their number
        total("n[m] * (120L div bit_count(m))", "m & bit > 0") + " as shapley",
    )
