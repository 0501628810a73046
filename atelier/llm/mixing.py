"""Mixing sources to target weights.

The words of each source are packed, document after document, into blocks of
fixed length.  Every output shard draws multinomial counts of its slots over
the sources.  A source that has met its quota takes no more of what later
shards draw, and the slots that these have left go to the sources that are
still short, in order.  A source's slots, numbered over the shards, map to its
blocks by a pseudorandom permutation of the block numbers, another one for each
pass over the source; slots and blocks are joined by that number.  Within a
shard the slots are permuted too.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from atelier.llm import common as C

BLOCK_WORDS, SHARD_SLOTS, MOST_PASSES, SEED = 512, 4096, 3, 20240607
#: Documents of a source that are laid out by one task; sources that a shard draws from at once.
BUCKET_ROWS, GROUP_SOURCES = 1000, 1000
_U = np.uint64
_ROUNDS = C.mix(np.arange(1, 7, dtype=_U))


def permuted(i: np.ndarray, n: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """Where a keyed permutation of 0 ... n - 1 takes i: a Feistel network on
    the next power of four, walked until the value is below n."""
    half = np.maximum(1, np.ceil(np.log2(np.maximum(n, 2).astype(float) + 1) / 2)).astype(_U)
    mask = (_U(1) << half) - _U(1)
    x = i.astype(_U)
    todo = np.arange(len(x))
    while len(todo):
        h, m = half[todo], mask[todo]
        left, right = x[todo] >> h, x[todo] & m
        for k in range(len(_ROUNDS)):
            left, right = right, left ^ (C.mix(right + seed[todo] * _U(0x9FB21C651E98DF25) + _ROUNDS[k]) & m)
        x[todo] = (left << h) | right
        todo = todo[x[todo] >= n[todo].astype(_U)]
    return x.astype(np.int64)


def targets(sources: DataFrame) -> DataFrame:
    """``sources (source, source_size, ...)`` with ``no``, ``weight`` and
    ``target``.

    Ordered by code point, null last, they weigh 1, 2, 3, 1, ...  All words
    are shared by weight; a target stops at three times its source's size, and
    the excess is shared again among the rest until none is above.  One number
    per round reaches the driver.
    """
    s = C.numbered(sources, [F.col("source").isNull(), F.col("source")], "no")
    s = C.written(s.withColumn("weight", (F.col("no") % 3 + 1).cast("double")), "sources")
    most = F.lit(float(MOST_PASSES)) * F.col("source_size")
    total = float(s.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    while True:
        full = most <= level * F.col("weight")
        used, rest = s.agg(F.sum(F.when(full, most).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        if not rest:
            break
        raised = max((total - used) / rest, level)
        if raised <= level * (1 + 1e-12):
            break
        level = raised
    return s.withColumn("target", F.least(most, level * F.col("weight")))


def _draw(shares: np.ndarray, total: int, slots: int, seed: int, batches):
    """Multinomial counts over the groups of sources for each shard."""
    p = shares / shares.sum()
    for batch in batches:
        for shard in batch["shard"].to_pylist():
            n = np.random.Generator(np.random.PCG64([seed, int(shard)])).multinomial(min(slots, total - slots * int(shard)), p)
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), shard)), pa.array(some), pa.array(n[some])], names=["shard", "group", "n"])


def _draw_within(seed: pa.Array, shard: pa.Array, group: pa.Array, n: pa.Array, quotas: pa.Array) -> pa.Array:
    """Multinomial counts over the sources of a group."""
    out = []
    for z, k, g, m, q in zip(*(a.to_pylist() for a in (seed, shard, group, n, quotas)), strict=True):
        q = np.array(q, float)
        out.append(np.random.Generator(np.random.PCG64([z, k, g])).multinomial(m, q / q.sum()).tolist())
    return pa.array(out, pa.list_(pa.int64()))


def shard_counts(sources: DataFrame, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """The slots of each shard: ``shard, no, first, n, drawn``: n slots of
    source ``no``, its slots ``first ...``, of ``drawn`` that the shard drew
    (null: slots that were left over).

    ``sources (no, slots)``.  Every shard has ``shard_slots`` slots, the last
    one what is left, and every source has its ``slots`` over all shards.  One
    number per ``GROUP_SOURCES`` sources reaches the driver.
    """
    spark = sources.sparkSession
    q = sources.select("no", "slots", F.expr(f"no div {GROUP_SOURCES}").alias("group"))
    groups = q.groupBy("group").agg(F.sum("slots").alias("n"), F.sort_array(F.collect_list(F.struct("no", "slots"))).alias("of"))  # lists of GROUP_SOURCES
    shares = {r[0]: r[1] for r in groups.select("group", "n").collect()}
    total = sum(shares.values())
    schema = "shard long, group long, n long"
    if total:
        p = np.array([shares.get(g, 0) for g in range(max(shares) + 1)], float)
        drawn = spark.range(-(-total // shard_slots)).withColumnRenamed("id", "shard").mapInArrow(partial(_draw, p, total, shard_slots, seed), schema)
    else:
        drawn = spark.createDataFrame([], schema)
    counts = F.arrow_udf(_draw_within, T.ArrayType(T.LongType()))(F.lit(seed), "shard", "group", "n", F.col("of.slots"))
    drawn = drawn.join(groups.select("group", "of"), "group").select("shard", F.explode(F.arrays_zip(F.col("of.no").alias("no"), counts.alias("drawn"))).alias("x"))
    drawn = C.written(drawn.select("shard", "x.no", "x.drawn").filter("drawn > 0"), "drawn")

    # a source takes what is drawn up to its slots
    taken = C.running_totals(drawn, "no", "shard", "drawn", "first").join(sources.select("no", "slots"), "no").filter("first < slots")
    taken = C.written(taken.select("shard", "no", "first", F.least("drawn", F.col("slots") - F.col("first")).alias("n"), "drawn"), "taken")
    # the slots of a shard that are free meet those that a source still lacks, both in order
    short = sources.join(taken.groupBy("no").agg(F.sum("n").alias("had")), "no", "left").withColumn("had", F.coalesce("had", F.lit(0)))
    short = short.select(F.lit(0).alias("_all"), "no", "had", (F.col("slots") - F.col("had")).alias("lacks"))
    free = spark.range(-(-total // shard_slots)).withColumnRenamed("id", "shard").join(taken.groupBy("shard").agg(F.sum("n").alias("used")), "shard", "left")
    size = F.least(F.lit(shard_slots), F.lit(total) - F.col("shard") * shard_slots)
    free = free.select(F.lit(0).alias("_all"), "shard", (size - F.coalesce("used", F.lit(0))).alias("free"))

    def cells(df: DataFrame, order: str, value: str, low: str, high: str) -> DataFrame:
        placed = C.running_totals(df, "_all", order, value, low).filter(f"{value} > 0").withColumn(high, F.col(low) + F.col(value))
        return placed.withColumn("cell", F.explode(F.expr(f"sequence({low} div {shard_slots}, ({high} - 1) div {shard_slots})")))

    met = cells(short, "no", "lacks", "s0", "s1").join(cells(free, "shard", "free", "f0", "f1").drop("_all"), "cell")
    met = met.withColumn("low", F.greatest("s0", "f0", F.col("cell") * shard_slots)).withColumn("high", F.least("s1", "f1", (F.col("cell") + 1) * shard_slots)).filter("low < high")
    filled = met.select("shard", "no", (F.col("had") + F.col("low") - F.col("s0")).alias("first"), (F.col("high") - F.col("low")).alias("n"), F.lit(None).cast("long").alias("drawn"))
    return taken.union(filled)


def _shuffled(seed: pa.Array, i: pa.Array, size: pa.Array, shard: pa.Array) -> pa.Array:
    seed, i, size, shard = (a.to_numpy().astype(np.int64) for a in (seed, i, size, shard))
    return pa.array(permuted(i, size, C.mix((shard + seed).astype(_U))))


def _to_blocks(seed: pa.Array, no: pa.Array, slot: pa.Array, full: pa.Array, blocks: pa.Array) -> pa.Array:
    seed, no, slot, full, blocks = (a.to_numpy().astype(np.int64) for a in (seed, no, slot, full, blocks))
    turn, i = slot // blocks, slot % blocks
    out = i.copy()
    inner = i < full  # the tail, a shorter block, comes last in every pass
    out[inner] = permuted(i[inner], full[inner], C.mix((no * 65_537 + turn + seed).astype(_U))[inner])
    return pa.array(out)


def plan(rows: DataFrame, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Sources with their targets, and the words that the mix takes.

    ``rows``: ``rid`` (unique), ``source``, ``size`` and ``h`` (a hash by which
    a source's documents are laid out).  Taken: ``rid``, ``pass``, the words
    ``[a, b)`` of the document, and where they go: ``shard``, ``slot`` and ``x``,
    the words of the slot before them.
    """
    summed = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    s = targets(summed)
    whole = F.round("target").cast("long")
    s = s.withColumn("whole", F.when(F.col("source_size") > 0, F.least(whole, MOST_PASSES * F.col("source_size"))).otherwise(0))
    s = s.withColumn("full", F.expr(f"source_size div {BLOCK_WORDS}")).withColumn("blocks", F.expr(f"(source_size + {BLOCK_WORDS - 1}) div {BLOCK_WORDS}"))
    s = s.withColumn("passes", F.expr("if(source_size > 0, whole div source_size, 0L)")).withColumn("rest", F.expr("whole - passes * source_size"))
    # slots of the last, partial pass; its last slot is cut so that the target is met to the word
    s = s.withColumn("last", F.expr(f"least((rest + {BLOCK_WORDS - 1}) div {BLOCK_WORDS}, blocks)"))
    s = C.written(s.withColumn("slots", F.expr("passes * blocks + last")), "sources")
    n_sources = s.count()
    key = F.concat(F.when(F.col("source").isNull(), "1").otherwise("0"), F.coalesce("source", F.lit("")))
    by = s.withColumn("_key", key).drop("source")

    # where each document lies in its source's run of words
    placed = C.join_small(rows.filter("size > 0").withColumn("_key", key), by.select("_key", "no", "n_rows"), "_key", n_sources, ["rid"])
    placed = placed.withColumn("bucket", F.expr(f"pmod(h, (n_rows + {BUCKET_ROWS - 1}) div {BUCKET_ROWS})"))
    before = Window.partitionBy("no", "bucket").orderBy("h", "rid").rowsBetween(Window.unboundedPreceding, -1)
    sums = C.running_totals(placed.groupBy("no", "bucket").agg(F.sum("size").alias("words")), "no", "bucket", "words", "base")
    # merge joins at every size: a row per document or slot is no table for the driver, and Spark sizes what is exploded too low
    placed = placed.select("rid", "size", "no", "bucket", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("inside")).join(sums.select("no", "bucket", "base").hint("merge"), ["no", "bucket"])
    start = F.col("base") + F.col("inside")
    pieces = placed.select("rid", "no", "size", start.alias("start")).withColumn("block", F.explode(F.expr(f"sequence(start div {BLOCK_WORDS}, (start + size - 1) div {BLOCK_WORDS})")))
    pieces = pieces.select("rid", "no", "block", "start", F.expr(f"greatest(start - block * {BLOCK_WORDS}, 0L)").alias("x"), F.expr(f"least(start + size - block * {BLOCK_WORDS}, {BLOCK_WORDS}L)").alias("y"))

    # a shard's slots, numbered over it and over the source
    counts = C.written(shard_counts(s.select("no", "slots"), shard_slots, seed), "shards")
    within = Window.partitionBy("shard").orderBy("no", "first")  # at most shard_slots rows
    counts = counts.withColumn("base", F.sum("n").over(within.rowsBetween(Window.unboundedPreceding, -1))).withColumn("size", F.sum("n").over(Window.partitionBy("shard")))
    slots = counts.withColumn("i", F.explode(F.expr("sequence(0L, n - 1)"))).select("shard", "no", "size", (F.coalesce("base", F.lit(0)) + F.col("i")).alias("at"), (F.col("first") + F.col("i")).alias("turn"))
    slots = C.join_small(slots, by.select("no", "full", "blocks", "passes", "rest"), "no", n_sources, ["shard", "at"])
    block = F.arrow_udf(_to_blocks, T.LongType())(F.lit(seed), "no", "turn", "full", "blocks")
    slot = F.arrow_udf(_shuffled, T.LongType())(F.lit(seed), "at", "size", "shard")
    cut = F.expr(f"if(turn div blocks = passes, least(rest - (turn % blocks) * {BLOCK_WORDS}, {BLOCK_WORDS}L), {BLOCK_WORDS}L)")
    slots = slots.select("shard", slot.alias("slot"), "no", block.alias("block"), F.expr("turn div blocks").alias("pass"), cut.alias("words"))

    taken = pieces.join(slots.hint("merge"), ["no", "block"]).filter("x < least(y, words)")
    offset = F.expr(f"block * {BLOCK_WORDS} - start")
    return s, taken.select("rid", "pass", (offset + F.col("x")).alias("a"), (offset + F.least("y", "words")).alias("b"), "shard", "slot", "x")


def sized(docs: DataFrame, key: str, source: str, text: str, keep: bool) -> DataFrame:
    """The written rows that ``plan`` reads; with ``keep`` also the row itself."""
    of = [F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(C.WORD)), F.lit(0)).cast("long").alias("size"), F.xxhash64(key, text).alias("h")]
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if keep else []
    return C.written(docs.select(F.monotonically_increasing_id().alias("rid"), F.col(key).alias("key"), F.col(source).cast("string").alias("source"), *of, *row), "sized")


def mix_report(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", seed: int = SEED) -> DataFrame:
    """Per document: ``key``, ``size`` in words, ``source_size``, its source's
    ``target``, ``taken``, the words that the mix takes, repeats counted, and
    ``blocks``, the shards and slots that they go to.

    A source's taken words are its target rounded to a word, and a document is
    taken three times at most.  Null and empty texts have size 0 and are never
    taken; null is a source of its own, after all others.  Rows with equal
    keys and texts are each laid out; which of them a partial pass takes is
    open, as they can't be told apart.  The same input gives the same mix.
    """
    rows = sized(docs, key, source, text, False)
    s, taken = plan(rows, seed=seed)
    words = taken.groupBy("rid").agg(F.sum(F.col("b") - F.col("a")).alias("taken"), F.count("*").alias("blocks"))
    mark = F.concat(F.when(F.col("source").isNull(), "1").otherwise("0"), F.coalesce("source", F.lit("")))
    out = C.join_small(rows.withColumn("_key", mark), s.select(mark.alias("_key"), "source_size", "target"), "_key", s.count(), ["rid"], "left")
    amounts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("taken", "blocks")]
    return out.join(words, "rid", "left").select(F.col("key").alias(key), "size", "source_size", "target", *amounts)


def _cut(text: pa.Array, size: pa.Array, ranges: pa.Array) -> pa.Array:
    """The words of each text that its ranges name; the text itself if all."""
    out = []
    for t, n, spans in zip(text.to_pylist(), size.to_pylist(), ranges.to_pylist(), strict=True):
        merged: list[list[int]] = []
        for r in sorted(spans, key=lambda r: r["a"]):
            if merged and merged[-1][1] == r["a"]:
                merged[-1][1] = r["b"]
            else:
                merged.append([r["a"], r["b"]])
        if merged == [[0, n]]:
            out.append(t)
            continue
        view = next(C.texts(pa.array([t])))
        s, e, _ = view.words()
        raw = view.data
        out.append("\n".join(raw[s[a] : e[b - 1]].tobytes().decode() for a, b in merged))
    return pa.array(out, pa.string())


def mixed_documents(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """The mix as documents: a row per document and pass over its source, with
    the columns of ``docs``; the text holds the words that the pass takes, and
    ``length`` (if there is such a column) its characters.  A document that a
    pass takes whole stays as it is; one that no pass takes goes, and so do
    null and empty texts.  Nulls in other columns, repeated rows and columns of
    any name are kept; an empty table gives none.
    """
    rows = sized(docs, key, source, text, True)
    _, taken = plan(rows)
    spans = taken.groupBy("rid", "pass").agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    got = rows.join(spans.hint("merge"), "rid")
    value = F.arrow_udf(_cut, T.StringType())(F.col(f"row.`{text}`").cast("string"), "size", "spans")
    got = got.select("row", value.alias("cut"))
    cols = []
    for c in docs.columns:
        col = F.col(f"row.`{c}`")
        if c == text:
            col = F.col("cut")
        elif c == length:
            col = F.char_length("cut").cast(docs.schema[c].dataType)
        cols.append(col.alias(c))
    return got.select(*cols)


def _parts(text: pa.Array, spans: pa.Array) -> pa.Array:
    """The words of each text's spans, with one blank between them."""
    out = []
    for t, some in zip(text.to_pylist(), spans.to_pylist(), strict=True):
        view = next(C.texts(pa.array([t])))
        s, e, _ = view.words()
        raw = view.data.tobytes()
        out.append([b" ".join([raw[s[i] : e[i]] for i in range(r["a"], r["b"])]).decode() for r in some])
    return pa.array(out, pa.list_(pa.string()))


def mixed_blocks(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """The mix as packed blocks in the order of the shards: ``shard``, ``slot``,
    ``source``, ``n_words``, ``keys`` (of the documents, in order) and ``text``.

    A block has ``BLOCK_WORDS`` words of consecutive documents of one source;
    only a source's last block and the last slot of its mix are shorter.  Null
    and empty texts are in none; null keys and a null source stay null; an
    empty table gives no blocks.
    """
    rows = sized(docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{source}`").alias("source"), F.col(f"`{text}`").cast("string").alias("text")), "key", "source", "text", True)
    _, taken = plan(rows, shard_slots, seed)
    spans = taken.groupBy("rid").agg(F.collect_list(F.struct("a", "b", "x", "shard", "slot")).alias("spans"))
    parts = F.arrow_udf(_parts, T.ArrayType(T.StringType()))(F.col("row.text"), "spans")
    cut = rows.join(spans, "rid").select("key", "source", F.explode(F.arrays_zip("spans", parts.alias("part"))).alias("p"))
    cut = cut.select("key", "source", "p.spans.*", "p.part")
    blocks = cut.groupBy("shard", "slot").agg(F.first("source").alias("source"), F.sum(F.col("b") - F.col("a")).alias("n_words"), F.sort_array(F.collect_list(F.struct("x", "key", "part"))).alias("of"))
    blocks = blocks.select("shard", "slot", "source", "n_words", F.col("of.key").alias("keys"), F.array_join("of.part", " ").alias("text"))
    return blocks.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
