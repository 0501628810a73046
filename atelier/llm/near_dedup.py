"""Near-duplicate documents by HyperMinHash.

A document's distinct word shingles are hashed once; each of 256 buckets keeps
its least hash as a count of leading zeros and ten mantissa bits.  Bands of
these compressed registers give candidates, a collision-corrected estimate of
the Jaccard similarity drops the hopeless ones, and the rest are confirmed on
the full shingle sets.  Links make components.

Documents with equal sets are one node.  First each node of a band bucket is
compared with the bucket's least node only, which joins most of what belongs
together.  Nodes of one bucket that are then still in different components
are compared block by block inside the tasks, which give links between
components, not pairs; pairs within a component can't change it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from atelier.llm import common as C

BUCKETS, MANTISSA = 256, 10
EMPTY = 0xFFFF
#: A pair of similarity 0.8 shares no band with a chance of 1 - (1 - 0.8^6)^48: five in ten million.
BANDS, BAND_ROWS = 48, 6
#: The estimate drops a pair only this many standard errors below the threshold, and only from enough buckets.
SIGMAS, FEW_BUCKETS = 5.0, 64

_U = np.uint64
_TURNS = np.argsort(np.random.Generator(np.random.PCG64(7)).random((BUCKETS, BUCKETS)), axis=1).astype(np.int64)
_BAND = (np.arange(BANDS * BAND_ROWS) % BUCKETS).reshape(BANDS, BAND_ROWS)


def shingles(t: C.Text, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every distinct shingle of ``size`` words, ordered by
    both; A-Z count as a-z.  A row with fewer words has them all as one."""
    s, e, row = t.words()
    w = C.Text.hashes(t.sums(C.LOWER_CODE), s, e)
    n_words = np.bincount(row, minlength=t.n)
    first = np.cumsum(n_words) - n_words
    length = np.minimum(n_words, size)
    at = np.arange(len(w))
    at = at[at - first[row] <= (n_words - length)[row]]
    row, length = row[at], length[row[at]]
    h = length.astype(_U)
    for k in range(size):
        more = length > k
        h[more] = C.mix(h[more] * _U(0x9FB21C651E98DF25) + w[at[more] + k])
    order = np.argsort(h)
    order = order[np.argsort(row[order], kind="stable")]
    row, h = row[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return row[new], h[new]


def registers(n: int, row: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The compressed register of each bucket; the shingles are ordered, so
    the first of a bucket has its least hash."""
    bucket = (h >> _U(56)).astype(np.int64)
    cell = row * BUCKETS + bucket
    first = np.ones(len(cell), bool)
    first[1:] = cell[1:] != cell[:-1]
    v = h[first] << _U(8)
    zeros = 53 - np.frexp((v >> _U(11)).astype(np.float64))[1]
    zeros = np.minimum(zeros, 56).astype(_U)
    tail = (v << (zeros + _U(1))) >> _U(64 - MANTISSA)
    out = np.full(n * BUCKETS, EMPTY, np.uint16)
    out[cell[first]] = ((zeros << _U(MANTISSA)) | tail).astype(np.uint16)
    return out.reshape(n, BUCKETS)


def bands(regs: np.ndarray) -> np.ndarray:
    """One key per band.  An empty bucket borrows from the first filled one in
    an order of its own, the same for all documents."""
    full = regs.copy()
    doc, j = np.nonzero((regs == EMPTY) & (regs != EMPTY).any(1, keepdims=True))
    for turn in range(BUCKETS):
        if not len(doc):
            break
        lent = regs[doc, _TURNS[j, turn]]
        got = lent != EMPTY
        full[doc[got], j[got]] = lent[got]
        doc, j = doc[~got], j[~got]
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=_U), (len(regs), BANDS)).copy()
    for k in range(BAND_ROWS):
        key = C.mix(key * _U(0x9FB21C651E98DF25) + full[:, _BAND[:, k]].astype(_U))
    return key


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimate corrected for registers that agree by chance, and the
    number of buckets it rests on."""
    either = ((a != EMPTY) | (b != EMPTY)).sum(1)
    same = ((a == b) & (a != EMPTY)).sum(1)
    i = np.arange(57)

    def leading(n: np.ndarray) -> np.ndarray:
        below = 1 - (1 - 2.0 ** -i[None, :]) ** (n[:, None] / BUCKETS)
        return below - np.concatenate([below[:, 1:], np.zeros((len(n), 1))], 1)

    chance = (leading(n_a) * leading(n_b)).sum(1) / 2**MANTISSA
    return (same / np.maximum(either, 1) - chance) / (1 - chance), either


def _binary(rows: np.ndarray, null: np.ndarray | None = None) -> pa.Array:
    """Each row's bytes as one binary value."""
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize if len(rows) else 0
    off = np.arange(len(rows) + 1, dtype=np.int64) * width
    a = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(off.tobytes()), pa.py_buffer(rows.tobytes())])
    if null is not None:
        a = pa.compute.if_else(pa.array(~null), a, pa.scalar(None, pa.large_binary()))
    return a.cast(pa.binary())


def _set_ids(n: int, row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128-bit digest of each row's set, and the set's size."""
    size = np.bincount(row, minlength=n)
    out = np.zeros((n, 2), _U)
    some = np.flatnonzero(size)
    if len(some):
        start = (np.cumsum(size) - size)[some]
        for k, salt in enumerate((0x243F6A8885A308D3, 0x13198A2E03707344)):
            out[some, k] = C.mix(np.add.reduceat(C.mix(h ^ _U(salt)), start) + size[some].astype(_U))
    return out, size


SKETCH = T.StructType([T.StructField("n_shingles", T.LongType()), T.StructField("set_id", T.BinaryType()), T.StructField("registers", T.BinaryType())])
SETS = T.StructType([T.StructField("set_id", T.BinaryType()), T.StructField("shingles", T.ArrayType(T.LongType()))])


def _sketch(size: int):
    def run(text: pa.Array) -> list[pa.Array]:
        n, ids, regs = [], [], []
        for t in C.texts(text):
            row, h = shingles(t, size)
            i, k = _set_ids(t.n, row, h)
            n.append(k)
            ids.append(i)
            regs.append(registers(t.n, row, h))
        n = np.concatenate(n).astype(np.int64)
        return [pa.array(n), _binary(np.concatenate(ids), n == 0), _binary(np.concatenate(regs), n == 0)]

    return C.arrow_struct(run, SKETCH)


def _sets(size: int):
    def run(text: pa.Array) -> list[pa.Array]:
        ids, counts, values = [], [], []
        for t in C.texts(text):
            row, h = shingles(t, size)
            i, k = _set_ids(t.n, row, h)
            ids.append(i)
            counts.append(k)
            values.append(h)
        return [_binary(np.concatenate(ids)), C.lists(np.concatenate(values).view(np.int64), np.concatenate(counts), pa.int64())]

    return C.arrow_struct(run, SETS)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), BUCKETS)


def _bands():
    def run(regs: pa.Array) -> list[pa.Array]:
        keys = bands(_matrix(regs))
        return [C.lists(keys.ravel().view(np.int64), np.full(len(keys), BANDS), pa.int64())]

    return C.arrow_struct(run, T.StructType([T.StructField("keys", T.ArrayType(T.LongType()))]))


def _hopeful(threshold: float):
    """Whether the estimate leaves a pair's similarity possible."""

    @F.arrow_udf(T.BooleanType())
    def run(a: pa.Array, b: pa.Array, n_a: pa.Array, n_b: pa.Array) -> pa.Array:
        x, k = estimate(_matrix(a), _matrix(b), n_a.to_numpy().astype(float), n_b.to_numpy().astype(float))
        error = np.sqrt(threshold * (1 - threshold) / np.maximum(k, 1))
        return pa.array((k < FEW_BUCKETS) | (x >= threshold - SIGMAS * error))

    return run


def _met(left: DataFrame, right: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """A merge join, at every size.  All tables here grow with the documents,
    and Spark sizes one too low after an explode (48 bands a node) or from
    Parquet's packed bytes: left to itself it broadcasts them from the driver."""
    return left.join(right.hint("merge"), on, how)


def components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` for the nodes of ``edges (a, b)``; a component is
    named by its least node.

    Each round hooks every node to its least neighbour, shortens the paths to
    their roots by doubling, and keeps the edges between different roots, so
    the rounds grow with the logarithm of the number of nodes.  All state is
    in written tables; hub nodes meet in aggregates with a map side or in
    joins of two plain shuffles, which adaptive execution can split.
    """
    edges = C.written(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        ends = edges.select(F.col("a").alias("id"), F.col("b").alias("other")).union(edges.select("b", "a"))
        parent = C.written(ends.groupBy("id").agg(F.min("other").alias("o")).select("id", F.least("id", "o").alias("root")), "parents")
        while True:
            up = parent.select(F.col("id").alias("root"), F.col("root").alias("up"))
            jumped = C.written(_met(parent, up, "root").select("id", F.col("up").alias("root"), (F.col("up") != F.col("root")).alias("moved")), "parents")
            parent = jumped.select("id", "root")
            if jumped.filter("moved").isEmpty():
                break
        root_of = parent.select(F.col("id").alias("component"), "root")
        if labels is None:
            labels = parent.select("id", F.col("root").alias("component"))
        else:
            labels = C.written(_met(labels, root_of, "component", "left").select("id", F.coalesce("root", "component").alias("component")), "labels")
        edges = _met(edges, parent.select(F.col("id").alias("a"), F.col("root").alias("ra")), "a")
        edges = _met(edges, parent.select(F.col("id").alias("b"), F.col("root").alias("rb")), "b").filter("ra <> rb")
        edges = C.written(edges.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "edges")
    return labels if labels is not None else edges.select(F.col("a").alias("id"), F.col("b").alias("component"))


def overlaps(left: list[np.ndarray], right: list[np.ndarray], columns: int = 20_000) -> np.ndarray:
    """Sizes of the intersections of all sets of a block with all of another,
    as products of 0/1 matrices over the shingles that both blocks hold."""
    total = np.zeros((len(left), len(right)), np.float32)
    flat = [np.concatenate(x) for x in (left, right)]
    row = [np.repeat(np.arange(len(x)), [len(v) for v in x]) for x in (left, right)]
    shared = np.intersect1d(*flat)
    for at in range(0, len(shared), columns):
        part, dense = shared[at : at + columns], []
        for values, of, n in zip(flat, row, (len(left), len(right)), strict=True):
            k = np.minimum(np.searchsorted(part, values), len(part) - 1)
            hit = part[k] == values
            m = np.zeros((n, len(part)), np.float32)
            m[of[hit], k[hit]] = 1
            dense.append(m)
        total += dense[0] @ dense[1].T
    return total


def _linked(percent: int):
    """Pairs of components that a link between two blocks of nodes joins."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(block: pa.Table) -> pa.Table:
        side, component = (block[c].to_numpy() for c in ("side", "component"))
        sets = [np.asarray(v.values) for v in block["shingles"]]
        at = [np.flatnonzero(side == k) for k in (0, 1)]
        left, right = ([sets[i] for i in k] for k in at)
        if not left or not right:
            return schema.empty_table()
        common = overlaps(left, right)
        union = np.array([len(x) for x in left])[:, None] + np.array([len(x) for x in right])[None, :] - common
        a, b = (component[k] for k in at)
        i, j = np.nonzero((100 * common >= percent * union) & (a[:, None] != b[None, :]))
        pairs = np.unique(np.stack([np.minimum(a[i], b[j]), np.maximum(a[i], b[j])], 1), axis=0)
        return pa.table([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=schema)

    return run


#: Nodes of one block, about.  Two blocks meet in a task, never a whole group.
BLOCK = 128


def _blocks(n: str):
    return F.expr(f"greatest(1, ({n} + {BLOCK - 1}) div {BLOCK})")


def _joined(active: DataFrame, member: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` between components, for all nodes that share a band
    bucket but not a component, other than a pair that is a bucket of its own.

    In each such bucket one component has the most nodes.  The nodes outside
    of it are tested with the whole of it, once for all its buckets, and with
    each other.  Tests run in pairs of blocks inside the tasks and give links
    only, not pairs.
    """
    banded = _met(active, member, "nid").select("nid", "component", F.explode(_bands()("registers")["keys"]).alias("bucket"))
    split = banded.groupBy("bucket").agg(F.count("*").alias("n"), F.min("component").alias("x"), F.max("component").alias("y")).filter("n > 2 and x < y")
    apart = C.written(_met(banded, split.select("bucket"), "bucket"), "apart")
    sizes = apart.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    top = C.written(sizes.groupBy("bucket").agg(F.max(F.struct("n", "component")).alias("top")).select("bucket", F.col("top.component").alias("top")), "top")
    outside = C.written(_met(apart, top, "bucket").filter("component <> top"), "outside")

    # outside nodes and the largest component
    satellites = C.written(outside.select(F.col("top").alias("g"), "nid", "component").distinct(), "satellites")
    n_right = satellites.groupBy("g").agg(F.count("*").alias("n_right"))
    counts = C.written(_met(n_right, member.groupBy(F.col("component").alias("g")).agg(F.count("*").alias("n_left")), "g"), "counts")
    counts = counts.select("g", _blocks("n_left").alias("n_left"), _blocks("n_right").alias("n_right"))
    place = lambda n: F.expr(f"pmod(xxhash64(nid), {n})")
    every = lambda n: F.explode(F.expr(f"sequence(0L, {n} - 1)"))
    inner = _met(member.withColumn("g", F.col("component")), counts, "g").select("g", "nid", "component", F.lit(0).alias("side"), place("n_left").alias("i"), every("n_right").alias("j"))
    outer = _met(satellites, counts, "g").select("g", "nid", "component", F.lit(1).alias("side"), every("n_left").alias("i"), place("n_right").alias("j"))

    # outside nodes of one bucket
    several = outside.groupBy("bucket").agg(F.count("*").alias("n"), F.min("component").alias("x"), F.max("component").alias("y")).filter("x < y")
    several = C.written(several.select("bucket", _blocks("n").alias("n")), "several")
    own = _met(outside, several, "bucket").select(F.col("bucket").alias("g"), "nid", "component", place("n").alias("own"), "n")
    first = own.select("g", "nid", "component", F.lit(0).alias("side"), F.col("own").alias("i"), F.explode(F.expr("sequence(own, n - 1)")).alias("j"))
    second = own.select("g", "nid", "component", F.lit(1).alias("side"), F.explode(F.expr("sequence(0L, own)")).alias("i"), F.col("own").alias("j"))

    tests = inner.union(outer).withColumn("kind", F.lit(0)).union(first.union(second).withColumn("kind", F.lit(1)))
    tests = _met(C.written(tests, "tests"), sets, "nid")
    found = tests.groupBy("kind", "g", "i", "j").applyInArrow(_linked(percent), "a long, b long")
    return C.written(found.distinct(), "joined")


def _text_key():
    """128 bits of a text: two texts of one key would lose a node's set."""
    return F.unhex(F.md5("text"))


def near_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """Components of documents whose sets of ``size``-word shingles have a
    Jaccard similarity of ``percent`` / 100 or more.

    One row per document: ``key``, ``n_shingles``, ``component_id`` (the least
    key reachable), ``kept`` (the key is the component's least) and
    ``component_key``, which also tells components of equal keys apart.  Null
    or empty text has no shingles: such a row is a component of its own.  A
    null key is never the least; if a component has no other, all its rows are
    kept.  Rows with equal keys and texts get equal results.  An empty table
    gives an empty result; other columns aren't read.
    """
    docs = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    made = docs.select("key", _text_key().alias("text_key"), _sketch(size)("text").alias("s"))
    sketches = C.written(made.select("key", "text_key", "s.*"), "sketches")
    nodes = (
        sketches.filter("n_shingles > 0")
        .groupBy("set_id")
        .agg(F.min("key").alias("least"), F.first("n_shingles").alias("n_shingles"), F.first("text_key").alias("text_key"), F.first("registers").alias("registers"))
        .withColumn("nid", F.monotonically_increasing_id())
    )
    nodes = C.written(nodes, "nodes")

    # each node of a band bucket with the bucket's least node, the pivot
    banded = nodes.select("nid", F.explode(_bands()("registers")["keys"]).alias("bucket"))
    pivots = banded.groupBy("bucket").agg(F.min("nid").alias("pivot"), F.max("nid").alias("last")).filter("pivot < last").drop("last")
    pairs = C.written(_met(banded, pivots, "bucket").filter("nid <> pivot").select(F.col("pivot").alias("a"), F.col("nid").alias("b")).distinct(), "pairs")

    # the nodes that share a bucket, and their sets, each from one of its documents' texts
    shared = C.written(pairs.select(F.col("a").alias("nid")).union(pairs.select("b")).distinct(), "shared")
    active = C.written(_met(nodes, shared, "nid", "left_semi").select("nid", "set_id", "text_key", "n_shingles", "registers"), "active")
    wanted = active.select("nid", "set_id", "text_key")
    # copies of a text meet map-side first, so that a hot text is no hot task
    texts = _met(docs.groupBy(_text_key().alias("text_key")).agg(F.first("text").alias("text")), wanted, "text_key")
    sets = texts.select("nid", "set_id", _sets(size)("text").alias("made")).filter("made.set_id = set_id")
    sets = C.written(sets.select("nid", "made.shingles"), "sets")

    side = lambda c: active.select(F.col("nid").alias(c), F.col("registers").alias(f"r{c}"), F.col("n_shingles").alias(f"n{c}"))
    near = _met(_met(pairs, side("a"), "a"), side("b"), "b").filter(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")
    near = C.written(near.filter(_hopeful(percent / 100)("ra", "rb", "na", "nb")).select("a", "b"), "candidates")
    left = sets.select(F.col("nid").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("nid").alias("b"), F.col("shingles").alias("sb"))
    both = _met(_met(near, left, "a"), right, "b").select("a", "b", F.size(F.array_intersect("sa", "sb")).cast("long").alias("i"), F.size("sa").alias("na"), F.size("sb").alias("nb"))
    links = C.written(both.filter(f"100 * i >= {percent} * (na + nb - i)").select("a", "b"), "links")

    # components by these links, then the links that are left between them
    found = components(links).withColumnRenamed("id", "nid")
    member = C.written(_met(active.select("nid"), found, "nid", "left").select("nid", F.coalesce("component", "nid").alias("component")), "members")
    merged = components(_joined(active.select("nid", "registers"), member, sets, percent)).select(F.col("id").alias("component"), F.col("component").alias("root"))
    member = _met(member, merged, "component", "left").select("nid", F.coalesce("root", "component").alias("component"))

    named = _met(nodes.select("set_id", "nid", "least"), member, "nid", "left").select("set_id", "least", F.coalesce("component", "nid").alias("component"))
    named = C.written(named, "named")
    least = C.written(named.groupBy("component").agg(F.min("least").alias("component_id")), "least")
    out = _met(sketches.select("key", "n_shingles", "set_id"), _met(named.select("set_id", "component"), least, "component"), "set_id", "left")
    single = F.col("set_id").isNull()
    least_key = F.when(single, F.col("key")).otherwise(F.col("component_id"))
    return out.select(
        F.col("key").alias(key),
        "n_shingles",
        least_key.alias("component_id"),
        F.col("key").eqNullSafe(least_key).alias("kept"),
        F.col("component").alias("component_key"),
    )


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component of ``near_dedup``, with all its columns: the
    one of the least key, null last; among equal keys any.  Rows without words
    all stay."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = C.written(docs.select(F.monotonically_increasing_id().alias("rid"), row.alias("row")), "rows")
    of = F.col(f"row.`{key}`")
    named = rows.select(F.struct(of.isNull().alias("none"), of.alias("id"), "rid").alias("key"), F.col(f"row.`{text}`").alias("text"))
    path = C.shared_dir(docs.sparkSession, "kept")
    with C.short_lived(docs.sparkSession, "near_dedup"):
        kept = C.written(near_dedup(named, "key", "text", size, percent).filter("kept").select("key.rid"), "kept", path)
    return _met(rows, kept, "rid", "left_semi").select("row.*")
