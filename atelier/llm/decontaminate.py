"""Benchmark decontamination by q-gram lemma filtering.

Benchmark items are cut into probes: whole, and as short parts that overlap,
so that a beginning, middle or end is found too.  An occurrence of a probe of
length m with at most k edits shares at least m - q + 1 - kq character q-grams
with it, all within k + 1 neighbouring diagonals.  So the q-grams that a document
shares with a probe are counted in overlapping diagonal bands, bands that
reach the bound are kept, and a banded alignment confirms them.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from atelier.llm import common as C

#: Characters of a q-gram; edits per character of a probe; bytes of a probe at
#: most, and of an item at least (a shorter one names no leak).
Q, EDITS, PROBE, LEAST = 8, 0.1, 256, 24
#: Bytes of a part: a third of its item, within these bounds.  A short item's
#: parts have four fifths of it at most.
PARTS = 48, 96
#: Half the widths of diagonal bands: a probe has the least that is no less
#: than its edits.
HALVES = np.array([8, 16, 32])
#: Bytes of normalised benchmark text that go to the executors at once.
BLOCK_BYTES = 4 << 20
_GAP = 64  # zero bytes between documents: more than any budget of edits
_U = np.uint64

HITS = T.ArrayType(
    T.StructType(
        [T.StructField("item", T.LongType()), T.StructField("item_start", T.IntegerType()), T.StructField("length", T.IntegerType())]
        + [T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("edits", T.IntegerType()), T.StructField("probes", T.IntegerType())]
    )
)

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[i for i in range(128) if not chr(i).isalnum()]] = 32


def _folded(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case bytes with each run of other ASCII than letters and digits
    as one space, and where each came from."""
    b = _FOLD[data]
    capital = (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97) & (data[:-1] == 0xC3)
    b[1:][capital] += 32  # Latin-1 capitals
    keep = b != 32
    keep[1:] |= b[:-1] != 32
    at = np.flatnonzero(keep)
    return b[at], at


def _grams(b: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one integer."""
    g = b.astype(_U)
    for n in (1, 2, 4):
        g = g[:-n] | (g[n:] << _U(8 * n))
    return g


def _spans(n: int) -> list[tuple[int, int]]:
    """The probes of an item of ``n`` bytes.  Pieces of at most PROBE bytes
    tile it.  Parts lie half a part apart, or a quarter in an item too short
    for a third of it to be a part: a stretch of half the item, of 60 bytes
    at least and never over 144, holds one whole, and so does each end."""
    cuts = np.linspace(0, n, -(-n // PROBE) + 1).astype(int).tolist()
    part = max(LEAST, min(max(n // 3, PARTS[0]), PARTS[1], 4 * n // 5))
    step = part // 2 if n >= 3 * PARTS[0] else part // 4
    starts = [*range(0, n - part, step), n - part]
    return list(dict.fromkeys([*zip(cuts[:-1], cuts[1:], strict=True), *((a, a + part) for a in starts)]))


class _Index:
    """The q-grams of a block of items."""

    def __init__(self, items: list[tuple[int | None, str]]):
        self.item, self.at, self.owner, probes, whole = [], [], [], [], []
        for item, text in items:
            b = _folded(np.frombuffer(text.encode(), np.uint8))[0]
            b = np.frombuffer(b.tobytes().strip(), np.uint8)
            if len(b) < LEAST:
                continue
            for s, e in _spans(len(b)):
                self.item.append(item)
                self.at.append(s)
                self.owner.append(len(whole))
                probes.append(b[s:e])
            whole.append(b)
        self.n = len(probes)
        self.length = np.array([len(p) for p in probes], np.int64)
        self.budget = np.minimum((self.length * EDITS).astype(np.int64), np.maximum((self.length - Q) // Q, 0))
        self.least = self.length - Q + 1 - self.budget * Q
        self.half = HALVES[np.searchsorted(HALVES, self.budget)]
        self.text = np.zeros((self.n, PROBE), np.uint8)
        for i, p in enumerate(probes):
            self.text[i, : len(p)] = p
        # the q-grams of whole items, and the probes that hold each
        gram = np.concatenate([_grams(b) for b in whole] or [np.zeros(0, _U)])
        sizes = np.array([len(b) - Q + 1 for b in whole], np.int64)
        base = np.cumsum(sizes) - sizes
        self.of = np.repeat(np.arange(len(whole), dtype=np.int32), sizes)
        self.place = (np.arange(len(gram)) - np.repeat(base, sizes)).astype(np.int32)
        self.start = np.array(self.at, np.int64)
        grams = np.maximum(self.length - Q + 1, 0)
        held = np.repeat(base[self.owner] + self.start - (np.cumsum(grams) - grams), grams) + np.arange(grams.sum()) if self.n else np.zeros(0, np.int64)
        self.holder = np.repeat(np.arange(self.n, dtype=np.int32), grams)[np.argsort(held, kind="stable")]
        self.holders = np.bincount(held, minlength=len(gram))
        self.holder_first = np.cumsum(self.holders) - self.holders
        self.item_least = np.full(len(whole), PROBE, np.int64)
        np.minimum.at(self.item_least, np.array(self.owner, np.int64), self.least)
        order = np.argsort(gram, kind="stable")
        self.entry = order.astype(np.int32)
        self.gram, self.first, self.many = np.unique(gram[order], return_index=True, return_counts=True)
        self.bits = max(16, int(np.ceil(np.log2(max(len(self.gram), 1)))) + 5)
        self.seen = np.zeros(1 << self.bits, bool)
        self.seen[self._slot(self.gram)] = True

    def _slot(self, g: np.ndarray) -> np.ndarray:
        return (g * _U(0x9E3779B97F4A7C15)) >> _U(64 - self.bits)

    def _near(self, entry: np.ndarray, where: np.ndarray) -> np.ndarray:
        """Which shared q-grams may be in a band of a probe that reaches its
        bound: a band lies in three of the item's widest half bands.  They
        are counted in a table where different ones may meet, which only adds."""
        of = self.of[entry]
        bits = max(10, int(len(entry)).bit_length() + 2)
        slot = of * np.int64(0x9E3779B1) + (where - self.place[entry]) // HALVES[-1] & (1 << bits) - 1
        count = np.bincount(slot, minlength=1 << bits)
        three = count + np.roll(count, 1) + np.roll(count, -1)
        most = np.maximum(three, np.maximum(np.roll(three, 1), np.roll(three, -1)))
        return most[slot] >= self.item_least[of]

    def bands(self, stream: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probe and lower half band of every band that reaches its bound."""
        g = _grams(stream)
        where = np.flatnonzero(self.seen[self._slot(g)])
        k = np.minimum(np.searchsorted(self.gram, g[where]), len(self.gram) - 1)
        real = self.gram[k] == g[where]
        where, k = where[real], k[real]
        many = self.many[k]
        entry = self.entry[np.repeat(self.first[k] - (np.cumsum(many) - many), many) + np.arange(many.sum())]
        where = np.repeat(where, many)
        near = self._near(entry, where)
        entry, where = entry[near], where[near]
        many = self.holders[entry]
        probe = self.holder[np.repeat(self.holder_first[entry] - (np.cumsum(many) - many), many) + np.arange(many.sum())].astype(np.int64)
        diagonal = np.repeat(where - self.place[entry], many) + self.start[probe]
        real = diagonal >= 0  # what occurs starts behind a gap, wider than its edits
        probe, diagonal = probe[real], diagonal[real]
        wide = len(stream) // HALVES[0] + 4
        key, count = np.unique(probe * wide + diagonal // self.half[probe] + 1, return_counts=True)
        # the q-grams of two neighbouring halves
        after = np.zeros(len(key), np.int64)
        after[:-1] = np.where(key[1:] == key[:-1] + 1, count[1:], 0)
        before = np.zeros(len(key), np.int64)
        before[1:] = np.where(key[:-1] == key[1:] - 1, count[:-1], 0)
        need = self.least[key // wide]
        low = np.concatenate([key[count + after >= need], key[count + before >= need] - 1])
        low = np.unique(low)
        return low // wide, low % wide - 1

    def align(self, stream: np.ndarray, probe: np.ndarray, half: np.ndarray) -> tuple[np.ndarray, ...]:
        """Least edits of each probe within its band, all of one width, with
        start and end in the stream; more than its budget where it was given
        up.  Cost and start share a number, so that the least cost wins and
        among equals the first start."""
        k = int(self.half[probe].max(initial=0))
        width = 4 * k
        one = np.int64(1) << 32
        lo = half * k - k
        pad = 2 * PROBE + width
        padded = np.concatenate([np.zeros(pad, np.uint8), stream, np.zeros(pad, np.uint8)])
        col = np.arange(width)
        begin = (lo[:, None] + col + pad).astype(np.int64)
        d = begin.copy()  # no pattern read: cost 0, start here
        best = np.full(len(probe), np.iinfo(np.int64).max)
        end = np.zeros(len(probe), np.int64)
        live = np.arange(len(probe))
        length = self.length[probe]
        for i in range(int(length.max(initial=0))):
            symbol = padded[begin + i]
            new = d + np.where(symbol == self.text[probe[live], i][:, None], 0, one)
            new[:, :-1] = np.minimum(new[:, :-1], d[:, 1:] + one)
            d = np.minimum.accumulate(new - col * one, axis=1) + col * one
            done = np.flatnonzero(length[live] == i + 1)
            if len(done):
                c = d[done].argmin(1)
                best[live[done]] = d[done, c]
                end[live[done]] = begin[done, c] + i + 1 - pad
            if i % 16 == 15:  # a row's least cost never falls again
                go = (length[live] > i + 1) & ((d.min(1) >> np.int64(32)) <= self.budget[probe[live]])
                live, d, begin = live[go], d[go], begin[go]
                if not len(live):
                    break
        return best >> np.int64(32), (best & (one - 1)) - pad, end

    def search(self, t: C.Text) -> tuple[np.ndarray, ...]:
        """Row, probe, start, end (code points of the row) and edits."""
        b, at = _folded(t.data)
        row = t.rows_of(at)
        new = np.arange(len(b)) + _GAP * (row + 1)
        stream = np.zeros((new[-1] if len(new) else 0) + _GAP * 2, np.uint8)
        stream[new] = b
        probe, half = self.bands(stream)
        got = [[np.zeros(0, np.int64)] * 5]
        groups = [np.flatnonzero(self.half[probe] == k) for k in HALVES]
        for some in (g[i : i + 4096] for g in groups for i in range(0, len(g), 4096)):
            p = probe[some]
            edits, s, e = self.align(stream, p, half[some])
            ok = edits <= self.budget[p]
            p, edits, s, e = p[ok], edits[ok], s[ok], e[ok]
            s, e = np.searchsorted(new, s), np.searchsorted(new, e - 1)
            r = row[np.minimum(e, len(row) - 1)]
            head = np.zeros(len(t.data) + 1, np.int64)
            np.cumsum((t.data & 0xC0) != 0x80, out=head[1:])
            base = head[t.off[r]]
            got.append([r, p, head[at[s]] - base, head[at[e]] + 1 - base, edits])
        r, p, s, e, k = (np.concatenate(x) for x in zip(*got, strict=True))
        order = np.lexsort((s, k, e, p, r))
        r, p, s, e, k = r[order], p[order], s[order], e[order], k[order]
        first = np.ones(len(r), bool)
        first[1:] = (r[1:] != r[:-1]) | (p[1:] != p[:-1]) | (e[1:] != e[:-1])
        return r[first], p[first], s[first], e[first], k[first]

    def stretches(self, r: np.ndarray, p: np.ndarray, s: np.ndarray, e: np.ndarray, k: np.ndarray) -> list[tuple]:
        """Row and hit of every stretch: probes of one item whose places in a
        row overlap.  Its edits are those of probes that don't overlap, the
        first and longest of them."""
        found: list[tuple] = []
        owner, at, length = (np.array(x, np.int64)[p] for x in (self.owner, self.at, self.length))
        for i in np.lexsort((s, owner, r)):
            one = (int(at[i]), -int(length[i]), int(k[i]), int(p[i]))
            if found and found[-1][0] == (r[i], owner[i]) and s[i] < found[-1][2]:
                found[-1][2] = max(found[-1][2], int(e[i]))
                found[-1][3].append(one)
            else:
                found.append([(r[i], owner[i]), int(s[i]), int(e[i]), [one]])
        out = []
        for (row, _), start, end, probes in found:
            probes.sort()
            done = edits = 0
            for a, n, cost, _ in probes:
                if a >= done:
                    done, edits = a - n, edits + cost
            length = max(a - n for a, n, *_ in probes) - probes[0][0]
            out.append((int(row), (self.item[probes[0][3]], probes[0][0], length, start, end, edits, len({x[3] for x in probes}))))
        return out


def _finder(spark, search: str, block: int, items: list[tuple[int | None, str]]) -> Column:
    shared = spark.sparkContext.broadcast(items)

    def run(text: pa.Array) -> list[pa.Array]:
        indexes = C.kept(search, dict)
        if block not in indexes:
            indexes[block] = _Index(shared.value)
        index, counts, hits = indexes[block], [], []
        for t in C.texts(text):
            got = index.stretches(*index.search(t)) if index.n and len(t.data) else []
            counts.append(np.bincount(np.array([r for r, _ in got], np.int64), minlength=t.n))
            hits += [h for _, h in got]
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        fields = [pa.array([h[i] for h in hits], kind) for i, kind in enumerate(kinds)]
        off = np.zeros(len(text) + 1, np.int32)
        np.cumsum(np.concatenate(counts)[: len(text)], out=off[1:])
        return [pa.ListArray.from_arrays(pa.array(off), pa.StructArray.from_arrays(fields, names=[f.name for f in HITS.elementType.fields]))]

    return C.arrow_struct(run, T.StructType([T.StructField("hits", HITS)]), tables=True)


def _blocks(benchmark: DataFrame, item: str, text: str):
    """The items in blocks of at most BLOCK_BYTES of text, one at a time."""
    block, size = [], 0
    for row in benchmark.select(F.col(item).cast("long"), F.col(text).cast("string")).filter(F.col(text).isNotNull()).toLocalIterator():
        n = len(row[1].encode())
        if block and size + n > BLOCK_BYTES:
            yield block
            block, size = [], 0
        block.append((row[0], row[1]))
        size += n
    if block:
        yield block


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", out: str = "hits") -> DataFrame:
    """``docs`` with an array column ``out`` of the stretches of benchmark
    items found: item, where the stretch starts in the normalised item and its
    length, start and end in the document (code points, end exclusive), edits
    (of probes that don't overlap) and how many of the item's probes it holds.

    Every row stays; a column named ``out`` is replaced.  Case, and runs of
    ASCII characters that are neither letters nor digits, don't count.  Null
    and empty texts have no hits, nor has any with an empty benchmark; items
    that are null or under 24 normalised bytes find nothing.  Repeated rows
    have equal hits, repeated items a hit each.  The benchmark goes to the
    executors in blocks of at most 4 MiB, each of which reads all documents; a
    worker keeps the indexes of all blocks of a search.
    """
    found = []
    base, search = docs, uuid.uuid4().hex
    for i, block in enumerate(_blocks(benchmark, item, item_text)):
        name = f"__{out}_{i}"
        docs = docs.withColumn(name, _finder(docs.sparkSession, search, i, block)(F.col(text).cast("string")))
        found.append(F.col(name)["hits"])
    empty = F.array().cast(HITS)
    hits = F.concat(*found) if found else empty
    keep = [c for c in base.columns if c.lower() != out.lower()]
    return docs.select(*[F.col(f"`{c}`") for c in keep], hits.alias(out))
