"""Quality grades by ordinal cumulative-link regression.

A text's words, byte trigrams and repetition are hashed into one vector of
features.  One weight vector, shared by all grades, gives a document's place
on a scale; ordered thresholds cut the scale into grades, so that the model
gives the probability of every grade, the expected grade, and the tail
probability by which documents are selected.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from atelier.llm import common as C

#: Labelled rows of a grade, and bytes of their text, that are trained on at most.
SAMPLE_ROWS, SAMPLE_BYTES = 1500, 5 << 20
#: Buckets of byte trigrams and of words, and one per step of the measures.
TRIGRAMS, WORDS, STEPS, MEASURES = 2048, 2048, 12, 4
SIZE = TRIGRAMS + WORDS + STEPS * MEASURES
ROUNDS, RATE, RIDGE = 300, 0.05, 2e-4
#: A document is selected if its grade reaches GRADE with this probability.
GRADE, SELECT_AT = 1, 0.5

SCORED = T.StructType([T.StructField("expected", T.DoubleType()), T.StructField("tail", T.DoubleType()), T.StructField("grade", T.IntegerType())])


def _steps(share: np.ndarray) -> np.ndarray:
    return np.minimum((share * STEPS).astype(np.int64), STEPS - 1)


def _vectors(t: C.Text) -> np.ndarray:
    n, d = t.n, t.data
    out = np.zeros((n, SIZE), np.float32)
    # byte trigrams within a row
    g = d.astype(np.uint32)
    tri = (g[:-2] | (g[1:-1] << 8) | (g[2:] << 16)).astype(np.uint64)
    row = np.repeat(np.arange(n), np.diff(t.off))
    same = row[:-2] == row[2:]
    bucket = ((tri * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 11)).astype(np.int64)
    out[:, :TRIGRAMS] = np.bincount((row[:-2] * TRIGRAMS + bucket)[same], minlength=n * TRIGRAMS).reshape(n, TRIGRAMS)
    s, e, row = t.words()
    h = C.Text.hashes(t.sums(C.LOWER_CODE), s, e)
    out[:, TRIGRAMS : TRIGRAMS + WORDS] = np.bincount(row * WORDS + (h >> np.uint64(64 - 11)).astype(np.int64), minlength=n * WORDS).reshape(n, WORDS)
    for a, b in ((0, TRIGRAMS), (TRIGRAMS, TRIGRAMS + WORDS)):
        out[:, a:b] = np.sqrt(out[:, a:b] / np.maximum(out[:, a:b].sum(1, keepdims=True), 1))
    # length, repeated pairs of words, repeated lines, share of the most frequent word
    words = np.bincount(row, minlength=n)
    salt = np.uint64(0x9E3779B97F4A7C15)

    def distinct(key: np.ndarray, of: np.ndarray) -> np.ndarray:
        first = np.unique(C.mix(key + of.astype(np.uint64) * salt), return_index=True)[1]
        return np.bincount(of[first], minlength=n)

    inside = np.flatnonzero(row[1:] == row[:-1])
    pairs = np.bincount(row[inside], minlength=n)
    pair_kinds = distinct(C.mix(h[inside]) + h[inside + 1], row[inside])
    cut = np.flatnonzero(d == 10)
    starts = np.unique(np.concatenate([t.off[:-1][np.diff(t.off) > 0], cut + 1]))
    starts = starts[starts < len(d)]
    ends = np.concatenate([starts[1:], [len(d)]]) if len(starts) else starts
    line_row = t.rows_of(starts)
    ends = np.minimum(ends, t.off[line_row + 1])
    line_kinds = distinct(C.Text.hashes(t.sums(C.BYTE_CODE), starts, ends), line_row)
    lines = np.bincount(line_row, minlength=n)
    measures = (
        np.minimum(np.log2(np.maximum(words, 1)) / STEPS, 0.99),
        1 - pair_kinds / np.maximum(pairs, 1) * (pairs > 0) - (pairs == 0),
        1 - line_kinds / np.maximum(lines, 1) * (lines > 0) - (lines == 0),
        distinct(h, row) / np.maximum(words, 1) * 0.99,
    )
    for k, m in enumerate(measures):
        out[np.arange(n), TRIGRAMS + WORDS + k * STEPS + _steps(np.clip(m, 0, 0.999))] = 0.5
    return out


def vectors(text: pa.Array):
    for t in C.texts(text, 256 << 10):
        for i in range(0, t.n, 256):  # rows of one matrix
            j = min(i + 256, t.n)
            yield _vectors(C.Text(t.data[t.off[i] : t.off[j]], t.off[i : j + 1] - t.off[i]))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Model:
    weights: np.ndarray
    cuts: np.ndarray  # ascending: the log-odds of reaching grade k is the place less cuts[k - 1]

    def reach(self, x: np.ndarray) -> np.ndarray:
        """Probability of grade k or more, for k = 1, 2, ..."""
        return _sigmoid((x @ self.weights).astype(np.float64)[:, None] - self.cuts[None, :])


def train(x: np.ndarray, grade: np.ndarray, share: np.ndarray) -> Model:
    """Maximum likelihood by Adam.  Rows weigh so that each grade has its
    ``share`` of all labelled rows, however many of it were sampled."""
    grades = len(share)
    sampled = np.bincount(grade, minlength=grades) / max(len(grade), 1)
    weight = (share / np.maximum(sampled, 1e-9))[grade]
    weight /= weight.sum()
    above = np.clip(1 - np.cumsum(share)[:-1], 1e-3, 1 - 1e-3)
    start = np.maximum.accumulate(-np.log(above / (1 - above)))
    # the first cut, and the logarithms of the gaps between cuts
    p = np.concatenate([np.zeros(x.shape[1]), start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    m, v = np.zeros_like(p), np.zeros_like(p)
    k = x.shape[1]
    row = np.arange(len(grade))
    for step in range(1, ROUNDS + 1):
        gaps = np.exp(np.clip(p[k + 1 :], -10, 10))
        cuts = p[k] + np.concatenate([[0], np.cumsum(gaps)])
        q = _sigmoid((x @ p[:k].astype(np.float32)).astype(np.float64)[:, None] - cuts[None, :])
        full = np.concatenate([np.ones((len(q), 1)), q, np.zeros((len(q), 1))], 1)
        hit = np.maximum(full[row, grade] - full[row, grade + 1], 1e-9)
        slope = full * (1 - full)
        upper, lower = slope[row, grade], slope[row, grade + 1]
        by_place = -weight * (upper - lower) / hit
        by_cut = np.zeros((len(q), len(cuts) + 2))
        by_cut[row, grade] += weight * upper / hit
        by_cut[row, grade + 1] -= weight * lower / hit
        by_cut = by_cut[:, 1:-1].sum(0)
        g = np.concatenate([x.T @ by_place.astype(np.float32) + RIDGE * p[:k], [by_cut.sum()], np.cumsum(by_cut[::-1])[::-1][1:] * gaps])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Model(p[:k].astype(np.float32), p[k] + np.concatenate([[0], np.cumsum(np.exp(np.clip(p[k + 1 :], -10, 10)))]))


def fit(rated: DataFrame, key: str, text: str, rating: str, grades: int, counts: dict[int, int] | None = None) -> Model:
    """A model of rated texts (ratings 0 ... ``grades`` - 1; others don't
    count), from at most SAMPLE_ROWS rows and SAMPLE_BYTES bytes of each grade
    by the order of their key's hash.  ``counts``: of each rating, if
    ``rated`` is a sample of them.  Without two different ratings all get the
    grade there is."""
    rated = rated.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"), F.col(rating).cast("int").alias("r")).filter(f"t is not null and r between 0 and {grades - 1}")
    counts = counts or {r[0]: r[1] for r in rated.groupBy("r").count().collect()}
    if len(counts) < 2:
        only = next(iter(counts), 0)
        return Model(np.zeros(SIZE, np.float32), np.where(np.arange(1, grades) <= only, -10.0, 10.0))
    texts, labels = [], []
    for r in sorted(counts):
        size = 0
        for row in rated.filter(F.col("r") == r).select("t", F.xxhash64("k").alias("h"), F.xxhash64("t").alias("g")).orderBy("h", "g").limit(SAMPLE_ROWS).toLocalIterator():
            n = len(row[0].encode())
            if size + n <= SAMPLE_BYTES:  # a text that is too long is left out, not those after it
                size += n
                texts.append(row[0])
                labels.append(r)
    x = np.concatenate(list(vectors(pa.array(texts, pa.string()))))
    share = np.array([counts.get(k, 0) for k in range(grades)], float)
    return train(x, np.array(labels), share / share.sum())


def grade_quality(docs: DataFrame, rated: DataFrame, key: str = "doc_id", text: str = "text", rating: str = "rating", grades: int = 3, out: str = "quality", counts: dict[int, int] | None = None) -> DataFrame:
    """``docs`` with a struct column ``out``: the ``expected`` grade, the
    ``tail`` probability of grade GRADE or more, the likeliest ``grade`` and
    ``selected``.

    Every row stays; a column named ``out`` is replaced.  Only texts are read
    for grades, so repeated texts have equal ones; null and empty texts have
    those of a text without words.
    """
    model, name = docs.sparkSession.sparkContext.broadcast(fit(rated, key, text, rating, grades, counts)), uuid.uuid4().hex

    def run(column: pa.Array) -> list[pa.Array]:
        fitted = C.kept(name, lambda: model.value)
        q = np.concatenate([fitted.reach(x) for x in vectors(column)] or [np.zeros((0, grades - 1))])
        full = np.concatenate([np.ones((len(q), 1)), q, np.zeros((len(q), 1))], 1)
        return [pa.array(q.sum(1)), pa.array(q[:, GRADE - 1]), pa.array((full[:, :-1] - full[:, 1:]).argmax(1).astype(np.int32))]

    value: Column = C.arrow_struct(run, SCORED, tables=True)(F.col(text).cast("string"))
    return C.with_struct(docs, out, value).withColumn(out, F.col(out).withField("selected", F.col(f"{out}.tail") >= SELECT_AT))
