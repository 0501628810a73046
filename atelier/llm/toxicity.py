"""Toxicity by compression distance.

Two zstandard dictionaries are trained from labelled text.  Each begins with
the segments that its class, toxic or ordinary, has more often than the other,
padded to the same length; both end in the same frequent segments of ordinary text, so that
what the classes share compresses to the same length with either.  A window of
words that compresses shorter with the toxic dictionary counts for toxicity.  The lengths saved over a document's
windows are calibrated into a score on the training rows.
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

#: Labelled rows of a class, and bytes of their text, that are trained on at most.
SAMPLE_ROWS, SAMPLE_BYTES = 6000, 6 << 20
#: Bytes of a window, so few that zstandard leaves its literals as they are
#: and lengths differ by matches only; bytes of the shared base and of a
#: class's own segments.
WINDOW_BYTES, BASE_BYTES, OWN_BYTES = 56, 8192, 4096
LEVEL = 12
#: Bytes that a window must save to count.
LEAST_GAIN = 2
#: Bytes of a segment; the places that must hold it, and how significant (as a
#: log-likelihood ratio) and how many times likelier it must be in its class.
SEGMENTS, LEAST_PLACES, LEAST_RATIO, LEAST_TIMES = (5, 6, 8, 10, 12), 10, 40.0, 8.0
#: Bytes in front that tell places apart: copies of one passage are one place.
CONTEXT = 10
TOXIC_AT = 0.7


def split(text: str | None) -> list[bytes]:
    """The words of a text, ASCII capitals folded."""
    return (text or "").encode().lower().split()


def windows(words: list[bytes]) -> list[bytes]:
    """Consecutive words, a space before each, up to WINDOW_BYTES; a longer
    word is a window of its own."""
    out, size, some = [], 0, []
    for w in words:
        if some and size + len(w) >= WINDOW_BYTES:
            out.append(b" " + b" ".join(some))
            size, some = 0, []
        some.append(w)
        size += len(w) + 1
    if some:
        out.append(b" " + b" ".join(some))
    return out


def _place_counts(docs: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every n-byte segment, a place of it in the joined text, and its
    number of different places; a segment is of one word, with the space in
    front of it if need be."""
    data = np.frombuffer(b"\n".join(docs) + b"\n", np.uint8)
    sums = C.Text(data, np.array([0, len(data)])).sums(C.BYTE_CODE)
    gaps = np.zeros(len(data) + 1, np.int32)
    np.cumsum((data == 32) | (data == 10), out=gaps[1:])
    at = np.arange(max(len(data) - n + 1, 0), dtype=np.int32)
    at = at[(gaps[at + n] - gaps[at + 1] == 0) & (data[at] != 10)]
    del gaps
    _, place = np.unique(C.Text.hashes(sums, np.maximum(at - CONTEXT, 0), at + n), return_index=True)
    at = at[place]
    del place
    h, first, count = np.unique(C.Text.hashes(sums, at, at + n), return_index=True, return_counts=True)
    return h, at[first], count, data


def own_segments(mine: list[bytes], other: list[bytes]) -> list[bytes]:
    """Segments that are significantly more frequent in ``mine``, by the
    number of bytes that they explain; none is part of one before it."""
    found = []
    for n in SEGMENTS:
        h, at, a, data = _place_counts(mine, n)
        g, _, b, there = _place_counts(other, n)
        k = np.minimum(np.searchsorted(g, h), max(len(g) - 1, 0))
        b = np.where(g[k] == h, b[k], 0) if len(g) else np.zeros(len(h), int)
        share = len(data) / (len(data) + len(there))
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = 2 * (a * np.log(a / ((a + b) * share)) + np.where(b > 0, b * np.log(b / ((a + b) * (1 - share))), 0))
        for i in np.flatnonzero((a >= LEAST_PLACES) & (ratio >= LEAST_RATIO) & (a / share >= LEAST_TIMES * (b + 1) / (1 - share))):
            found.append((int(a[i]) * (n - 2), data[at[i] : at[i] + n].tobytes()))
    chosen: list[bytes] = []
    for _, segment in sorted(found, key=lambda x: (-x[0], x[1])):
        if not any(segment in c for c in chosen):
            chosen.append(segment)
    return chosen


def _frequent(docs: list[bytes], most: int) -> bytes:
    """The segments of eight bytes with most places, the likeliest last."""
    _, at, count, data = _place_counts(docs, 8)
    best = np.argsort(-count, kind="stable")[: most // 8]
    return b"".join(data[i : i + 8].tobytes() for i in at[best[::-1]])


@dataclass
class Model:
    toxic: bytes
    ordinary: bytes
    weights: np.ndarray
    bias: float

    def compressors(self):
        import zstandard as z

        def one(content: bytes):
            d = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
            p = z.ZstdCompressionParameters.from_level(LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
            return z.ZstdCompressor(dict_data=d, compression_params=p).compress

        # a window is compressed behind the end of the base, one match for both: zstandard leaves short input
        # as it is unless enough of it compresses
        end, toxic, ordinary = self.toxic[-64:], one(self.toxic), one(self.ordinary)
        return (lambda w: toxic(end + w)), (lambda w: ordinary(end + w))

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ self.weights + self.bias, -50, 50)))


def features(pair, texts: list[str | None]) -> np.ndarray:
    """Per text, from the windows that save LEAST_GAIN bytes with the toxic
    dictionary: bytes saved, most bytes, windows, their share, and the length."""
    toxic, ordinary = pair
    out = np.zeros((len(texts), 5))
    for i, t in enumerate(texts):
        w = windows(split(t))
        if w:
            saved = np.array([len(ordinary(x)) - len(toxic(x)) for x in w])
            gain = saved[saved >= LEAST_GAIN]
            out[i] = np.log1p(gain.sum()), min(gain.max(initial=0), 10) / 5, np.log1p(len(gain)), np.sqrt(len(gain) / len(w)), np.log1p(len(w)) / 5
    return out


def calibrate(x: np.ndarray, y: np.ndarray, steps: int = 50, ridge: float = 1e-2) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton's method."""
    one = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(one.shape[1])
    penalty = np.eye(len(w)) * ridge
    penalty[-1, -1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(one @ w, -50, 50)))
        gradient = one.T @ (p - y) + penalty @ w
        step = np.linalg.solve((one * (p * (1 - p))[:, None]).T @ one + penalty, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def train(texts: list[str], toxic: list[int], odds: float) -> Model:
    """A model of labelled texts; ``odds``: of toxic to ordinary rows among
    all that are labelled, to which the bias is set.  The segments come from
    one half of the texts, the calibration from the other, on which the
    segments aren't overfitted."""
    y = np.array(toxic)
    half = np.arange(len(texts)) % 2 == 0
    docs = [b" " + b" ".join(split(t)) for t in texts]

    def dictionaries(use: np.ndarray) -> Model:
        bad, good = ([docs[i] for i in np.flatnonzero(use & (y == k))] for k in (1, 0))
        own = [b"".join(own_segments(*pair)[::-1])[-OWN_BYTES:].rjust(OWN_BYTES, b"\0") for pair in ((bad, good), (good, bad))]
        base = _frequent(good, BASE_BYTES)
        return Model(own[0] + base, own[1] + base, np.zeros(5), 0.0)

    if len(set(toxic)) < 2:
        return Model(b" ", b" ", np.zeros(5), float(np.log(np.clip(odds, 1e-3, 1e3))))
    trial = dictionaries(half)
    rest = np.flatnonzero(~half)
    weights, bias = calibrate(features(trial.compressors(), [texts[i] for i in rest]), y[rest])
    model = dictionaries(np.ones(len(texts), bool))
    n1, n0 = (int((y[rest] == k).sum()) for k in (1, 0))
    model.weights, model.bias = weights, bias + float(np.log(odds) - np.log(max(n1, 1) / max(n0, 1)))
    return model


def training_rows(labelled: DataFrame, key: str, text: str, label: str) -> tuple[list[str], list[int]]:
    """Different texts of each class, at most SAMPLE_ROWS rows and SAMPLE_BYTES
    bytes, by the order of their key's hash."""
    texts: dict[str, int] = {}
    for k in (0, 1):
        rows = labelled.filter(F.col(label) == k).select(F.col(text).cast("string").alias("t"), F.xxhash64(key).alias("h"), F.xxhash64(text).alias("g"))
        size = 0
        for r in rows.filter("t is not null").orderBy("h", "g").limit(SAMPLE_ROWS).toLocalIterator():
            n = len(r[0].encode())
            if size + n <= SAMPLE_BYTES:  # a text that is too long is left out, not those after it
                size += n
                texts.setdefault(r[0], k)
    names = list(texts)
    order = np.random.Generator(np.random.PCG64(1)).permutation(len(names))
    return [names[i] for i in order], [texts[names[i]] for i in order]


def toxicity_score(model: Model, text: Column) -> Column:
    """The model's score of each whole text, from 0 to 1; null and empty texts
    get that of a text without windows."""
    name = uuid.uuid4().hex

    @F.arrow_udf(T.DoubleType())
    def score(column: pa.Array) -> pa.Array:
        return pa.array(model.score(features(C.kept(name, model.compressors), column.to_pylist())))

    return score(text.cast("string"))


def classify_toxicity(
    docs: DataFrame, labelled: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", out: str = "toxicity", counts: dict[int, int] | None = None
) -> DataFrame:
    """``docs`` with a column ``out``: the score of a model trained on the
    rows of ``labelled`` (``key``, ``text``, ``label`` 0 or 1; others don't
    count).  ``counts``: of each label, if ``labelled`` is a sample of them.

    Every row stays; a column named ``out`` is replaced.  Without rows of both
    classes every score is the share of toxic rows, nearly.  Only texts are
    read for scores, so repeated texts score equally.
    """
    if counts is None:
        counts = {r[0]: r[1] for r in labelled.filter(F.col(label).isin(0, 1)).groupBy(F.col(label).cast("int")).count().collect()}
    model = train(*training_rows(labelled, key, text, label), counts.get(1, 0) / max(counts.get(0, 0), 1))
    return C.with_struct(docs, out, toxicity_score(model, F.col(text)))
