"""Quality rules by distribution divergence.

A document's character-class histogram and common-word histogram are compared
with references of its language by the Jensen-Shannon distance.  The
references are summed over all documents that pass the base rules; lengths
below a guard are not compared, as a short histogram is mostly noise.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from atelier.llm import common as C

#: Frequent function words of each reference language.
COMMON_WORDS = {
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an er".split(),
    "en": "the of and to in a is that for it as was with be by on not he this are or at from his you".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o".split(),
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il avec".split(),
}
LANGUAGES = tuple(sorted(COMMON_WORDS))
VOCABULARY = sorted({w for ws in COMMON_WORDS.values() for w in ws})

#: Character classes; the class of a character beyond ASCII goes by its first byte.
CLASSES = ("lower", "upper", "digit", "space", "stop", "symbol", "latin", "other")

#: Jensen-Shannon distance (base 2) above which a document is rejected, and
#: the characters or words below which no comparison is made.
MAX_CLASS_DISTANCE, MIN_CHARS = 0.2, 200
MAX_WORD_DISTANCE, MIN_WORDS = 0.3, 100

FIELDS = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [T.StructField("classes", T.ArrayType(T.IntegerType())), T.StructField("common", T.ArrayType(T.IntegerType()))]
)

_CLASS = np.full(256, CLASSES.index("symbol"), np.int64)
_CLASS[0x61:0x7B] = CLASSES.index("lower")
_CLASS[0x41:0x5B] = CLASSES.index("upper")
_CLASS[0x30:0x3A] = CLASSES.index("digit")
_CLASS[C.GAP] = CLASSES.index("space")
_CLASS[[ord(c) for c in ".,;:?'\"-()"]] = CLASSES.index("stop")
_CLASS[0xC3:0xCA] = CLASSES.index("latin")
_CLASS[0xCA:] = CLASSES.index("other")
_HEAD = np.ones(256, bool)
_HEAD[0x80:0xC0] = False  # bytes that continue a character
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "[#*$%&|<>]"[1:-1]]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".,;:!?'\"()"]] = True


def _span_hashes(words: list[str]) -> np.ndarray:
    t = next(C.texts(pa.array(words)))
    return C.Text.hashes(t.sums(C.LOWER_CODE), t.off[:-1], t.off[1:])


def _distinct_per_row(row: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    key = np.unique(C.mix(h + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)[1]
    return np.bincount(row[key], minlength=n)


def _measure_run(t: C.Text, vocabulary: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    n, d = t.n, t.data
    s, e, row = t.words()
    n_words = np.bincount(row, minlength=n)
    head = _HEAD[d]
    word_chars = t.row_sums(head & ~C.GAP[d])
    n_symbols = t.row_sums(_SYMBOL[d])

    # lines with a word; \n and the row's ends bound them
    sums = t.sums(C.BYTE_CODE)
    cut = np.flatnonzero(d == 10)
    ls = np.concatenate([t.off[:-1], cut + 1])
    le = np.concatenate([cut, t.off[1:]])
    lrow = np.concatenate([np.arange(n), t.rows_of(cut)])
    order = np.lexsort((ls, lrow))
    # starts in order within a row pair with ends in order: k breaks give k + 1 lines
    ls, lrow = ls[order], lrow[order]
    le = le[np.lexsort((le, np.concatenate([t.rows_of(cut), np.arange(n)])))]
    full = np.searchsorted(s, le) > np.searchsorted(s, ls)
    lh = C.Text.hashes(sums, ls[full], le[full])
    n_dup = np.bincount(lrow[full], minlength=n) - _distinct_per_row(lrow[full], lh, n)

    # 3-word windows
    h = C.Text.hashes(sums, s, e)
    again = np.zeros(len(h) + 2, bool)
    if len(h) >= 3:
        inside = np.flatnonzero(row[2:] == row[:-2])
        w = C.mix(C.mix(C.mix(h[inside]) + h[inside + 1]) + h[inside + 2] + row[inside].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(w)
        same = w[order][1:] == w[order][:-1]
        twice = np.zeros(len(w), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        hit = inside[twice]
        for k in range(3):
            again[hit + k] = True
    n_repeat = np.bincount(row[again[: len(h)]], minlength=n)

    # histograms
    byte_row = np.repeat(np.arange(n), np.diff(t.off))
    classes = np.bincount((byte_row * len(CLASSES) + _CLASS[d])[head], minlength=n * len(CLASSES)).reshape(n, -1)
    lo = t.sums(C.LOWER_CODE)
    b, c = s.copy(), e.copy()
    for _ in range(3):
        c -= _STOP[d[c - 1]] & (c - b > 1)
        b += _STOP[d[np.minimum(b, len(d) - 1)]] & (c - b > 1)
    wh = C.Text.hashes(lo, b, c)
    k = np.minimum(np.searchsorted(vocabulary, wh), len(vocabulary) - 1)
    known = vocabulary[k] == wh
    size = len(vocabulary) + 1
    bins = np.where(known, at[k], size - 1)
    common = np.bincount(row * size + bins, minlength=n * size).reshape(n, size)
    return [n_words, word_chars, n_symbols, n_dup, n_repeat, classes, common]


def measure(text: pa.Array) -> list[pa.Array]:
    hashes = _span_hashes(VOCABULARY)
    at = np.argsort(hashes)
    got = [_measure_run(t, hashes[at], at) for t in C.texts(text) if t.n]
    if not got:
        return [pa.array([], pa.int64())] * 5 + [pa.array([], pa.list_(pa.int32()))] * 2
    cols = [np.concatenate(x) for x in zip(*got, strict=True)]
    return [pa.array(c) for c in cols[:5]] + [C.lists(c.ravel(), np.full(len(c), c.shape[1]), pa.int32()) for c in cols[5:]]


def base_failed(q: str):
    """Under 50 words, or over half of them in repeated 3-word windows."""
    return (F.col(f"{q}.n_words") < 50) | (100 * F.col(f"{q}.n_repeat_words") > 50 * F.col(f"{q}.n_words"))


def references(measured: DataFrame, lang: str = "lang", q: str = "rules") -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Class and common-word histograms of each reference language, summed
    over all documents that pass the base rules: at most one row per language
    reaches the driver.  A language without documents has no reference."""
    n, m = len(CLASSES), len(VOCABULARY) + 1
    sums = [F.sum(F.col(f"{q}.classes")[i]).alias(f"c{i}") for i in range(n)] + [F.sum(F.col(f"{q}.common")[i]).alias(f"w{i}") for i in range(m)]
    rows = measured.filter(~base_failed(q) & F.col(f"`{lang}`").isin(*LANGUAGES)).groupBy(F.col(f"`{lang}`").alias("_name")).agg(*sums).collect()
    return {r["_name"]: (np.array(r[1 : n + 1], float), np.array(r[n + 1 :], float)) for r in rows}


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Base-2 Jensen-Shannon distance of each row of ``p`` to ``q``, both
    given as counts; 0 for an empty row."""
    p = p / np.maximum(p.sum(1, keepdims=True), 1)
    q = q / max(q.sum(), 1)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        d = np.where(p > 0, p * np.log2(p / m), 0).sum(1) + np.where(q > 0, q * np.log2(q / m), 0).sum(1)
    return np.where(p.sum(1) > 0, np.sqrt(np.maximum(d, 0) / 2), 0)


def _distances(refs: dict[str, tuple[np.ndarray, np.ndarray]], counts: np.ndarray, lang: np.ndarray, which: int) -> np.ndarray:
    """Distance to the document's language, or where that has no reference
    to the nearest of all."""
    if not refs:
        return np.zeros(len(counts))
    by = {k: js_distance(counts, v[which]) for k, v in refs.items()}
    return np.select([lang == k for k in by], list(by.values()), np.min(list(by.values()), axis=0))


def quality_rules(docs: DataFrame, text: str = "text", lang: str = "lang", out: str = "rules") -> DataFrame:
    """``docs`` with a struct column ``out``: the measures, ``base_failed``,
    ``class_distance``, ``word_distance`` (null below the length guard) and
    ``kept``.

    Every row stays, in any order; a column named ``out`` is replaced.  Null
    or empty text has no words and fails the base rules.  A language that is
    null or has no reference is compared with all and takes the nearest.
    Without any reference only the base rules hold.  Repeated rows get equal
    verdicts.  Two passes over the text: one for the references, one for the
    verdicts.
    """
    measured = C.with_struct(docs, out, C.arrow_struct(measure, FIELDS)(F.col(f"`{text}`")))
    refs = references(measured, lang, out)
    fields = T.StructType(
        [f for f in FIELDS.fields if f.name not in ("classes", "common")]
        + [T.StructField("class_distance", T.DoubleType()), T.StructField("word_distance", T.DoubleType())]
    )

    def judge(text: pa.Array, lang: pa.Array) -> list[pa.Array]:
        got = measure(text)
        names = np.array(lang.fill_null("").to_pylist(), object)
        result = got[:5]
        for which, least, column in ((0, MIN_CHARS, got[5]), (1, MIN_WORDS, got[6])):
            counts = column.values.to_numpy().reshape(len(column), -1).astype(float)
            far = _distances(refs, counts, names, which)
            result.append(pa.array(far, mask=counts.sum(1) < least))
        return result

    judged = C.with_struct(docs, out, C.arrow_struct(judge, fields)(F.col(f"`{text}`"), F.col(f"`{lang}`").cast("string")))
    failed = base_failed(out)
    far = (F.coalesce(F.col(f"{out}.class_distance"), F.lit(0.0)) > MAX_CLASS_DISTANCE) | (F.coalesce(F.col(f"{out}.word_distance"), F.lit(0.0)) > MAX_WORD_DISTANCE)
    return judged.withColumn(out, F.col(out).withField("base_failed", failed).withField("kept", ~failed & ~far))
