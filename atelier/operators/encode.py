"""Text -> unit vector.

By default a text's tokens are hashed into signed buckets with built-in
functions only: no Python, no model files.  A sentence model plugs in through
``encoder_factory``: it is built once per task and must have
``encode(list[str]) -> np.ndarray`` of shape (n, dim).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from atelier.functions.vectors import l2_normalize

_TOKEN = re.compile(r"\w+", re.UNICODE)


class HashingEncoder:
    """Lower-cased word tokens, signed xxhash buckets, L2 normalised."""

    def __init__(self, dim: int = 64, seed: int = 0):
        self.dim = dim
        self.seed = seed

    def encode(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dim), dtype=np.float64)
        for i, t in enumerate(texts):
            if not t:
                continue
            for tok in _TOKEN.findall(t.lower()):
                h = xxhash.xxh64_intdigest(tok, seed=self.seed)
                out[i, h % self.dim] += 1.0 if (h >> 63) == 0 else -1.0
        n = np.linalg.norm(out, axis=1, keepdims=True)
        np.divide(out, n, out=out, where=n > 0)
        return out.astype(np.float32)


def hashing_factory(dim: int = 64, seed: int = 0) -> Callable[[], HashingEncoder]:
    return lambda: HashingEncoder(dim, seed)


#: A token of the built-in encoder.
TOKEN = r"[\p{L}\p{N}_]+"


def hash_counts(df: DataFrame, text: str, out: str, dim: int = 64) -> DataFrame:
    """Adds ``out array<double>``: signed counts of the lower-cased tokens in
    ``dim`` buckets, a power of two.  A token's first hexadecimal digits of MD5
    (as many as tell 2 * ``dim`` slots apart), modulo 2 * ``dim``, give its
    bucket and, from ``dim`` on, a minus.  Null and empty texts have zeros."""
    if dim < 1 or dim & (dim - 1):
        raise ValueError("dim is a power of two")
    from pyspark.ml.feature import CountVectorizerModel
    from pyspark.ml.functions import vector_to_array

    tokens = F.regexp_extract_all(F.lower(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))), F.lit(TOKEN), F.lit(0))
    digits = -(-(2 * dim - 1).bit_length() // 4)
    # a fixed vocabulary of digits: the count of each in one pass over the tokens
    names = [f"{i:0{digits}x}" for i in range(16**digits)]
    counter = CountVectorizerModel.from_vocabulary(names, inputCol="_slots", outputCol="_counts")
    counted = counter.transform(df.withColumn("_slots", F.transform(tokens, lambda t: F.substring(F.md5(t), 1, digits)))).withColumn("_both", vector_to_array("_counts"))

    def bucket(j):
        at = [F.get("_both", j + k) for k in range(0, len(names), dim)]
        return sum(at[2::2], at[0]) - sum(at[3::2], at[1])

    signed = F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), bucket)
    return counted.withColumn(out, signed).drop("_slots", "_counts", "_both")


def encode_text(df: DataFrame, text: str, out: str = "embedding", encoder_factory: Callable[[], object] | None = None, dim: int = 64) -> DataFrame:
    """Adds ``out array<float>``: the vector of ``text``, of length 1 or zero.
    Without an ``encoder_factory`` it is made of ``hash_counts``."""
    if encoder_factory is None:
        counted = hash_counts(df, text, "_signed", dim)
        return counted.withColumn(out, l2_normalize("_signed").cast("array<float>")).drop("_signed")

    @pandas_udf("array<float>")
    def _encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoder_factory()
        for s in batches:
            vecs = enc.encode([x if isinstance(x, str) else "" for x in s.tolist()])
            yield pd.Series(list(vecs))

    return df.withColumn(out, _encode(F.col(text)))
