"""A stored inverted index of vectors: built once, added to, searched by many
runs.

``path/centres`` holds a centre per cell, fitted by k-means on a bounded sample
of the library.  ``path/codes`` holds every vector's cell and its components as
signed bytes, ``path/vectors`` the vectors themselves; both are sorted by cell,
so that a search with few queries skips most of the files' row groups, and both
are committed tables: an addition that is run again adds nothing twice.  A
search compares a query with the codes of its nearest cells, and the best
candidates with their exact vectors.
"""

from __future__ import annotations

import math
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atelier.functions.vectors import dot
from atelier.operators.retrieve import CELLS, _merge_topk, _nearest, _vectors, search_cells
from atelier.session import written
from atelier.sources.committed import read_committed, write_committed

#: Vectors that the centres are fitted on, about; every vector is indexed.
SAMPLE_ROWS = 100_000
#: Cells at most, and the share of the filled cells that a query looks into.
MOST_CELLS, PROBE_SHARE = 4096, 0.15
#: Candidates per result that are compared exactly.
RERANK = 8

_CODES = "cell int, pos bigint, scale float, code binary"
_VECTORS = "cell int, pos bigint, embedding array<float>"


def build_index(library: DataFrame, path: str, pos: str = "pos", vec: str = "embedding", n_cells: int | None = None, seed: int = 7, max_iter: int = 10, key: str = "build") -> int:
    """Fits the centres and indexes every vector of ``library``; returns the
    number of cells, by default the root of the library's size."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    spark, n = library.sparkSession, library.count()
    if not n:
        raise ValueError("an index needs a vector")
    cells = min(n_cells or math.isqrt(n), MOST_CELLS, n)
    share = F.pmod(F.xxhash64(F.col(pos).cast("bigint")), F.lit(1 << 20)) < math.ceil((1 << 20) * min(1.0, SAMPLE_ROWS / n))
    some = library.filter(share).select(array_to_vector(F.col(vec).cast("array<double>")).alias("features"))
    model = KMeans(k=max(cells, 2), seed=seed, maxIter=max_iter).fit(some)
    centres = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    spark.createDataFrame(centres, "cell int, centre array<double>").coalesce(1).write.parquet(f"{path}/centres")
    add_vectors(library, path, key, pos, vec)
    return len(centres)


def _centres(spark: SparkSession, path: str) -> np.ndarray:
    """At most ``MOST_CELLS`` rows."""
    return np.array([r.centre for r in spark.read.parquet(f"{path}/centres").orderBy("cell").collect()])


def _coded(centres, batches):
    """Cell, scale and code of each vector."""
    c = centres.value
    step = max(1, CELLS // len(c))
    for whole in batches:
        for i in range(0, whole.num_rows, step):
            batch = whole.slice(i, step)
            v = _vectors(batch["embedding"], c.shape[1])
            top = np.abs(v).max(1, initial=0) / 127
            code = np.rint(v / np.where(top > 0, top, 1)[:, None]).astype(np.int8)
            columns = [pa.array(_nearest(v, c, 1)[:, 0], pa.int32()), batch["pos"], pa.array(top, pa.float32()), pa.array([r.tobytes() for r in code], pa.binary()), batch["embedding"]]
            yield pa.RecordBatch.from_arrays(columns, names=["cell", "pos", "scale", "code", "embedding"])


def add_vectors(library: DataFrame, path: str, key: str, pos: str = "pos", vec: str = "embedding") -> None:
    """Indexes more vectors by the centres that there are.  ``key`` names the
    addition: run again under the same key it adds nothing."""
    spark = library.sparkSession
    centres = spark.sparkContext.broadcast(_centres(spark, path))
    rows = library.select(F.col(pos).cast("bigint").alias("pos"), F.col(vec).cast("array<float>").alias("embedding"))
    coded = written(rows.mapInArrow(partial(_coded, centres), _CODES + ", embedding array<float>"), "coded")
    sorted_ = coded.repartitionByRange("cell", "pos").sortWithinPartitions("cell", "pos")
    write_committed(sorted_.select("cell", "pos", "scale", "code"), f"{path}/codes", key)
    write_committed(sorted_.select("cell", "pos", "embedding"), f"{path}/vectors", key)


def _decoded(codes: pa.Table, dim: int) -> np.ndarray:
    raw = np.frombuffer(b"".join(codes["code"].to_pylist()), np.int8).reshape(-1, dim)
    return raw * codes["scale"].to_numpy()[:, None].astype(np.float32)


def search_index(queries: DataFrame, path: str, k: int = 1, query_key: str = "qid", query_vec: str = "embedding", nprobe: int | None = None, rerank: int = RERANK) -> DataFrame:
    """``(query_key, rank, pos, sim)``: of each query the k best vectors among
    ``rerank`` * k candidates of its ``nprobe`` nearest cells (by default
    ``PROBE_SHARE`` of those that have vectors, two at least); ``sim`` is exact.

    Queries and codes meet in blocks of cells (see ``search_cells``): a hot
    cell spreads over tasks, and a task's share of either side is bounded.
    """
    spark = queries.sparkSession
    centres = _centres(spark, path)
    codes = read_committed(spark, f"{path}/codes", _CODES)
    filled = {r["cell"]: r["count"] for r in codes.groupBy("cell").count().collect()}  # a row per cell
    kind = dict(queries.dtypes)[query_key]
    if not filled:
        return _merge_topk(spark.createDataFrame([], f"{query_key} {kind}, pos bigint, sim double"), query_key, k).select(query_key, "rank", "pos", "sim")
    probes = min(len(filled), nprobe or max(2, math.ceil(PROBE_SHARE * len(filled))))
    q = queries.select(query_key, F.col(query_vec).cast("array<double>").alias("_qv"))
    stored = codes.select(F.col("cell").alias("_cell"), F.col("pos").alias("_pos"), "scale", "code")
    near = search_cells(q, stored, filled, centres[sorted(filled)], probes, k * rerank, query_key, _decoded)
    chosen = written(_merge_topk(near, query_key, k * rerank).select(query_key, "cell", "pos"), "candidates")
    vectors = read_committed(spark, f"{path}/vectors", _VECTORS).withColumnRenamed("embedding", "_lv")
    exact = chosen.join(vectors, ["cell", "pos"]).join(q, query_key).select(query_key, "pos", dot("_qv", "_lv").alias("sim"))
    return _merge_topk(exact, query_key, k).select(query_key, "rank", "pos", "sim")
