"""Vector retrieval and the joins from a hit to a library file.

``knn_topk`` is exact inner-product top-k.  If either side's vectors take no
more than ``SHIP_BYTES``, they are shipped to the tasks, and the other side is
read where it lies, without a shuffle: with a small library each query finds
its k at once, with few queries each task keeps a bounded best-k table over its
part of the library, and only these are merged.  Otherwise no side is shipped
or exploded into query x library rows, and nothing is collected to the driver:

1. both sides are hashed into blocks of at most ``block_rows`` vectors
   (``qb`` query blocks, ``lb`` library blocks, from two ``count`` jobs);
2. each query row is replicated to the ``lb`` library blocks and each
   library row to the ``qb`` query blocks (a block pair is the group key);
   with a small library ``lb == 1`` and nothing of the query side is
   copied, with few queries ``qb == 1`` and the library is not copied;
3. ``cogroup(...).applyInPandas`` multiplies one query block by one library
   block in numpy (float64) and keeps the k best per query of that pair;
4. the per-pair candidates (k x lb per query) are merged with a top-k window.

Ties are broken by the lowest library position, so results are exact and
deterministic.  ``knn_ann`` looks only into the ``nprobe`` closest k-means
cells of each query (IVF): small cells are put together into blocks, hot ones
are cut, and a query goes once to each block that holds a cell of its.
"""

from __future__ import annotations

import math
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from atelier.constants import RETRIEVAL_K
from atelier.functions.chat import format_manifest_json, manifest_entry
from atelier.functions.text import layer_url
from atelier.operators.agg import _cols, last_by, order_struct, ordered_concat
from atelier.session import written

#: Bytes of vectors (as doubles) that are shipped to every task at most.
SHIP_BYTES = 64 << 20
#: Similarities that a task computes at once; library vectors of one product.
CELLS, TILE = 4 << 20, 4096
#: Vectors of the library's cells, and queries, that a task of a search holds.
LIBRARY_ROWS, QUERY_ROWS = 1 << 16, 1 << 14
#: Row of a result that there isn't.
NOWHERE = np.iinfo(np.int64).max

HIT = "hit"
NO_HIT = "NO_HIT"
MISSING_FILE = "MISSING_FILE"


def _block_topk_fn(k: int, qkey: str, qkey_type):
    def fn(q: pd.DataFrame, lib: pd.DataFrame) -> pd.DataFrame:
        if len(q) == 0 or len(lib) == 0:
            return pd.DataFrame({qkey: pd.Series([], dtype=qkey_type), "pos": pd.Series([], dtype="int64"), "sim": pd.Series([], dtype="float64")})
        qm = np.stack(q["_qv"].to_numpy()).astype(np.float64, copy=False)
        lm = np.stack(lib["_lv"].to_numpy()).astype(np.float64, copy=False)
        pos = lib["_pos"].to_numpy(dtype=np.int64)
        # order: similarity descending, then position ascending
        order_pos = np.argsort(pos, kind="stable")
        pos = pos[order_pos]
        sims = qm @ lm[order_pos].T
        kk = min(k, lm.shape[0])
        keys_out, pos_out, sim_out = [], [], []
        for i in range(sims.shape[0]):
            row = sims[i]
            if kk < row.shape[0]:
                thr = np.partition(row, row.shape[0] - kk)[row.shape[0] - kk]
                cand = np.nonzero(row >= thr)[0]
            else:
                cand = np.arange(row.shape[0])
            best = cand[np.lexsort((pos[cand], -row[cand]))][:kk]
            keys_out.append(np.repeat(q[qkey].iloc[i], len(best)))
            pos_out.append(pos[best])
            sim_out.append(row[best])
        return pd.DataFrame({qkey: np.concatenate(keys_out), "pos": np.concatenate(pos_out), "sim": np.concatenate(sim_out)})

    return fn


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), np.float64).reshape(len(column), dim)


def _best(sims: np.ndarray, pos: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row of ``sims`` the k best, by similarity, then position; ``pos``
    (one or a row for each) is ascending, so that a stable order breaks ties."""
    n = sims.shape[1]
    if n > 4 * k:
        # all that reach the k-th best value: ties at the edge are kept until they are ordered
        edge = np.partition(sims, n - k, axis=1)[:, n - k]
        rows, cols = np.nonzero(sims >= edge[:, None])
        if len(rows) == sims.shape[0] * k:
            cols = cols.reshape(-1, k)
            values = np.take_along_axis(sims, cols, 1)
            order = np.argsort(-values, axis=1, kind="stable")
            cols = np.take_along_axis(cols, order, 1)
            return (np.take_along_axis(pos, cols, 1) if pos.ndim == 2 else pos[cols]), np.take_along_axis(values, order, 1)
    order = np.argsort(-sims, axis=1, kind="stable")[:, :k]
    return (np.take_along_axis(pos, order, 1) if pos.ndim == 2 else pos[order]), np.take_along_axis(sims, order, 1)


def _found(keys: pa.Array, pos: np.ndarray, sims: np.ndarray, qkey: str) -> pa.RecordBatch:
    at = np.repeat(np.arange(len(keys)), pos.shape[1])
    return pa.RecordBatch.from_arrays([keys.take(pa.array(at)), pa.array(pos.ravel()), pa.array(sims.ravel())], names=[qkey, "pos", "sim"])


def _by_query(shipped, k: int, qkey: str, batches):
    """All of a query's k best against the shipped library."""
    pos, library = shipped.value
    step = max(1, CELLS // max(len(pos), 1))
    for batch in batches:
        for i in range(0, batch.num_rows, step):
            part = batch.slice(i, step)
            found = _best(_vectors(part["_qv"], library.shape[1]) @ library.T, pos, k)
            yield _found(part[qkey], *found, qkey)


def _by_library(shipped, k: int, qkey: str, batches):
    """The shipped queries' k best in this part of the library: a table of k
    per query, into which each batch is merged."""
    keys, queries = shipped.value
    sims, pos = np.zeros((len(queries), 0)), np.zeros((len(queries), 0), np.int64)
    step = max(1, CELLS // max(len(queries), 1))
    for batch in batches:
        for i in range(0, batch.num_rows, step):
            part = batch.slice(i, step)
            mine = part["_pos"].to_numpy(zero_copy_only=False)
            order = np.argsort(mine, kind="stable")
            new_pos, new = _best(queries @ _vectors(part["_lv"], queries.shape[1])[order].T, mine[order], k)
            both_pos, both = np.concatenate([pos, new_pos], 1), np.concatenate([sims, new], 1)
            by = np.lexsort((both_pos, -both), axis=1)[:, :k]
            pos, sims = np.take_along_axis(both_pos, by, 1), np.take_along_axis(both, by, 1)
    if pos.shape[1]:
        yield _found(keys, pos, sims, qkey)


def _shipped(spark, df: DataFrame, key: str, vec: str, dim: int):
    """Keys and vectors of a side that is small enough, sorted by position."""
    held = df.select(key, vec).toArrow()
    keys, vectors = held[key].combine_chunks(), _vectors(held[vec], dim)
    if vec == "_lv":
        order = np.argsort(keys.to_numpy(), kind="stable")
        return spark.sparkContext.broadcast((keys.to_numpy()[order], vectors[order]))
    return spark.sparkContext.broadcast((keys, vectors))


def _pandas_dtype(spark_type: str):
    return {"bigint": "int64", "int": "int32", "string": "object", "double": "float64"}.get(spark_type, "object")


def _block_join_topk(
    queries: DataFrame,
    library: DataFrame,
    k: int,
    qkey: str,
    qb: int,
    lb: int,
    q_group: str | None = None,
    l_group: str | None = None,
) -> DataFrame:
    """Candidates ``(qkey, pos, sim)``: top-k of every (query, library block).

    ``queries``: ``qkey, _qv``; ``library``: ``_pos, _lv``.  With
    ``q_group``/``l_group`` (ANN cells) pairs are formed within a cell only.
    """
    qkey_type = dict(queries.dtypes)[qkey]
    q = queries.withColumn("_qb", F.pmod(F.xxhash64(F.col(qkey)), F.lit(qb)))
    lib = library.withColumn("_lb", F.pmod(F.xxhash64(F.col("_pos")), F.lit(lb)))
    q = q.withColumn("_lb", F.explode(F.sequence(F.lit(0), F.lit(lb - 1)))) if lb > 1 else q.withColumn("_lb", F.lit(0).cast("bigint"))
    lib = lib.withColumn("_qb", F.explode(F.sequence(F.lit(0), F.lit(qb - 1)))) if qb > 1 else lib.withColumn("_qb", F.lit(0).cast("bigint"))
    gq = ["_qb", "_lb"] + ([q_group] if q_group else [])
    gl = ["_qb", "_lb"] + ([l_group] if l_group else [])
    schema = f"{qkey} {qkey_type}, pos bigint, sim double"
    fn = _block_topk_fn(k, qkey, _pandas_dtype(qkey_type))
    return (
        q.select(*gq, qkey, "_qv")
        .groupBy(*gq)
        .cogroup(lib.select(*gl, "_pos", "_lv").groupBy(*gl))
        .applyInPandas(fn, schema)
    )


def _merge_topk(cands: DataFrame, qkey: str, k: int) -> DataFrame:
    w = Window.partitionBy(qkey).orderBy(F.col("sim").desc(), F.col("pos").asc())
    return cands.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).withColumn(
        "rank", F.col("rank").cast("bigint")
    )


def knn_topk(
    queries: DataFrame,
    library: DataFrame,
    k: int = RETRIEVAL_K,
    query_key: str = "qid",
    query_vec: str = "embedding",
    lib_pos: str = "pos",
    lib_vec: str = "embedding",
    block_rows: int = 4096,
    n_queries: int | None = None,
    n_library: int | None = None,
    ship_bytes: int = SHIP_BYTES,
) -> DataFrame:
    """Exact top-k by inner product: ``(query_key, rank, pos, sim)``.

    All vectors have one length.

    ``query_key`` must be unique per query row; ``lib_pos`` unique per
    library row.  For unit vectors the inner product is the cosine
    similarity.  A query against an empty library has no rows.  The block
    counts come from the side sizes; pass ``n_queries`` / ``n_library`` when
    they are known to skip the two ``count`` jobs (an over-estimate only
    makes blocks smaller).
    """
    if k < 1:
        raise ValueError("k >= 1")
    q = queries.select(F.col(query_key), F.col(query_vec).alias("_qv"))
    lib = library.select(F.col(lib_pos).cast("bigint").alias("_pos"), F.col(lib_vec).alias("_lv"))
    nq = q.count() if n_queries is None else n_queries
    nl = lib.count() if n_library is None else n_library
    if nq == 0 or nl == 0:
        return _merge_topk(
            queries.sparkSession.createDataFrame([], f"{query_key} {dict(q.dtypes)[query_key]}, pos bigint, sim double"),
            query_key,
            k,
        ).select(query_key, "rank", "pos", "sim")
    dim = lib.select(F.size("_lv")).first()[0]
    small = min(nq, nl) * dim * 8
    if small <= ship_bytes:
        spark = queries.sparkSession
        schema = f"{query_key} {dict(q.dtypes)[query_key]}, pos bigint, sim double"
        if nl <= nq:
            cands = q.mapInArrow(partial(_by_query, _shipped(spark, lib, "_pos", "_lv", dim), k, query_key), schema)
        else:
            cands = lib.mapInArrow(partial(_by_library, _shipped(spark, q, query_key, "_qv", dim), k, query_key), schema)
        return _merge_topk(cands, query_key, k).select(query_key, "rank", "pos", "sim")
    qb = max(1, math.ceil(nq / block_rows))
    lb = max(1, math.ceil(nl / block_rows))
    cands = _block_join_topk(q, lib, k, query_key, qb, lb)
    return _merge_topk(cands, query_key, k).select(query_key, "rank", "pos", "sim")


def _nearest(v: np.ndarray, centres: np.ndarray, k: int) -> np.ndarray:
    far = (centres**2).sum(1)[None, :] - 2 * v @ centres.T
    return far.argmin(1)[:, None] if k == 1 else np.argsort(far, axis=1, kind="stable")[:, :k]


def _cell_blocks(sizes: dict[int, int], rows: int) -> tuple[list[tuple[int, int, int]], list[list[int]]]:
    """Blocks of at most about ``rows`` vectors: ``(cell, its first block, its
    number of blocks)``, and the cells of each block.  A larger cell is cut,
    smaller ones are put together, so that a query goes once to all of them."""
    placed, members, filled = [], [], rows + 1
    for cell, n in sorted(sizes.items()):
        cuts = math.ceil(n / rows)
        if cuts > 1 or filled + n > rows:
            placed.append((cell, len(members), cuts))
            members += [[cell] for _ in range(cuts)]
            filled = n if cuts == 1 else rows + 1
        else:
            placed.append((cell, len(members) - 1, 1))
            members[-1].append(cell)
            filled += n
    return placed, members


def _probe(shipped, probes: int, key: str, batches):
    """Each query once for every block that holds a cell it looks into, and
    which of the block's cells these are, as bits."""
    centres, cells, members = shipped.value
    at = [np.searchsorted(cells, m) for m in members]
    step = max(1, CELLS // len(cells))
    for batch in batches:
        for i in range(0, batch.num_rows, step):
            part = batch.slice(i, step)
            looks = np.zeros((part.num_rows, len(cells)), bool)
            np.put_along_axis(looks, _nearest(_vectors(part["_qv"], centres.shape[1]), centres, probes), True, 1)
            for block, columns in enumerate(at):
                mine = looks[:, columns]
                rows = np.nonzero(mine.any(1))[0]
                if len(rows):
                    bits = pa.array([r.tobytes() for r in np.packbits(mine[rows], axis=1)], pa.binary())
                    some = [part[c].take(pa.array(rows)) for c in (key, "_qv")]
                    yield pa.RecordBatch.from_arrays([*some, pa.array(np.full(len(rows), block), pa.int64()), bits], names=[key, "_qv", "_block", "_looks"])


def _best_of_cells(queries: np.ndarray, looks: np.ndarray, vectors: np.ndarray, cell: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best rows and similarities of each query among the vectors whose
    cell (a column of ``looks``) it looks into, ties by row; ``NOWHERE`` where
    there are fewer.  No more than ``CELLS`` similarities are held at once, and
    of these only rows that reach their k-th best so far are ordered."""
    sims, found = np.full((len(queries), k), -np.inf, queries.dtype), np.full((len(queries), k), NOWHERE)
    if looks.all():
        cell = np.zeros(len(cell), np.int64)  # as one cell
    order = np.argsort(cell, kind="stable")
    edges = [0, *(np.nonzero(np.diff(cell[order]))[0] + 1), len(cell)]
    for a, b in zip(edges, edges[1:]):
        mine = np.nonzero(looks[:, cell[order[a]]])[0]
        for c in range(a, b, TILE):
            at = order[c : min(c + TILE, b)]
            v = vectors[at].T
            step = max(1, CELLS // len(at))
            for i in range(0, len(mine), step):
                rows = mine[i : i + step]
                new = queries[rows] @ v
                better = ~(new.max(1) < sims[rows, -1])
                rows = rows[better]
                new_at, new = _best(new if better.all() else new[better], at, k)
                both_at, both = np.concatenate([found[rows], new_at], 1), np.concatenate([sims[rows], new], 1)
                by = np.lexsort((both_at, -both), axis=1)[:, :k]
                found[rows], sims[rows] = np.take_along_axis(both_at, by, 1), np.take_along_axis(both, by, 1)
    return found, sims


def _compare_block(dim: int, k: int, key: str, shipped, decode, queries: pa.Table, library: pa.Table) -> pa.Table:
    """The best of each query of one block of queries in one block of cells."""
    if not len(queries) or not len(library):
        return pa.table({key: queries[key].slice(0, 0), "cell": pa.array([], pa.int32()), "pos": pa.array([], pa.int64()), "sim": pa.array([], pa.float64())})
    members = shipped.value[2][queries["_block"][0].as_py()]
    pos = library["_pos"].to_numpy()
    order = np.argsort(pos, kind="stable")
    pos, cell, vectors = pos[order], library["_cell"].to_numpy()[order], decode(library, dim)[order]
    bits = np.frombuffer(b"".join(queries["_looks"].to_pylist()), np.uint8).reshape(len(queries), -1)
    looks = np.unpackbits(bits, axis=1, count=len(members)).astype(bool)
    found, sims = _best_of_cells(_vectors(queries["_qv"], dim).astype(vectors.dtype, copy=False), looks, vectors, np.searchsorted(members, cell), k)
    row, col = np.nonzero(found != NOWHERE)
    at = found[row, col]
    return pa.table({key: queries[key].combine_chunks().take(pa.array(row)), "cell": cell[at], "pos": pos[at], "sim": sims[row, col].astype(np.float64)})


def _doubles(library: pa.Table, dim: int) -> np.ndarray:
    return _vectors(library["_lv"], dim)


def search_cells(
    queries: DataFrame,
    library: DataFrame,
    sizes: dict[int, int],
    centres: np.ndarray,
    probes: int,
    k: int,
    qkey: str,
    decode=_doubles,
    library_rows: int | None = None,
    query_rows: int | None = None,
) -> DataFrame:
    """Candidates ``(qkey, cell, pos, sim)``: of each query the k best of every
    block among the cells that it looks into, the ``probes`` nearest.

    ``queries``: ``qkey, _qv``; ``library``: ``_cell, _pos`` and what
    ``decode`` makes vectors of; ``sizes``: the filled cells' vectors, and
    ``centres`` a row for each, by cell.  Cells are dealt to blocks of about
    ``library_rows`` vectors and queries to blocks of about ``query_rows``; a
    task holds one of each, however many there are.
    """
    spark, kind = queries.sparkSession, dict(queries.dtypes)[qkey]
    placed, members = _cell_blocks(sizes, library_rows or LIBRARY_ROWS)
    shipped = spark.sparkContext.broadcast((centres, np.array(sorted(sizes), np.int64), members))
    n = math.ceil(queries.count() / (query_rows or QUERY_ROWS)) or 1
    probed = queries.mapInArrow(partial(_probe, shipped, probes, qkey), f"{qkey} {kind}, _qv array<double>, _block bigint, _looks binary")
    probed = probed.withColumn("_part", F.pmod(F.xxhash64(qkey), F.lit(n)).cast("bigint"))
    blocks = F.broadcast(spark.createDataFrame(placed, "_cell int, _first bigint, _cuts bigint"))  # a row per cell
    dealt = library.join(blocks, "_cell").withColumn("_block", F.col("_first") + F.pmod(F.xxhash64("_pos"), F.col("_cuts"))).drop("_first", "_cuts")
    dealt = dealt.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))))
    dim = centres.shape[1]

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        return _compare_block(dim, k, qkey, shipped, decode, left, right)

    return probed.groupBy("_block", "_part").cogroup(dealt.groupBy("_block", "_part")).applyInArrow(compare, f"{qkey} {kind}, cell int, pos bigint, sim double")


def knn_ann(
    queries: DataFrame,
    library: DataFrame,
    k: int = 1,
    query_key: str = "qid",
    query_vec: str = "embedding",
    lib_pos: str = "pos",
    lib_vec: str = "embedding",
    n_cells: int | None = None,
    nprobe: int | None = None,
    block_rows: int | None = None,
    seed: int = 7,
    max_iter: int = 10,
    query_rows: int | None = None,
) -> DataFrame:
    """Approximate top-k (IVF): k-means cells over the library, each query
    scored against the library vectors of its ``nprobe`` nearest cells (by
    default a seventh of those that have vectors, two at least).  The index is
    made for this call; ``ann`` stores one.

    Cells are fitted with Spark ML ``KMeans``, by default as many as the root
    of the library's size, 4096 at most; the fitted model assigns the library
    without a shuffle.  Queries probe cells that have vectors, so none is lost.
    The centre and size tables have a row per cell, so they are safe to ship.
    ``block_rows`` and ``query_rows``: vectors that a task holds of either side
    (see ``search_cells``).
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    spark = library.sparkSession
    lib = library.select(F.col(lib_pos).cast("bigint").alias("_pos"), F.col(lib_vec).alias("_lv"), array_to_vector(F.col(lib_vec).cast("array<double>")).alias("_f"))
    qkey_type = dict(queries.dtypes)[query_key]
    cells = n_cells or max(1, min(4096, math.isqrt(lib.count())))
    fitted = None if lib.isEmpty() else KMeans(k=cells, seed=seed, maxIter=max_iter, featuresCol="_f", predictionCol="_cell").fit(lib)
    if fitted is None:
        none = spark.createDataFrame([], f"{query_key} {qkey_type}, pos bigint, sim double")
        return _merge_topk(none, query_key, k).select(query_key, "rank", "pos", "sim")
    # kept once in the shared folder: sizes, and the cells' vectors
    lib_c = written(fitted.transform(lib).select("_cell", "_pos", "_lv"), "cells")
    sizes = {r["_cell"]: r["count"] for r in lib_c.groupBy("_cell").count().collect()}  # a row per cell
    centres = np.array(fitted.clusterCenters())[sorted(sizes)]
    probes = min(nprobe or max(2, math.ceil(0.15 * len(sizes))), len(sizes))
    q = queries.select(F.col(query_key), F.col(query_vec).cast("array<double>").alias("_qv"))
    cands = search_cells(q, lib_c, sizes, centres, probes, k, query_key, library_rows=block_rows, query_rows=query_rows)
    return _merge_topk(cands, query_key, k).select(query_key, "rank", "pos", "sim")


def knn_recall(approx: DataFrame, exact: DataFrame, query_key: str = "qid") -> DataFrame:
    """recall@k of ``approx`` against ``exact`` (same k): one row."""
    hit = exact.join(approx.select(query_key, "pos"), [query_key, "pos"], "left_semi")
    return hit.agg(F.count(F.lit(1)).alias("hits")).crossJoin(
        exact.agg(F.count(F.lit(1)).alias("total"))
    ).select(F.round(F.col("hits") / F.col("total"), 6).alias("recall"))


# ------------------------------------------------------------ asset joins


def asset_lookup(hits: DataFrame, id_map: DataFrame, pos: str = "pos", elem_id: str = "elem_id") -> DataFrame:
    """Position -> element id.  A position with no id (or -1, "no hit")
    gets ``status = NO_HIT`` instead of silently picking another id."""
    m = id_map.select(F.col(pos).cast("bigint").alias("_mpos"), F.col(elem_id))
    out = hits.join(m, F.col(pos).cast("bigint") == F.col("_mpos"), "left").drop("_mpos")
    return out.withColumn("lookup_status", F.when(F.col(elem_id).isNull(), F.lit(NO_HIT)).otherwise(F.lit("OK")))


def missing_assets(hits: DataFrame, library: DataFrame, elem_id: str = "elem_id") -> DataFrame:
    """Hits whose element has no file in the library (left anti join); those
    without an element have none and don't go through the join."""
    named = hits.filter(F.col(elem_id).isNotNull())
    none = hits.filter(F.col(elem_id).isNull()).select(elem_id, *[c for c in hits.columns if c != elem_id])
    return named.join(library.select(elem_id).distinct(), elem_id, "left_anti").unionByName(none)


def asset_gate(layers: DataFrame, library: DataFrame, id_col: str, pos, elem_id: str = "elem_id") -> DataFrame:
    """All-or-nothing per example: one missing file fails the example.

    ``(id, n_layers, n_missing, ok, first_missing_pos, first_missing_elem)``;
    the first missing layer is the one the sequential loop would stop at.
    ``pos`` is the plan-order column (or columns, the first being the
    position that is reported).
    """
    lib = library.select(F.col(elem_id).alias("_e")).distinct().withColumn("_found", F.lit(True))
    # layers without an element would be one key of the join
    named = layers.filter(F.col(elem_id).isNotNull()).join(lib, F.col(elem_id) == F.col("_e"), "left").drop("_e")
    none = layers.filter(F.col(elem_id).isNull()).withColumn("_found", F.lit(False))
    flagged = named.withColumn("_found", F.coalesce(F.col("_found"), F.lit(False))).unionByName(none)
    miss = ~F.col("_found")
    o = order_struct(pos)
    return flagged.groupBy(id_col).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_layers"),
        F.count_if(miss).cast("bigint").alias("n_missing"),
        F.bool_and("_found").alias("ok"),
        F.min(F.when(miss, F.col(_cols(pos)[0]))).alias("first_missing_pos"),
        F.min_by(F.when(miss, F.col(elem_id)), F.when(miss, o)).alias("first_missing_elem"),
    )


def layer_manifest(layers: DataFrame, id_col: str, pos: str, layer_id: str = "layer_id", url: str | None = None) -> DataFrame:
    """Ordered ``[{"layer_id": .., "url": ..}, ...]`` JSON text per example,
    in plan order (``pos``), duplicates kept."""
    url_col = layer_url(layer_id) if url is None else F.col(url)
    entries = layers.select(F.col(id_col), F.col(pos), manifest_entry(F.col(layer_id), url_col).alias("_entry"))
    joined = ordered_concat(entries, id_col, pos, "_entry", sep=", ", out="_body")
    return joined.select(id_col, F.concat(F.lit("["), F.col("_body"), F.lit("]")).alias("manifest"))


def copy_manifest(hits: DataFrame, id_col: str, pos: str, layer_id: str = "layer_id", src: str = "src") -> DataFrame:
    """``(id, dst, src)`` file copies; a repeated layer id writes the same
    destination twice, so the last one (highest ``pos``) wins."""
    with_dst = hits.select(F.col(id_col), layer_url(F.col(layer_id)).alias("dst"), F.col(src), F.col(pos))
    return last_by(with_dst, [id_col, "dst"], pos)


__all__ = [
    "knn_topk",
    "knn_ann",
    "knn_recall",
    "asset_lookup",
    "missing_assets",
    "asset_gate",
    "layer_manifest",
    "copy_manifest",
    "format_manifest_json",
]
