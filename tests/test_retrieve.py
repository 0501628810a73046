"""Exact kNN against numpy brute force on whole tables; asset joins."""

import numpy as np
from pyspark.sql import functions as F

from atelier.operators import retrieve as RT
from atelier.plans.inspect import formatted
from atelier.session import table
from tests.conftest import SF_SMALL


def brute(qs, lib, k):
    out = {}
    for qid, qv in qs:
        sims = [(float(np.dot(np.asarray(qv, np.float64), np.asarray(lv, np.float64))), pos) for pos, lv in lib]
        sims.sort(key=lambda t: (-t[0], t[1]))
        out[qid] = [pos for _, pos in sims[:k]]
    return out


def _got(df):
    res = {}
    for r in df.orderBy("qid", "rank").collect():
        res.setdefault(r.qid, []).append(r.pos)
    return res


def test_knn_whole_table_matches_brute_force(spark):
    emb = table(spark, SF_SMALL, "embeddings")
    q = emb.select(F.col("vec_id").alias("qid"), "embedding")
    lib = emb.select(F.col("vec_id").alias("pos"), "embedding")
    rows = [(r.vec_id, list(r.embedding)) for r in emb.collect()]
    want = brute(rows, rows, 3)
    for block in (4096, 64):  # one block, and many blocks on both sides
        assert _got(RT.knn_topk(q, lib, k=3, block_rows=block, ship_bytes=0)) == want
    assert _got(RT.knn_topk(q, lib, k=3)) == want  # the library is shipped
    few = q.filter("qid % 7 = 0")  # the queries are
    assert _got(RT.knn_topk(few, lib.repartition(5), k=3)) == {i: p for i, p in want.items() if i % 7 == 0}


def test_knn_in_small_steps(spark, monkeypatch):
    emb = table(spark, SF_SMALL, "embeddings").limit(120)
    rows = [(r.vec_id, list(r.embedding)) for r in emb.collect()]
    rows += [(1000 + i, v) for i, v in rows[:40]]  # ties
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(3)
    monkeypatch.setattr(RT, "CELLS", 500)
    q, lib = df.filter("vec_id < 50").selectExpr("vec_id as qid", "embedding"), df.selectExpr("vec_id as pos", "embedding")
    for k in (1, 4, 500):
        want = brute([(i, v) for i, v in rows if i < 50], rows, k)
        assert _got(RT.knn_topk(q, lib, k=k)) == want
        assert _got(RT.knn_topk(lib.selectExpr("pos as qid", "embedding"), q.selectExpr("qid as pos", "embedding"), k=k)) == brute(rows, [(i, v) for i, v in rows if i < 50], k)


def test_knn_doesn_t_shuffle_the_large_side(spark):
    """Shipped sides leave no exchange below the merge of candidates."""
    emb = table(spark, SF_SMALL, "embeddings")
    lib = emb.select(F.col("vec_id").alias("pos"), "embedding")
    few = emb.filter("vec_id < 20").select(F.col("vec_id").alias("qid"), "embedding")
    for queries, library in ((few, lib), (lib.withColumnRenamed("pos", "qid"), few.withColumnRenamed("qid", "pos"))):
        plan = formatted(RT.knn_topk(queries, library, k=2)).split("(1)")[0]  # the tree: root first
        assert "Exchange" not in plan.partition("MapInArrow")[2] and plan.count("Exchange") == 1, plan


def test_knn_ties_zero_vector_and_small_library(spark):
    lib = spark.createDataFrame([(5, [1.0, 0.0]), (2, [1.0, 0.0]), (9, [0.0, 1.0])], "pos bigint, embedding array<float>")
    q = spark.createDataFrame([("a", [1.0, 0.0]), ("z", [0.0, 0.0])], "qid string, embedding array<float>")
    for ship in (1 << 20, 0):
        got = _got(RT.knn_topk(q, lib, k=5, ship_bytes=ship))
        assert got["a"] == [2, 5, 9]  # exact tie -> lowest position first; k > library
        assert got["z"] == [2, 5, 9]
    empty = spark.createDataFrame([], "pos bigint, embedding array<float>")
    assert RT.knn_topk(q, empty, k=1).count() == 0


def test_knn_plan_has_no_cartesian_product(spark):
    emb = table(spark, SF_SMALL, "embeddings")
    df = RT.knn_topk(emb.select(F.col("vec_id").alias("qid"), "embedding"), emb.select(F.col("vec_id").alias("pos"), "embedding"), k=1, block_rows=64, ship_bytes=0)
    plan = formatted(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_knn_ann_recall(spark):
    emb = table(spark, SF_SMALL, "embeddings")
    q = emb.select(F.col("vec_id").alias("qid"), "embedding")
    lib = emb.select(F.col("vec_id").alias("pos"), "embedding")
    exact = RT.knn_topk(q, lib, k=1)
    approx = RT.knn_ann(q, lib, k=1, n_cells=4, nprobe=4)  # probing every cell is exact
    assert RT.knn_recall(approx, exact).collect()[0].recall == 1.0
    approx2 = RT.knn_ann(q, lib, k=1, n_cells=8, nprobe=2)
    assert RT.knn_recall(approx2, exact).collect()[0].recall >= 0.5


def test_asset_lookup_gate_and_copies(spark):
    hits = spark.createDataFrame([("e1", 0, 0), ("e1", 1, -1), ("e2", 0, 7)], "id string, lpos int, pos bigint")
    idmap = spark.createDataFrame([(0, "img0"), (7, "img7")], "pos bigint, elem_id string")
    got = {(r.id, r.lpos): r.lookup_status for r in RT.asset_lookup(hits, idmap).collect()}
    assert got == {("e1", 0): "OK", ("e1", 1): "NO_HIT", ("e2", 0): "OK"}

    layers = spark.createDataFrame(
        [("a", 0, "x"), ("a", 1, "missing1"), ("a", 2, "missing2"), ("b", 0, "x"), ("c", 0, "gone")], "id string, pos int, elem_id string"
    )
    lib = spark.createDataFrame([("x",)], "elem_id string")
    gate = {r.id: (r.ok, r.first_missing_pos, r.first_missing_elem) for r in RT.asset_gate(layers, lib, "id", "pos").collect()}
    assert gate == {"a": (False, 1, "missing1"), "b": (True, None, None), "c": (False, 0, "gone")}

    copies = spark.createDataFrame([("a", 0, 3, "s0"), ("a", 1, 3, "s1"), ("a", 2, 4, "s2")], "id string, pos int, layer_id bigint, src string")
    got = {r.dst: r.src for r in RT.copy_manifest(copies, "id", "pos").collect()}
    assert got == {"generated_images/layer3.png": "s1", "generated_images/layer4.png": "s2"}


def _clustered(n, seed=1, dim=32):
    """Unit vectors around n / 50 centres, and queries near some of them."""
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(max(n // 50, 2), dim))
    v = centres[rnd.integers(0, len(centres), n)] + 0.6 * rnd.normal(size=(n, dim))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    q = v[:: max(n // 200, 1)] + 0.15 * rnd.normal(size=(len(v[:: max(n // 200, 1)]), dim))
    return v, q


def test_ann_recall_with_defaults_at_two_sizes(spark, tmp_path):
    from atelier.operators import ann

    for n in (600, 6000):
        v, q = _clustered(n)
        lib = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "pos bigint, embedding array<float>")
        queries = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(q)], "qid bigint, embedding array<double>")
        exact = RT.knn_topk(queries, lib, k=1).cache()
        path = f"{tmp_path}/{n}"
        cells = ann.build_index(lib.filter("pos % 3 > 0"), path)
        for _ in range(2):
            ann.add_vectors(lib.filter("pos % 3 = 0"), path, "third")
        assert spark.read.parquet(f"{path}/centres").count() == cells
        for found in (ann.search_index(queries, path), RT.knn_ann(queries, lib, k=1)):
            assert found.count() == len(q)
            assert RT.knn_recall(found, exact).first().recall >= 0.9
        # what is searched is compared exactly, and more cells are never worse
        got = {(r.qid, r.pos): r.sim for r in ann.search_index(queries, path, k=3, nprobe=cells).collect()}
        assert len(got) == 3 * len(q)
        assert all(abs(s - float(np.dot(q[i], v[p].astype(np.float32)))) < 1e-6 for (i, p), s in got.items())
    emb = table(spark, SF_SMALL, "embeddings")
    lib = emb.select(F.col("vec_id").alias("pos"), "embedding")
    ann.build_index(lib, f"{tmp_path}/emb")
    q = emb.select(F.col("vec_id").alias("qid"), "embedding")
    assert RT.knn_recall(ann.search_index(q, f"{tmp_path}/emb"), RT.knn_topk(q, lib)).first().recall >= 0.9


def test_layers_without_element_are_missing(spark):
    rows = [("a", i, None) for i in range(500)] + [("b", 0, "x"), ("b", 1, None), ("c", 0, "x")]
    layers = spark.createDataFrame(rows, "id string, pos int, elem_id string")
    lib = spark.createDataFrame([("x",), (None,)], "elem_id string")
    gate = {r.id: (r.ok, r.n_layers, r.n_missing, r.first_missing_pos) for r in RT.asset_gate(layers, lib, "id", "pos").collect()}
    assert gate == {"a": (False, 500, 500, 0), "b": (False, 2, 1, 1), "c": (True, 1, 0, None)}
    assert RT.missing_assets(layers, lib).count() == 501


def test_search_of_all_cells_holds_blocks_only(spark):
    """Every query looks into every cell: a task's memory depends on the blocks,
    not on the number of queries."""
    import tracemalloc

    rnd = np.random.default_rng(3)
    v, q = rnd.normal(size=(9000, 8)), rnd.normal(size=(12000, 8))
    cell = rnd.integers(0, 3, len(v))
    tracemalloc.start()
    found, sims = RT._best_of_cells(q, np.ones((len(q), 3), bool), v, cell, 1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200e6 < 8 * len(q) * len(v)
    some = rnd.integers(0, len(q), 50)
    assert (found[some, 0] == (q[some] @ v.T).argmax(1)).all()
    placed, members = RT._cell_blocks({0: 5, 2: 40, 3: 6, 5: 7, 9: 2}, 15)
    assert placed == [(0, 0, 1), (2, 1, 3), (3, 4, 1), (5, 4, 1), (9, 4, 1)] and members == [[0], [2], [2], [2], [3, 5, 9]]

    lib = spark.createDataFrame([(i % 590, x.tolist()) for i, x in enumerate(v[:600])], "pos bigint, embedding array<float>")
    queries = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(q[:150])], "qid bigint, embedding array<double>")
    want = _got(RT.knn_topk(queries, lib, k=3))
    for library_rows, query_rows in ((40, 25), (1000, 1000), (40, 1000)):
        assert _got(RT.knn_ann(queries, lib, k=3, n_cells=9, nprobe=9, block_rows=library_rows, query_rows=query_rows)) == want
    few = [_got(RT.knn_ann(queries, lib, k=2, n_cells=9, nprobe=3, block_rows=r, query_rows=r)) for r in (50, 5000)]
    assert few[0] == few[1]  # the cells decide, not the blocks


def test_index_search_of_all_cells_in_blocks(spark, tmp_path, monkeypatch):
    from atelier.operators import ann

    v, q = _clustered(700)
    lib = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "pos bigint, embedding array<float>")
    queries = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(q)], "qid bigint, embedding array<double>")
    ann.build_index(lib, f"{tmp_path}/i", n_cells=6)
    monkeypatch.setattr(RT, "LIBRARY_ROWS", 60)
    monkeypatch.setattr(RT, "QUERY_ROWS", 30)
    assert _got(ann.search_index(queries, f"{tmp_path}/i", nprobe=6)) == _got(RT.knn_topk(queries, lib, k=1))
