"""Near-duplicates: components against brute force, registers, edge rows."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from atelier.llm import common as C
from atelier.llm import near_dedup as N
from atelier.llm import registry
from tests.conftest import SF_SMALL
from tests.llm.edges import EDGES, edge_table, empty_table, prose

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingle_set(t, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1)))


def brute(rows, size):
    """Row number to the least row number that it reaches."""
    sets = [shingle_set(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if sets[i] and 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return sets, [find(i) for i in range(len(rows))]


def check(spark, rows, size):
    sets, root = brute(rows, size)
    groups = {}
    for i, r in enumerate(root):
        groups.setdefault(r, []).append(rows[i][0])
    want = sorted((str(k), len(sets[i]), str(min([x for x in groups[root[i]] if x is not None], default=None))) for i, (k, _) in enumerate(rows))
    got = N.near_dedup(spark.createDataFrame(rows, "doc_id long, text string"), size=size).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def edited(text, rate, rnd):
    return " ".join(f"x{rnd.randrange(10**6)}" if rnd.random() < rate else w for w in text.split())


def test_query_matches_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    sets, root = brute(docs, 2)
    least = {}
    for (k, _), r in zip(docs, root):
        least[r] = min(k, least.get(r, k))
    want = {k: (len(sets[i]), least[root[i]]) for i, (k, _) in enumerate(docs)}
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in registry.op10_near_dedup(spark, SF_SMALL).collect()} == want


@pytest.mark.parametrize("size", [2, 5])
def test_hot_group_with_fringe(spark, size):
    """Copies of one text at all distances around the threshold: chains,
    satellites and one large component in the same buckets."""
    rnd = random.Random(size)
    base = prose(5, 150)
    rows = [(i, edited(base, rnd.choice([0.0, 0.01, 0.02, 0.04, 0.06, 0.1]) / size * 2, rnd)) for i in range(220)]
    rows += [(1000 + i, prose(100 + i, 80)) for i in range(40)] + [(2000 + i, base) for i in range(30)]
    rnd.shuffle(rows)
    check(spark, rows, size)


def test_edges(spark):
    rows = [(k, t) for k, t, *_ in EDGES] + [(20, "a b"), (21, "A B"), (22, "a"), (23, "a b c"), (24, "b a"), (25, "A\x0bB")]
    check(spark, rows, 2)
    df = edge_table(spark, True)
    out = N.deduplicated(df)
    assert out.columns == df.columns
    kept = sorted(str(r.doc_id) for r in out.collect())
    assert kept == sorted(map(str, [1, 4, 5, 6, 7, 8, 9, 10, None, None, 12]))  # 2 and both 3s are copies of 1
    assert N.near_dedup(empty_table(spark)).count() == 0 and N.deduplicated(empty_table(spark)).count() == 0


def test_estimate_is_near_the_jaccard():
    rnd = random.Random(1)
    words = [f"w{i}" for i in range(6000)]
    a, b = rnd.sample(words, 3000), None
    b = a[:2400] + rnd.sample([w for w in words if w not in set(a)], 600)
    t = next(C.texts(pa.array([" ".join(a), " ".join(b)]), 1 << 20))
    row, h = N.shingles(t, 1)
    regs = N.registers(2, row, h)
    n = np.array([float((row == k).sum()) for k in (0, 1)])
    x, k = N.estimate(regs[:1], regs[1:], n[:1], n[1:])
    assert k[0] == N.BUCKETS and abs(x[0] - 2400 / 3600) < 0.12


def test_bands_find_similar_and_borrow_for_small_sets():
    rnd, missed = random.Random(2), 0
    pairs = []
    for i in range(200):
        n = rnd.choice([6, 20, 60, 400])
        a = [f"{i}-{j}" for j in range(n)]
        b = a[: max(1, round(n * 0.9))] + [f"{i}+{j}" for j in range(n - round(n * 0.9))]  # similarity over 0.8
        pairs += [" ".join(a), " ".join(b)]
    keys = []
    for t in C.texts(pa.array(pairs)):
        row, h = N.shingles(t, 1)
        keys.append(N.bands(N.registers(t.n, row, h)))
    keys = np.concatenate(keys)
    for i in range(0, len(keys), 2):
        missed += not (keys[i] == keys[i + 1]).any()
    assert missed == 0


def test_components(spark):
    rnd = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, x) for x in range(101, 400)] + [(rnd.randrange(1000, 1200), rnd.randrange(1000, 1200)) for _ in range(150)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r.id: r.component for r in N.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in edges for x in (a, b) if a != b}
    assert N.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_overlaps():
    rnd = np.random.default_rng(1)
    left, right = ([np.unique(rnd.integers(0, 500, n)) for n in (1, 30, 200)] for _ in range(2))
    want = [[len(np.intersect1d(a, b)) for b in right] for a in left]
    assert (N.overlaps(left, right, columns=7) == want).all()


def test_links_between_texts_are_not_lost_by_case(spark):
    t = prose(9, 90)
    got = N.near_dedup(spark.createDataFrame([(1, t), (2, t.upper())], "doc_id long, text string"), size=2)
    assert got.select(F.max("component_id")).first()[0] == 1


def test_no_table_of_documents_is_broadcast(spark, monkeypatch):
    """These tables are small enough for Spark to broadcast; it sizes the bands of a node as one row."""
    rnd = random.Random(7)
    base = prose(5, 150)
    rows = [(i, edited(base, rnd.choice([0.0, 0.02, 0.04, 0.06, 0.1]), rnd)) for i in range(60)] + [(100 + i, prose(100 + i, 80)) for i in range(10)]
    plans, kept = {}, C.written

    def seen(df, what, *path):
        plans[what] = plans.get(what, "") + df._jdf.queryExecution().executedPlan().toString()
        return kept(df, what, *path)

    monkeypatch.setattr(C, "written", seen)
    out = N.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"))
    plans["result"] = out._jdf.queryExecution().executedPlan().toString()
    assert {w for w, p in plans.items() if "SortMergeJoin" in p} >= {"pairs", "active", "sets", "candidates", "links", "parents", "members", "apart", "tests", "joined", "named", "kept", "result"}
    assert [w for w, p in plans.items() if "Broadcast" in p] == []
    assert out.count() == len(set(brute(rows, 5)[1]))
