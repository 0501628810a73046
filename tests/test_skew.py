"""Skew-safe helpers: a hot key holding a third of all rows."""

import random

from atelier.operators import agg as A
from atelier.operators import runs as R


def _hot_rows(n=3000, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else f"k{rnd.randint(0, 200)}"
        rows.append((key, i, f"v{i}", rnd.random() < 0.8))
    rnd.shuffle(rows)
    return rows


def test_ordered_concat_hot_key_matches_python(spark):
    rows = _hot_rows()
    df = spark.createDataFrame(rows, "k string, pos int, v string, ok boolean")
    got = {r.k: r.text for r in A.ordered_concat(df, "k", "pos", "v", sep="|", chunk_rows=16).collect()}
    want = {}
    for k, pos, v, _ in sorted(rows, key=lambda t: t[1]):
        want.setdefault(k, []).append(v)
    assert got == {k: "|".join(vs) for k, vs in want.items()}
    nulls = spark.createDataFrame([("a", 0, "x"), ("a", 1, None), ("b", 0, "y")], "k string, pos int, v string")
    assert {r.k: r.text for r in A.ordered_concat(nulls, "k", "pos", "v").collect()} == {"a": None, "b": "y"}
    assert {r.k: r.text for r in A.ordered_concat(nulls, "k", "pos", "v", null_policy="skip").collect()} == {"a": "x", "b": "y"}


def test_first_last_and_duplicates_on_hot_key(spark):
    rows = _hot_rows()
    df = spark.createDataFrame(rows, "k string, pos int, v string, ok boolean")
    first = {r.k: r.v for r in A.first_by(df, "k", "pos").collect()}
    last = {r.k: r.v for r in A.last_by(df, "k", "pos").collect()}
    by_key = {}
    for k, pos, v, ok in sorted(rows, key=lambda t: t[1]):
        by_key.setdefault(k, []).append((v, ok))
    assert first == {k: vs[0][0] for k, vs in by_key.items()}
    assert last == {k: vs[-1][0] for k, vs in by_key.items()}
    dup = {r.k: (r.ok, r.attempts) for r in R.duplicate_id_policy(df, "k", "pos", "ok").collect()}
    assert dup == {k: (vs[0][1], 1 if vs[0][1] else len(vs)) for k, vs in by_key.items()}
    rounds = {r.k: r.good_rounds for r in R.last_good_round(df, "k", "pos", "ok", "v").collect()}
    expect = {}
    for k, vs in by_key.items():
        n = 0
        for _, ok in vs:
            if not ok:
                break
            n += 1
        expect[k] = n
    assert rounds == expect
