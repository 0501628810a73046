"""Trained operators: held-out accuracy, compression lengths, edge rows."""

import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from atelier.llm import quality_classifier as Q
from atelier.llm import registry
from atelier.llm import toxicity as X
from tests.conftest import SF_SMALL
from tests.llm.edges import EDGES, edge_table, empty_table, prose

INSULTS = ["grobbit", "snarfle", "plonkish", "vexwad"]


def toxic_corpus(n, seed=1):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        words = prose(seed * 10_000 + i, rnd.randrange(60, 300)).split()
        bad = i % 4 == 0
        for _ in range(rnd.randrange(2, 6) if bad else 0):
            words.insert(rnd.randrange(len(words)), rnd.choice(INSULTS) + rnd.choice(["", "s", "ing", "."]))
        out.append((i, " ".join(words), int(bad)))
    return out


def test_toxicity_held_out(spark):
    rows = toxic_corpus(900)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labelled = spark.createDataFrame([r for r in rows if r[0] % 3 != 1], "doc_id long, text string, toxic int")
    got = {r.doc_id: r.toxicity for r in X.classify_toxicity(docs, labelled).collect()}
    test = [(got[i] >= X.TOXIC_AT, bool(y)) for i, _, y in rows if i % 3 == 1]
    assert np.mean([p for p, y in test if y]) > 0.9 and np.mean([p for p, y in test if not y]) < 0.02
    assert all(0 <= s <= 1 for s in got.values())


def test_segments_are_those_of_the_class():
    rows = toxic_corpus(400)
    bad, good = ([b" " + b" ".join(X.split(t)) for _, t, y in rows if y == k] for k in (1, 0))
    own = X.own_segments(bad, good)
    assert own and all(any(s.strip() in w.encode() or w[:4].encode() in s for w in INSULTS) for s in own)
    assert not X.own_segments(good, good)


def test_lengths_differ_only_by_the_segments():
    rows = toxic_corpus(400)
    model = X.train([t for _, t, _ in rows], [y for *_, y in rows], 1 / 3)
    toxic, ordinary = model.compressors()
    plain = [w for i in range(40) for w in X.windows(X.split(prose(70_000 + i, 100)))]
    same = np.mean([len(toxic(w)) == len(ordinary(w)) for w in plain])
    assert same > 0.8
    assert len(ordinary(b" a grobbit and snarfle")) - len(toxic(b" a grobbit and snarfle")) >= 4
    assert b"".join(X.windows([b"x" * 90, b"y"])) == b" " + b"x" * 90 + b" y"


def test_query_never_trains_on_held_out_rows(spark):
    got = registry.op2_toxicity(spark, SF_SMALL).collect()
    assert len(got) == C_docs(spark) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in got)


def C_docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()


def test_toxicity_edges(spark):
    rows = toxic_corpus(60)
    labelled = spark.createDataFrame([*rows, (None, "x", 1), (7, None, 0), (8, "", 1), (9, "y", None), (10, "z", 5)], "doc_id long, text string, toxic int")
    out = X.classify_toxicity(edge_table(spark, True), labelled)
    got = out.select("text", "toxicity").collect()
    assert len(got) == len(EDGES) and len({r.toxicity for r in got if not (r.text or "").split()}) == 1
    assert X.classify_toxicity(empty_table(spark), labelled).count() == 0
    one = X.classify_toxicity(edge_table(spark), labelled.filter("toxic = 0"))
    assert one.filter("toxicity > 0.1").count() == 0
    assert X.classify_toxicity(edge_table(spark), labelled.limit(0)).count() == len(EDGES)


# ------------------------------------------------------------ ordinal grades


def graded(n, seed=1):
    """Grade 2: prose; 1: prose with shouting; 0: mostly symbols."""
    rnd, out = random.Random(seed), []
    for i in range(n):
        g = i % 3
        words = prose(seed * 10_000 + i, rnd.randrange(40, 200)).split()
        share = (0.9, 0.35, 0.0)[g]
        out.append((i, " ".join(w.upper() + "!!" if rnd.random() < share else w for w in words), g))
    return out


def test_grades_held_out(spark):
    rows = graded(600)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    rated = spark.createDataFrame([r for r in rows if r[0] % 5], "doc_id long, text string, rating int")
    got = {r.doc_id: r.quality for r in Q.grade_quality(docs, rated).collect()}
    test = [(got[i], g) for i, _, g in rows if i % 5 == 0]
    assert np.mean([q.grade == g for q, g in test]) > 0.9
    assert np.mean([q.selected == (g >= Q.GRADE) for q, g in test]) > 0.95
    for g in (0, 1):
        assert np.mean([q.expected for q, k in test if k == g]) < np.mean([q.expected for q, k in test if k == g + 1])


def test_gradient_and_thresholds():
    """The fitted model's probabilities match the grades' shares, and the
    thresholds are in order."""
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(600, 3)).astype(np.float32)
    place = x @ np.array([1.0, -0.5, 0.0]) + rnd.logistic(size=600)
    grade = np.digitize(place, [-0.5, 1.0])
    model = Q.train(np.pad(x, ((0, 0), (0, 1))), grade, np.bincount(grade, minlength=3) / 600)
    assert (np.diff(model.cuts) > 0).all()
    assert np.allclose(model.weights[:3], [1, -0.5, 0], atol=0.3) and np.allclose(model.cuts, [-0.5, 1.0], atol=0.3)
    assert np.allclose(model.reach(np.pad(x, ((0, 0), (0, 1)))).mean(0), [(grade >= k).mean() for k in (1, 2)], atol=0.03)


def test_vectors_don_t_depend_on_neighbours():
    texts = ["", "one", prose(1, 50), "É\n\nÉ\n", " \n", prose(2, 30)]
    together = np.concatenate(list(Q.vectors(pa.array(texts))))
    alone = np.concatenate([v for t in texts for v in Q.vectors(pa.array([t]))])
    assert np.allclose(together, alone) and together.shape == (len(texts), Q.SIZE)


def test_quality_query_and_edges(spark):
    got = registry.op9_quality_classifier(spark, SF_SMALL).collect()
    assert len(got) == C_docs(spark) and all(0 <= r.expected <= 2 and 0 <= r.tail <= 1 for r in got)
    rated = spark.createDataFrame([*graded(30), (None, "x", 1), (7, None, 0), (8, "", 1), (9, "y", None), (10, "z", 5)], "doc_id long, text string, rating int")
    out = Q.grade_quality(edge_table(spark, True), rated)
    assert out.count() == len(EDGES) and out.filter(F.col("quality.selected").isNull()).count() == 0
    assert Q.grade_quality(empty_table(spark), rated).count() == 0
    only = Q.grade_quality(edge_table(spark), rated.filter("rating = 2")).select("quality.grade").distinct().collect()
    assert [r.grade for r in only] == [2]
    assert Q.grade_quality(edge_table(spark), rated.limit(0)).count() == len(EDGES)
