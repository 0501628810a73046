"""Decontamination and repeated passages: planted cases and edge rows."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from atelier.llm import common as C
from atelier.llm import decontaminate as D
from atelier.llm import registry
from atelier.llm import substring_dedup as S
from tests.conftest import SF_SMALL
from tests.llm.edges import EDGES, edge_table, empty_table, prose


def edits(a: str, b: str) -> int:
    """Least edits of all of ``a`` against any part of ``b``."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def noisy(text, rate, rnd):
    out = list(text)
    for _ in range(int(len(out) * rate)):
        j = rnd.randrange(len(out))
        what = rnd.randrange(3)
        if what == 0:
            out[j] = rnd.choice("abcdefgh")
        elif what == 1:
            del out[j]
        else:
            out.insert(j, rnd.choice("klmnop"))
    return "".join(out)


def test_every_probe_within_its_budget_is_found():
    """Against a full alignment of each probe with each document."""
    rnd = random.Random(1)
    items = [(i, prose(50 + i, rnd.randrange(8, 45))) for i in range(6)]
    docs = []
    for i in range(30):
        body = prose(500 + i, rnd.randrange(5, 60)).split()
        at = rnd.randrange(len(body))
        text = noisy(rnd.choice(items)[1], rnd.choice([0, 0.03, 0.07, 0.1, 0.2]), rnd)
        docs.append(" ".join([*body[:at], text, *body[at:]]))
    index = D._Index(items)
    t = next(C.texts(pa.array(docs), 1 << 22))
    row, probe, *_ , k = index.search(t)
    got = {(int(r), int(p)): int(x) for r, p, x in sorted(zip(row, probe, k), key=lambda z: -z[2])}
    for i, d in enumerate(docs):
        folded = D._folded(np.frombuffer(d.encode(), np.uint8))[0].tobytes().decode("latin-1")
        for p in range(index.n):
            least = edits(index.text[p, : index.length[p]].tobytes().decode("latin-1"), folded)
            assert ((i, p) in got) == (least <= index.budget[p])
            assert got.get((i, p), least) == least


def test_spans_and_case(spark):
    bench = spark.createDataFrame([(7, prose(60, 30)), (8, "too short"), (None, None)], "item_id long, text string")
    docs = [(1, "É start. " + prose(60, 30).upper().replace(" ", " \n") + "! end"), (2, prose(61, 80)), (3, None), (4, "")]
    got = {r.doc_id: r for r in D.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    (hit,) = got[1].hits
    assert hit.item == 7 and hit.edits == 0
    found = docs[0][1][hit.start : hit.end]
    assert found.startswith(prose(60, 30).upper()[:5]) and "start" not in found and "end" not in found
    assert not got[2].hits and not got[3].hits and not got[4].hits


def test_query_finds_exactly_the_documents_with_items(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()
    want = {(d.doc_id, i.item_id) for d in docs for i in items if i.text in (d.text or "")}
    got = registry.op1_decontaminate(spark, SF_SMALL).collect()
    assert want <= {(r.doc_id, r.item_id) for r in got}
    # anything more must hold long stretches of the item
    for r in got:
        if (r.doc_id, r.item_id) not in want:
            text = next(d.text for d in docs if d.doc_id == r.doc_id)
            item = next(i.text for i in items if i.item_id == r.item_id)
            assert any(item[k : k + 60] in text for k in range(len(item) - 60)) or edits(item[: len(item) // 2], text) < len(item) / 6


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    docs = edge_table(spark, True)
    bench = spark.createDataFrame([(i, prose(s, 40)) for i, s in enumerate([3, 4, 70, 71])], "item_id long, text string")
    whole = sorted(str((r.doc_id, sorted(h.item for h in r.hits))) for r in D.decontaminate(docs, bench).collect())
    monkeypatch.setattr(D, "BLOCK_BYTES", 300)
    parts = sorted(str((r.doc_id, sorted(h.item for h in r.hits))) for r in D.decontaminate(docs, bench).collect())
    assert whole == parts and len(whole) == len(EDGES)
    assert D.decontaminate(empty_table(spark), bench).count() == 0
    none = D.decontaminate(docs, bench.limit(0))
    assert none.count() == len(EDGES) and none.filter(F.size("hits") > 0).count() == 0


def test_a_text_that_starts_inside_an_item():
    """Its q-grams lie on diagonals in front of the stream."""
    item = prose(77, 40)
    index = D._Index([(1, item)])
    for n in (20, 100, 150, len(item)):
        row, *_ = index.search(next(C.texts(pa.array([item[-n:], prose(78, 3000)]), 1 << 22)))
        assert set(row.tolist()) == ({0} if n >= 100 else set())


def test_beginnings_middles_and_ends_of_items_are_found(spark):
    """Parts of short and long items in clean documents, and across the cuts."""
    items = [(n, prose(900 + n, n)) for n in (8, 12, 16, 20, 30, 40, 60, 90, 200)]
    rows = []
    for n, text in items:
        b = len(text)
        parts = {(0, b * 4 // 5), (b // 5, b)}
        if b >= 100:
            parts |= {(b // 5, b * 4 // 5)}
        if b >= 120:
            parts |= {(0, b // 2), (b // 4, b * 3 // 4), (b // 2, b)}
        if b > 300:
            parts |= {(c - 80, c + 80) for c in range(80, b - 80, 45)}
        rows += [(len(rows) + k, n, f"{prose(5000 + len(rows) + k, 40)} {text[s:e]} {prose(7000 + len(rows) + k, 40)}") for k, (s, e) in enumerate(sorted(parts))]
    rows += [(len(rows) + k, -1, prose(9000 + k, 150)) for k in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, item long, text string")
    for r in D.decontaminate(docs, spark.createDataFrame(items, "item_id long, text string")).collect():
        assert {h.item for h in r.hits} == ({r.item} if r.item > 0 else set()), r.doc_id
        for h in r.hits:
            assert h.probes >= 1 and r.text[h.start : h.end] and h.length >= D.LEAST


# ------------------------------------------------------------ repeated passages


def test_cuts_by_definition():
    b = np.random.default_rng(3).integers(0, 256, 3000).astype(np.uint8)
    h = S.gear(b, np.ones(len(b), bool))
    for i in range(100, 200):
        want = sum(int(S.GEAR[b[i - j]]) << j for j in range(S.SPAN)) % 2**32
        assert h[i] == want
    r = S.REACH
    want = [i for i in range(r, len(h) - r) if h[i] > max(h[i - r : i]) and h[i] >= max(h[i + 1 : i + r + 1])]
    assert S.cuts(h).tolist() == want


def test_chunks_cover_and_resist_insertions():
    text = prose(11, 3000)
    moved = text[:4000] + " inserted words here " + text[4000:]
    a, b = ([t[s:e] for s, e in zip(row["start"], row["end"])] for t, row in zip((text, moved), _rows([text, moved])))
    assert "".join(a) == text and "".join(b) == moved
    assert len(set(a) - set(b)) <= 4
    assert [len(r["digest"]) for r in _rows(["", None, "x"])] == [0, 0, 1]


def _rows(texts):
    cols = dict(zip(("digest", "start", "end", "words"), S.chunks(pa.array(texts, pa.string())), strict=True))
    return [{k: v[i].as_py() for k, v in cols.items()} for i in range(len(texts))]


def test_planted_passages_are_found_and_clean_documents_left(spark):
    rnd = random.Random(5)
    unique = lambda n: " ".join(f"{rnd.randrange(10**9):x}" for _ in range(n))
    rows, planted = [], set()
    for k in range(40):
        passage = prose(1000 + k, rnd.randrange(55, 90))
        for _ in range(rnd.choice([2, 3])):
            rows.append((len(rows), f"{unique(rnd.randrange(3, 200))} {passage} {unique(rnd.randrange(3, 60))}"))
            planted.add(len(rows) - 1)
    line = prose(3000, 12)
    for _ in range(60):  # clean: a short line is shared
        rows.append((len(rows), f"{unique(100)}\n{line}\n{unique(60)}"))
    df = spark.createDataFrame(rows, "key long, text string").withColumn("rid", F.monotonically_increasing_id())
    got = S.repeated_passages(df).collect()
    assert {r.key for r in got} == planted
    for r in got:
        assert r.n_words >= S.LEAST_WORDS and r.end > r.start


def test_later_copies_go(spark):
    p = prose(12, 90)
    docs = spark.createDataFrame([(1, f"alpha {p} beta", "x"), (2, f"é gamma {p} delta", "y"), (3, None, "z"), (4, "", "z")], "doc_id long, text string, repeats string")
    out = {r.doc_id: r for r in S.substring_dedup(docs).collect()}
    assert out[1].text == f"alpha {p} beta" and out[1].repeats == []
    assert len(out[2].text) < 120 and out[2].text.startswith("é gamma") and out[2].text.endswith("delta")
    assert out[3].text is None and out[4].text == ""


def test_every_shared_chunk_stays_in_its_least_document(spark):
    """Passages next to a line, in front or behind, that lesser documents hold."""
    line, p, q = prose(20, 30), prose(21, 90), prose(22, 90)
    own = [prose(200 + i, 40) for i in range(8)]
    texts = [(3, f"{own[0]} {line} {own[1]}"), (5, f"{own[2]} {line} {p} {own[3]}"), (9, f"{line} {p} {q}"), (7, f"{own[4]} {q} {line} {p} {own[5]}"), (9, f"{own[6]} {p} {line} {own[7]} {q}"), (None, q)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    out = S.substring_dedup(docs.withColumn("n", F.monotonically_increasing_id())).collect()
    got = sorted(out, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.n))
    old = [texts[r.n][1] for r in got]
    assert p in got[2].text and p not in got[3].text and got[0].text == q and got[1].text == old[1]
    chunked = _rows(old)
    holders = {}
    for i, row in enumerate(chunked):
        for x in row["digest"]:
            holders.setdefault(x, set()).add(i)
    for i, row in enumerate(chunked):
        stretch = []
        for k in range(len(row["digest"]) + 1):
            if k < len(row["digest"]) and len(holders[row["digest"][k]]) > 1:
                stretch.append(k)
                continue
            long = sum(row["words"][x] for x in stretch) >= S.LEAST_WORDS
            for x in stretch:
                gone = any(c.start <= row["start"][x] and row["end"][x] <= c.end for c in got[i].repeats)
                assert gone == (long and min(holders[row["digest"][x]]) < i)
            stretch = []
        kept = "".join(old[i][s:e] for s, e in zip(row["start"], row["end"], strict=True) if not any(c.start <= s < c.end for c in got[i].repeats))
        assert kept == got[i].text


def test_passage_edges(spark):
    df = edge_table(spark, True)
    out = S.substring_dedup(df)
    assert out.count() == len(EDGES) and "repeats" in out.columns
    assert S.substring_dedup(empty_table(spark)).count() == 0


def test_repeated_passages_query_against_plain_counts(spark):
    """The registered query against the chunks of every document, counted
    without Spark."""
    from atelier.llm import registry
    from atelier.llm import substring_dedup as S
    from tests.conftest import SF_SMALL

    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect())
    digest, start, end, words = (c.to_pylist() for c in S.chunks(pa.array([t for _, t in docs])))
    holders = {}
    for (key, _), some in zip(docs, digest, strict=True):
        for d in some:
            holders.setdefault(d, set()).add(key)
    want = set()
    for (key, _), d, s, e, w in zip(docs, digest, start, end, words, strict=True):
        i = 0
        while i < len(d):
            j = i
            while j < len(d) and len(holders[d[j]]) > 1:
                j += 1
            total = sum(w[i:j])
            a = i
            while a < j and total >= S.LEAST_WORDS:
                first = min(holders[d[a]]) == key
                b = a
                while b < j and (min(holders[d[b]]) == key) == first:
                    b += 1
                want.add((key, s[a], e[b - 1], total, first))
                a = b
            i = max(j, i + 1)
    got = registry.op5_repeated_passages(spark, SF_SMALL).collect()
    assert {(r.doc_id, r.start, r.end, r.n_words, r.first) for r in got} == want and len(got) == len(want)
