"""Filter audit, byte-pair encoding and the alignment of two tokenizers."""

import hashlib
import random
from collections import Counter
from itertools import permutations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from atelier.llm import alignment as A
from atelier.llm import bpe as B
from atelier.llm import common as C
from atelier.llm import filter_audit as F
from atelier.llm import registry
from tests.conftest import SF_SMALL
from tests.llm.edges import EDGES, edge_table, empty_table, prose

BYTES, PIECES = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))

# ------------------------------------------------------------ filter audit


def masks(docs):
    """Bits of the failed filters of (key, text, ...)."""
    import re

    out = []
    for key, text, *_ in docs:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = [
            len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), bool(re.search(r"[#$%&*|]", t)),
            key is not None and any(k is not None and k < key and (u or "") == t for k, u, *_ in docs),
        ]
        out.append(sum(f << i for i, f in enumerate(fails)))
    return out


def audit(docs, flags):
    """Applies every order to every part, step by step."""
    out = set()
    bits, failed = {c: 1 << i for i, c in enumerate("ABCDE")}, masks(docs)
    good = {k for k, q, _ in flags if q == 1}
    toxic = {k for k, _, t in flags if t == 1}
    for part in {d[2] or "" for d in docs}:
        mine = [(d[0], m) for d, m in zip(docs, failed, strict=True) if (d[2] or "") == part]
        rows, shapley = [], Counter()
        for order in permutations("ABCDE"):
            left, gone = mine, []
            for step, c in enumerate(order, 1):
                here = [x for x in left if x[1] & bits[c]]
                left = [x for x in left if not x[1] & bits[c]]
                shapley[c] += len(here)
                redundant = sum(1 for x in gone if x[1] & bits[c])
                gone += here
                rows.append((part, "".join(order), step, len(left), len(here), redundant, sum(m == bits[c] for _, m in mine), sum(k in good for k, _ in here), sum(k in toxic for k, _ in here), c))
        out |= {(*r[:-1], shapley[r[-1]]) for r in rows}
    return out


def audit_rows(df):
    return {tuple(r[c] for c in ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")) for r in df.collect()}


def corpus(n=300):
    rnd, out = random.Random(3), []
    for i in range(n):
        t = prose(rnd.randrange(n // 2), rnd.choice([30, 199, 200, 260]))
        t = rnd.choice([t, t.upper(), t + " #", "same words here " * 90, t])
        out.append((rnd.randrange(n), t, rnd.choice(["a", "a", "b", "", None])))
    return out


def test_audit_against_every_order(spark):
    docs = corpus()
    flags = [(i, i % 2, int(i % 7 == 0)) for i in range(0, 300, 2)] + [(4, 1, 0), (4, None, None), (None, 1, 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    made = F.filter_masks(df)
    assert sorted((r.doc_id, r.part, r["mask"]) for r in made.collect()) == sorted((d[0], d[2] or "", m) for d, m in zip(docs, masks(docs), strict=True))
    got = F.interaction_audit(made, spark.createDataFrame(flags, "doc_id long, quality int, toxic int"))
    assert audit_rows(got) == audit(docs, flags)


def test_audit_edges(spark):
    docs = [(k, t, s) for k, t, _, s, _ in EDGES]
    made = F.filter_masks(edge_table(spark, True))
    assert sorted((str(r.doc_id), r.part, r["mask"]) for r in made.collect()) == sorted((str(d[0]), d[2] or "", m) for d, m in zip(docs, masks(docs), strict=True))
    flags = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit_rows(F.interaction_audit(made, flags)) == audit(docs, [])
    assert F.interaction_audit(F.filter_masks(empty_table(spark)), flags).count() == 0


def test_trie_holds_least_ids():
    rnd = random.Random(5)
    texts = ["".join(rnd.choice("ab") for _ in range(rnd.randrange(9))).encode() for _ in range(2000)] + [b"\xc3\xa9" * 5000, b""]
    trie, want = F.Trie(), {}
    numbers = []
    for i, t in enumerate(texts):
        key = rnd.choice([None, rnd.randrange(1000)])
        numbers.append(trie.insert(t, key))
        if t not in want or (key is not None and (want[t] is None or key < want[t])):
            want[t] = key
    assert {t: k for t, k, _ in trie.terminals()} == want and trie.size == len(want)
    least = trie.least()
    assert [least[n] for n in numbers] == [want[t] for t in texts]


def test_shared_prefixes_are_lengthened(spark, monkeypatch):
    """Texts that agree in hundreds of characters are dealt by longer prefixes,
    small tries and many hand-overs don't change the masks."""
    monkeypatch.setattr(F, "RANGE_BYTES", 2000)
    head = prose(9, 60)
    docs = [(i, head + str(i % 150), "a") for i in range(300)] + [(1000 + i, head[:70], "a") for i in range(40)] + [(2000 + i, f"{i} x", "a") for i in range(20)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(5)
    got = {r.doc_id: r["mask"] & 16 for r in F.filter_masks(df).collect()}
    assert got == {d[0]: m & 16 for d, m in zip(docs, masks(docs), strict=True)}
    texts = df.selectExpr("doc_id as number", "doc_id as least", "octet_length(text) as size", "cast(text as binary) as text")
    lengths = {len(r.prefix) for r in F._prefixed(texts, 8).collect()}
    assert min(lengths) < 16 and max(lengths) > 64


# ------------------------------------------------------------ byte pairs

BITS = ["'s", "'t", "'re", "'ve", "'l", "'ll", "'m", "'d", "''", "'", " ", "  ", "\n", "\t", "\xa0", "　", " ", "\x1c", "\x85", "a", "bc", "The", "1", "٣", "½", "²", "é", "中文", "😀", "!", ".."]
BITS += ["<|endoftext|>", "<|endoftext", "|>", "ᾳ", "́", "‍", "ñ", "0", "x" * 50, " " * 9, "=-=" * 7, "\x00", "�", "zq" * 1500]


@pytest.mark.parametrize("special", [True, False])
def test_ids_are_the_tokenizers(special):
    rnd = random.Random(1)
    texts = ["".join(rnd.choice(BITS) for _ in range(rnd.randrange(14))) for _ in range(3000)] + [None, "", prose(1, 9000), "ab" * 40_000]
    t = Tokenizer.from_file(BYTES)
    t.encode_special_tokens = not special
    ids, counts = B.encoded(B.tokenizer(BYTES), pa.array(texts), special)
    got = [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    assert got == [x.ids for x in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_merges_equal_plain_merging():
    """Small random vocabularies against merging by rank, pair by pair."""
    rnd = random.Random(7)
    for _ in range(60):
        pieces, pairs = ["a", "b", "c"], []
        pieces = [chr(i) for i in range(3)]
        for _ in range(rnd.randrange(1, 14)):
            a, b = rnd.randrange(len(pieces)), rnd.randrange(len(pieces))
            if pieces[a] + pieces[b] not in pieces:
                pairs.append((a, b))
                pieces.append(pieces[a] + pieces[b])
        rank = {p: i for i, p in enumerate(pairs)}

        def plain(symbols):
            out = list(symbols)
            while True:
                best = min((rank.get(p, 99), i) for i, p in enumerate(zip(out, out[1:], strict=False))) if len(out) > 1 else (99, 0)
                if best[0] == 99:
                    return out
                out[best[1] : best[1] + 2] = [3 + best[0]]

        # only tokens that the merges themselves make are reachable
        if any(plain([ord(c) for c in p]) != [i] for i, p in enumerate(pieces)):
            continue
        m = B.Merges(3, pieces, pairs)
        words = [[rnd.randrange(3) for _ in range(rnd.randrange(1, 30))] for _ in range(40)]
        off = np.concatenate([[0], np.cumsum([len(w) for w in words])])
        flat, n = m.encode(np.concatenate(words), off)
        assert [x.tolist() for x in np.split(flat, np.cumsum(n)[:-1])] == [plain(w) for w in words]
        for k, w in enumerate(words):  # long words go step by step
            assert m._walk(m.automaton.longest(np.array(w), np.array([0, len(w)])).tolist()) == plain(w), k


def test_long_texts_are_cut_where_pieces_end(monkeypatch):
    text = prose(3, 3000) + " \n\n it's 12 a" * 50
    want = Tokenizer.from_file(BYTES).encode(text, add_special_tokens=False).ids
    monkeypatch.setattr(B, "SLICE", 700)
    assert B.encoded(B.tokenizer(BYTES), pa.array([text]))[0].tolist() == want


def test_text_of_20_mb():
    text = prose(4, 30_000) * 120
    assert len(text) > 20_000_000
    ids, counts = B.encoded(B.tokenizer(BYTES), pa.array([text]))
    assert B.tokenizer(BYTES).decode(ids[:1_000_000])[0].tobytes() == text.encode()[: int(B.tokenizer(BYTES).size[ids[:1_000_000]].sum())]
    assert counts.tolist() == [len(ids)]


def test_decoding_any_ids(spark):
    t = Tokenizer.from_file(BYTES)
    rnd = random.Random(2)
    ids = [[rnd.randrange(50257) for _ in range(rnd.randrange(9))] for _ in range(400)] + [[50256], [222, 223], [99999]]
    df = spark.createDataFrame([(i, np.array(x, "<u4").tobytes()) for i, x in enumerate(ids)] + [(9999, None)], "i int, ids binary")
    got = {r.i: r.t for r in df.select("i", B.decode_column(BYTES, df.ids).alias("t")).collect()}
    assert got == {i: t.decode(x, skip_special_tokens=False) for i, x in enumerate(ids)} | {9999: None}


def test_bpe_query_and_edges(spark):
    t = Tokenizer.from_file(BYTES)

    def want(text):
        ids = t.encode(text or "", add_special_tokens=False).ids
        return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()

    docs = {d.doc_id: d.text for d in C.table(spark, SF_SMALL, "documents").collect()}
    assert {r.doc_id: tuple(r)[1:] for r in registry.op12_bpe_round_trip(spark, SF_SMALL).collect()} == {k: want(v) for k, v in docs.items()}
    out = B.bpe_round_trip(edge_table(spark, True), BYTES, out="rules").select("text", "rules.*").collect()
    assert len(out) == len(EDGES)
    for r in out:
        assert (r.n_tokens, hashlib.sha256(r.ids).hexdigest()) == want(r.text)[:2] and r.decoded == (r.text or "")
    assert B.bpe_round_trip(empty_table(spark), BYTES).count() == 0


# ------------------------------------------------------------ alignment


def plain_alignment(docs):
    """Rows of (key, text) aligned token by token."""
    a, b = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a.encode_special_tokens = True
    byte_of = {c: i for i, c in enumerate(B.byte_chars())}
    spelt = {i: t.encode() if i == 50256 else bytes(byte_of[c] for c in t) for t, i in a.get_vocab().items()}
    piece = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in range(b.get_piece_size())]
    found, count = [], Counter()
    for key, text in docs:
        groups, links, x, y = [], [], [], []
        if text:
            x, y, whole = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text), (" " + text).encode()
            if b"".join(spelt[i] for i in x) != whole or b"".join(piece[i] for i in y) != whole:
                x, y = [], []
        i = j = at = to = 0
        mine: tuple = ([], [])
        while i < len(x) or j < len(y):
            if at <= to:
                at, i = at + len(spelt[x[i]]), i + 1
                mine[0].append(x[i - 1])
            else:
                to, j = to + len(piece[y[j]]), j + 1
                mine[1].append(y[j - 1])
            if at == to:
                groups.append(",".join(map(str, mine[0])) + "|" + ",".join(map(str, mine[1])))
                links.append((mine[0][-1], mine[1][-1]))
                mine = ([], [])
        count.update(links)
        found.append((key, len(x), len(y), groups, links))
    most = {}
    for (_, y), n in count.items():
        most[y] = max(n, most.get(y, 0))
    rows = [(k, na, nb, len(g), len(ls), sum(count[p] == most[p[1]] for p in ls), sum(count[p] for p in ls), ";".join(g)) for k, na, nb, g, ls in found]
    return rows, {(p[0], p[1], n, n == most[p[1]]) for p, n in count.items()}


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def test_alignment_query(spark):
    docs = [(d.doc_id, d.text) for d in C.table(spark, SF_SMALL, "documents").collect()]
    want = {r[0]: (*r[1:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "") for r in plain_alignment(docs)[0]}
    got = {r.doc_id: (*(r[c] for c in COLUMNS), r.groups_sha256) for r in registry.op13_token_alignment(spark, SF_SMALL).collect()}
    assert got == want


def test_alignment_edges_and_many_runs(spark, monkeypatch):
    rnd = random.Random(4)
    extra = [(100 + i, "".join(rnd.choice(BITS[:-1] + ["▁", "▁a", " <s> ", "<0x41>", "the", " of"]) for _ in range(rnd.randrange(12)))) for i in range(300)]
    df = edge_table(spark, True)
    texts = [(k, t) for k, t, *_ in EDGES]
    rows = df.select("doc_id", "text", "key", "rid").union(spark.createDataFrame([(k, t, 0, 0) for k, t in extra], "doc_id long, text string, key int, rid int"))
    want, pairs = plain_alignment([*texts, *extra])
    assert sum(r[1] == 0 for r in want) > 5
    for merged in (16, 1):  # more merges than one give the same counts
        monkeypatch.setattr(A, "MERGED_RUNS", merged)
        documents, found = A.align_tokenizers(rows.repartition(6), BYTES, PIECES)
        got = [(r.doc_id, *(r[c] for c in COLUMNS), r.groups) for r in documents.collect()]
        assert sorted(map(str, got)) == sorted(map(str, want))
        assert {tuple(r) for r in found.select("a_id", "b_id", "links", "best").collect()} == pairs
    documents, found = A.align_tokenizers(empty_table(spark), BYTES, PIECES)
    assert documents.count() == 0 and found.count() == 0


def test_runs_hold_every_link():
    """Buffers that fill up often, against counting all links."""
    rnd = np.random.default_rng(3)
    runs, want, per, blobs = A.Runs(most=50, radixes=3), Counter(), Counter(), []
    for k in range(40):
        rids = np.arange(5) + 10 * k
        n = rnd.integers(0, 9, 5)
        pairs = rnd.integers(0, 4, n.sum()) * A.PAIR + rnd.integers(0, 3, n.sum())
        want.update(pairs.tolist())
        per.update(zip(np.repeat(rids, n).tolist(), pairs.tolist(), strict=True))
        blobs += runs.add(rids, n, pairs)
    blobs += runs.flush()
    assert len({run for run, *_ in blobs}) > 5
    got, rows = Counter(), Counter()
    for radix in range(3):
        mine = [b for _, r, b in blobs if r == radix]
        pairs, links = A.merge_counts(mine)
        assert (np.diff(pairs) > 0).all() and (pairs // A.PAIR % 3 == radix).all()
        got.update(dict(zip(pairs.tolist(), links.tolist(), strict=True)))
        for b in mine:
            pair, docs, _ = A.run_head(b)
            row, times, rids = A.run_body(b)
            for p, r, t in zip(np.repeat(pair, docs).tolist(), rids[row].tolist(), times.tolist(), strict=True):
                rows[r, p] += t
    assert got == want and rows == per
