"""Mixing, token files and the pipeline."""

import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from atelier.llm import common as C
from atelier.llm import mixing as M
from atelier.llm import registry
from atelier.llm import token_files as K
from tests.conftest import SF_SMALL
from tests.llm.edges import EDGES, SCHEMA, edge_table, empty_table, prose

PATH = public_tokenizers.path("word_bpe_49k.json")
WORD = r"[^\x20\x09-\x0D]+"


def water(sizes):
    """Targets by name, null last; the excess is reshared until none is above."""
    names = sorted((k for k in sizes if k is not None)) + [None] * (None in sizes)
    weight = {k: i % 3 + 1 for i, k in enumerate(names)}
    target, rest, left = {}, set(names), float(sum(sizes.values()))
    while rest:
        level = left / sum(weight[k] for k in rest)
        over = [k for k in rest if level * weight[k] > 3 * sizes[k]]
        if not over:
            return target | {k: level * weight[k] for k in rest}
        for k in over:
            target[k] = 3.0 * sizes[k]
            left -= target[k]
            rest.remove(k)
    return target


def check_mix(rows, sizes_of, source_of):
    sizes = {}
    for r in rows:
        sizes[source_of[r.doc_id]] = sizes.get(source_of[r.doc_id], 0) + r.size
    want, taken = water(sizes), {}
    for r in rows:
        k = source_of[r.doc_id]
        assert r.size == sizes_of[r.doc_id] and r.source_size == sizes[k]
        assert r.target == pytest.approx(want[k]) and 0 <= r.taken <= 3 * r.size
        taken[k] = taken.get(k, 0) + r.taken
    for k, v in taken.items():
        assert abs(v - want[k]) <= 0.51


def test_mix_query(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    rows = registry.op4_mix_sources(spark, SF_SMALL).collect()
    check_mix(rows, {d.doc_id: len(re.findall(WORD, d.text or "")) for d in docs}, {d.doc_id: d.source for d in docs})
    assert sorted(rows) == sorted(registry.op4_mix_sources(spark, SF_SMALL).collect())


def test_mix_uneven_sources(spark):
    rnd = random.Random(1)
    docs = [(i, prose(i, rnd.choice([0, 1, 5, 300, 900])), rnd.choice(["a"] * 8 + ["b", "Z", "é", "", None])) for i in range(400)]
    docs += [(1000, prose(1, 30_000), "long"), (1001, "tiny", "small"), (1002, "", "nothing")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rows = M.mix_report(df).collect()
    check_mix(rows, {d[0]: len(re.findall(WORD, d[1])) for d in docs}, {d[0]: d[2] for d in docs})


def test_mix_edges(spark):
    df = edge_table(spark, True)
    rows = M.mix_report(df).collect()
    assert len(rows) == len(EDGES) and sum(r.taken for r in rows) > 0
    assert all(r.taken == 0 for r in rows if r.size == 0)
    assert M.mix_report(empty_table(spark)).count() == 0 and M.mixed_documents(empty_table(spark)).count() == 0
    out = M.mixed_documents(df)
    assert out.columns == df.columns
    got = out.select("text", "n_chars").collect()
    assert sum(len(re.findall(WORD, r.text)) for r in got) == sum(r.taken for r in rows)
    assert all(len(r.text) == r.n_chars for r in got)
    blank = spark.createDataFrame([(1, "", None, "a", 1), (2, None, None, None, 1)], SCHEMA)
    assert [r.taken for r in M.mix_report(blank).collect()] == [0, 0] and M.mixed_documents(blank).count() == 0


def test_shards_keep_what_they_draw(spark):
    quotas = {0: 50, 1: 3, 2: 200, 3: 0, 4: 37}
    df = spark.createDataFrame(list(quotas.items()), "no long, slots long")
    total, seen = sum(quotas.values()), []
    for seed in (1, 2):
        rows = M.shard_counts(df, 16, seed).collect()
        shards, taken, lacks = {}, {k: [] for k in quotas}, dict(quotas)
        for r in rows:
            shards[r.shard] = shards.get(r.shard, 0) + r.n
            taken[r.no].append((r.first, r.first + r.n))
        assert shards == {k: min(16, total - 16 * k) for k in range(-(-total // 16))}
        for no, spans in taken.items():  # a source's slots, each once
            spans.sort()
            assert [a for a, _ in spans] == [0, *(b for _, b in spans[:-1])][: len(spans)] and (spans[-1][1] if spans else 0) == quotas[no]
        drawn = {(r.shard, r.no): (r.n, r.drawn) for r in rows if r.drawn is not None}
        for k in sorted(shards):
            rng = np.random.Generator(np.random.PCG64([seed, k, 0]))
            q = np.array([quotas[i] for i in range(5)], float)
            for no, n in enumerate(rng.multinomial(shards[k], q / q.sum())):
                n, want = int(n), min(int(n), lacks[no])
                lacks[no] -= want
                assert drawn.get((k, no), (0, n)) == (want, n)
        seen.append(sorted((r.shard, r.no, r.n) for r in rows))
    assert seen[0] != seen[1]
    assert M.shard_counts(df.limit(0), 16).count() == 0


def test_mix_broadcasts_counted_tables_only(spark):
    """A row per document or slot is not broadcast, also where Spark takes it for small; a row per source is."""
    df = spark.createDataFrame([(i, prose(i, 700), "a") for i in range(40)], "doc_id long, text string, source string")
    _, taken = M.plan(M.sized(df, "doc_id", "source", "text", False))
    mixed = M.mixed_documents(df)
    for out, keys in ((taken, ["no, bucket", "no, block"]), (mixed, ["no, bucket", "no, block", "rid"])):
        assert len(out.collect()) > 0
        plan = re.sub(r"#\d+L?", "", out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0])
        assert all(f"SortMergeJoin [{k}], [{k}]" in plan for k in keys)
        assert not [k for k in keys if f"BroadcastHashJoin [{k}]" in plan]


def test_join_of_too_many_keys_is_no_broadcast(spark):
    """Small rows come 32 times each, which Spark counts once."""
    big = spark.range(1000).select(F.col("id").alias("rid"), (F.col("id") % 60).alias("k"))
    small = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 7).alias("v"))
    want = sorted((i, i % 60, i % 60 * 7 if i % 60 < 50 else None) for i in range(1000))
    for n in (50, C.SMALL_ROWS + 1):
        out = C.join_small(big, small, "k", n, ["rid"], "left").select("rid", "k", "v")
        assert sorted(map(tuple, out.collect())) == want
        assert ("BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()) == (n == 50)


def test_blocks_are_runs_of_documents(spark):
    docs = C.table(spark, SF_SMALL, "documents")
    words = {d.doc_id: re.findall(WORD, d.text or "") for d in docs.collect()}
    source = {d.doc_id: d.source for d in docs.collect()}
    got = {seed: M.mixed_blocks(docs, shard_slots=16, seed=seed).collect() for seed in (1, 2)}
    for rows in got.values():
        assert sorted((r.shard, r.slot) for r in rows) == [(i // 16, i % 16) for i in range(len(rows))]
        short = {}
        for r in rows:
            mine = re.findall(WORD, r.text)
            assert len(mine) == r.n_words <= M.BLOCK_WORDS and {source[k] for k in r["keys"]} == {r.source}
            inner = [w for k in r["keys"][1:-1] for w in words[k]]
            first, last = words[r["keys"][0]], words[r["keys"][-1]]
            ends = [n for n in range(1, len(first) + 1) if len(r["keys"]) == 1 or first[-n:] + inner == mine[: n + len(inner)]]
            if len(r["keys"]) == 1:
                assert any(first[i : i + len(mine)] == mine for i in range(len(first) - len(mine) + 1))
            else:
                assert any(mine[n + len(inner) :] == last[: len(mine) - n - len(inner)] for n in ends)
            short[r.source] = short.get(r.source, 0) + (r.n_words < M.BLOCK_WORDS)
        assert max(short.values()) <= 4  # a source's tail, once a pass, and its last slot
    report = {}
    for r in M.mix_report(docs).collect():
        report[source[r.doc_id]] = report.get(source[r.doc_id], 0) + r.taken
    for rows in got.values():
        taken = {}
        for r in rows:
            taken[r.source] = taken.get(r.source, 0) + r.n_words
        assert taken == {k: v for k, v in report.items() if v}
    assert [r.text for r in got[1]] != [r.text for r in got[2]]


def test_permutations():
    for n in (1, 2, 3, 5, 64, 1000):
        i = np.arange(n)
        out = M.permuted(i, np.full(n, n), np.full(n, 9, np.uint64))
        assert sorted(out.tolist()) == list(range(n))
    assert (M.permuted(np.arange(1000), np.full(1000, 1000), np.full(1000, 1, np.uint64)) != M.permuted(np.arange(1000), np.full(1000, 1000), np.full(1000, 2, np.uint64))).mean() > 0.9


def test_running_totals(spark):
    df = spark.createDataFrame([(i % 3, i // 3, i + 1) for i in range(90)], "g int, o int, v int")
    got = {(r.g, r.o): r.t for r in C.running_totals(df, "g", "o", "v", "t", block=7).collect()}
    assert got == {(g, o): sum(3 * k + g + 1 for k in range(o)) for g in range(3) for o in range(30)}


# ------------------------------------------------------------ token files


def plain(texts):
    """key, start, n_tokens, crc of each document in order."""
    t, at, out = Tokenizer.from_file(PATH), 0, []
    for k, text in texts:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((k, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_token_query(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").collect()
    got = sorted(tuple(r) for r in registry.op7_token_files(spark, SF_SMALL).collect())
    assert got == plain((d.doc_id, d.text) for d in docs)


def test_word_by_word_ids_are_the_tokenizers():
    rnd = random.Random(2)
    t, e = Tokenizer.from_file(PATH), K.WordEncoder(PATH)
    pieces = ["it's", "İ", "É", "é", "don't!!", "<|endoftext|>", "<|ENDOFTEXT|>", "…", ".…", "a.…", "ΑΣ", "١٢", "x" * 90, "!?", "'s", "'S", " ", "　a", "\x1f", "́", "😀.", "á.", "A.", "7.", "ﬁ", "Å", "‍"]
    texts = ["".join(rnd.choice(pieces) + rnd.choice(["", " ", "\n", "  "]) for _ in range(rnd.randrange(12))) for _ in range(3000)]
    for _ in range(2):
        assert [np.frombuffer(i, "<u4").tolist() for i in e.encode(pa.array(texts))] == [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]


def test_shards_round_trip(tmp_path):
    path = f"file://{tmp_path}/a b/shard.zst"
    docs = [(5, b""), (None, b"\1\0\0\0" * 3), (-(2**62), np.arange(K.FRAME_IDS + 7, dtype="<u4").tobytes()), (5, b"\2\0\0\0")]
    w = K.ShardWriter(path)
    for k, ids in docs:
        w.add(k, ids)
    w.close()
    r = K.ShardReader(path)
    assert [r.document(i) for i in (3, 0, 2, 1)] == [docs[i][1] for i in (3, 0, 2, 1)]
    assert r.nulls.tolist() == [False, True, False, False] and r.frames.tolist() == [1, 1, 2, 1]
    file = tmp_path / "a b" / "shard.zst"
    import zstandard

    whole = zstandard.ZstdDecompressor().stream_reader(file.read_bytes(), read_across_frames=True).read()
    assert whole == b"".join(ids for _, ids in docs)
    raw = bytearray(file.read_bytes())
    raw[int(r.where[3]) + 5] ^= 1  # in the middle of a frame
    file.write_bytes(raw)
    with pytest.raises(Exception):
        K.ShardReader(path).document(2)
    assert K.ShardReader(path).document(3) == docs[3][1]


def test_token_edges(spark):
    df = edge_table(spark, True)
    manifest = K.write_token_files(df, C.shared_dir(spark, "t"), PATH, shards=4)
    got = K.read_token_files(manifest, keep_ids=True).orderBy("start").collect()
    assert len(got) == len(EDGES)
    assert [r.doc_id is None for r in got] == [True] * 2 + [False] * (len(EDGES) - 2)
    assert [r.doc_id for r in got[2:]] == sorted(k for k, *_ in EDGES if k is not None)
    want = sorted((str(k), n, crc) for k, _, n, crc in plain((k, t) for k, t, *_ in EDGES))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == want
    at = 0
    for r in got:
        assert r.start == at and len(r.ids) == r.n_tokens and r.ids[-1] == 1
        at += r.n_tokens
    assert K.read_token_files(K.write_token_files(empty_table(spark), C.shared_dir(spark, "t"), PATH)).count() == 0


# ------------------------------------------------------------ pipeline


def stages(spark, docs, n):
    for name, stage in corpus_pipeline.STAGES[:n]:
        docs = C.written(stage(spark, docs, SF_SMALL), name)
    return docs


def test_pipeline_against_plain_steps(spark):
    """Each stage against a plain version of it on the same input."""
    from tests.llm.test_near_dedup import brute

    docs = C.table(spark, SF_SMALL, "documents")
    rows = {r.doc_id: r for r in docs.collect()}
    one = stages(spark, docs, 1)
    assert {r.doc_id for r in one.collect()} == {r.doc_id for r in registry.op8_quality_rules(spark, SF_SMALL).filter("kept").collect()}
    ids = sorted(r.doc_id for r in one.collect())
    _, root = brute([(i, rows[i].text) for i in ids], 5)
    two = C.written(corpus_pipeline.STAGES[1][1](spark, one, SF_SMALL), "two")
    left = sorted(r.doc_id for r in two.collect())
    assert left == [ids[k] for k, r in enumerate(root) if r == k]
    three = C.written(corpus_pipeline.STAGES[2][1](spark, two, SF_SMALL), "three")
    items = [r.text for r in C.table(spark, SF_SMALL, "benchmark").collect()]
    kept = {r.doc_id for r in three.collect()}
    assert kept <= set(left) and not any(t in rows[i].text for i in kept for t in items)
    four = C.written(corpus_pipeline.STAGES[3][1](spark, three, SF_SMALL), "four")
    assert four.columns == docs.columns
    report = M.mix_report(three)
    assert four.select(F.sum(F.regexp_count("text", F.lit(WORD)))).first()[0] == report.agg(F.sum("taken")).first()[0]
    five = corpus_pipeline.STAGES[4][1](spark, four, SF_SMALL).collect()
    got = sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in five)
    assert got == sorted((k, n, crc) for k, _, n, crc in plain((r.doc_id, r.text) for r in four.collect()))


def test_pipeline_runs_on_edges(spark):
    for df in (edge_table(spark), empty_table(spark)):
        out = df
        for name, stage in corpus_pipeline.STAGES:
            out = C.written(stage(spark, out, SF_SMALL), name)
        assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    _ = pa
