"""Scans and sinks (temp-folder round trips), streaming intake, model
scoring resume, and a smoke run of every registered query on sf0.001."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from atelier.operators import runs as R
from atelier.operators.score import model_score, stub_factory
from atelier.sources import scans, sinks
from tests.conftest import SF_SMALL


def test_scans(spark):
    d = tempfile.mkdtemp(prefix="atelier-io-")
    with open(f"{d}/train.jsonl", "w") as f:
        f.write(json.dumps({"prompt": "p", "layout_thought": "t", "grouping": "g", "image_generator": "i", "generate_text": "x", "other": 1}) + "\n")
    assert scans.training_scan(spark, f"{d}/train.jsonl").collect()[0].grouping == "g"
    with open(f"{d}/map.json", "w") as f:
        json.dump(["e0", "e1", "e2"], f)
    assert [(r.pos, r.elem_id) for r in scans.id_map_scan(spark, f"{d}/map.json").orderBy("pos").collect()] == [(0, "e0"), (1, "e1"), (2, "e2")]
    os.makedirs(f"{d}/lib")
    for name in ("e0.png", "e2.png", "note.txt"):
        open(f"{d}/lib/{name}", "wb").write(b"\x89PNG")
    assert sorted(r.elem_id for r in scans.library_scan(spark, f"{d}/lib").collect()) == ["e0", "e2"]
    assert len(scans.image_bytes_scan(spark, f"{d}/lib").collect()[0].content) == 4
    with open(f"{d}/ledger.txt", "w") as f:
        f.write("a\n  b \n\na\n")
    assert sorted(r.id for r in scans.ledger_scan(spark, f"{d}/ledger.txt").collect()) == ["a", "b"]
    os.makedirs(f"{d}/art")
    open(f"{d}/art/x.html", "wb").write(b"ok \xff end")
    assert scans.artifact_scan(spark, f"{d}/art").collect()[0].text == "ok � end"


def test_ledger_sink_and_resume_with_failing_stub(spark):
    d = tempfile.mkdtemp(prefix="atelier-ledger-")
    prompts = spark.createDataFrame([(str(i), f"prompt {i}") for i in range(40)], "id string, prompt string")
    scored = model_score(prompts, "prompt", stub_factory(0.3))
    ok_ids = scored.filter("ok").select("id")
    sinks.write_ledger(ok_ids, f"{d}/ledger", run_id="r1")
    failed = {r.id for r in scored.filter("not ok").collect()}
    assert failed  # the stub fails some requests
    pending = R.resume_pending(prompts, spark.read.parquet(f"{d}/ledger"), "id")
    assert {r.id for r in pending.collect()} == failed


def test_stream_intake_respects_ledger(spark):
    from atelier.streaming import stream_intake

    d = tempfile.mkdtemp(prefix="atelier-stream-")
    os.makedirs(f"{d}/in")
    with open(f"{d}/in/a.jsonl", "w") as f:
        f.write('{"id": "1", "prompt": "a"}\n{"id": "2", "prompt": "b"}\n\n')
    with open(f"{d}/in/b.jsonl", "w") as f:
        f.write('{"id": "3", "prompt": "c"}\n{"id": ')
    spark.createDataFrame([("2",)], "id string").write.parquet(f"{d}/ledger")
    q = stream_intake(spark, f"{d}/in", f"{d}/ledger", f"{d}/sink", f"{d}/ckpt", max_files_per_trigger=1)
    q.awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(f"{d}/sink").collect()) == ["1", "3"]


def _intake(spark, d, name="intake", ckpt="ckpt"):
    from atelier.streaming import stream_intake

    q = stream_intake(spark, f"{d}/in", f"{d}/ledger", f"{d}/sink", f"{d}/{ckpt}", max_files_per_trigger=1, name=name)
    q.awaitTermination()


def _lines(path, *ids):
    with open(path, "w") as f:
        f.writelines(json.dumps({"id": i, "prompt": f"p{i}"}) + "\n" for i in ids)


def test_stream_intake_takes_each_id_once_until_it_fails(spark, tmp_path):
    d = str(tmp_path)
    os.makedirs(f"{d}/in")
    _lines(f"{d}/in/a.jsonl", "1", "2", "2")
    _lines(f"{d}/in/b.jsonl", "2", "3")
    _intake(spark, d)
    sink = lambda: sorted((r.id, r.batch_id) for r in spark.read.parquet(f"{d}/sink").distinct().collect())
    assert [i for i, _ in sink()] == ["1", "2", "3"]  # the second file's 2 was in work
    sinks.write_ledger(spark.createDataFrame([("1",)], "id string"), f"{d}/ledger", run_id="work1")
    sinks.write_ledger(spark.createDataFrame([("2",)], "id string"), f"{d}/ledger", run_id="work2", status="failure")
    _lines(f"{d}/in/c.jsonl", "1", "2", "3", "4")
    _intake(spark, d)  # goes on from the checkpoint: 1 is done, 3 in work, 2 is tried again
    assert sink()[-3:] == [("2", 2), ("3", sink()[-2][1]), ("4", 2)] and [i for i, _ in sink()] == ["1", "2", "2", "3", "4"]
    ledger = scans.read_ledger(spark, f"{d}/ledger")
    assert sorted(r.id for r in ledger.filter("status = 'pending'").collect()) == ["1", "2", "2", "3", "4"]


def test_stream_batch_that_is_repeated_adds_nothing(spark, tmp_path):
    """A fault between the ledger's commit and the batch's end: the batch runs
    again after the restart."""
    import shutil

    d = str(tmp_path)
    os.makedirs(f"{d}/in")
    _lines(f"{d}/in/a.jsonl", "1", "2")
    _intake(spark, d)
    _lines(f"{d}/in/b.jsonl", "3")
    shutil.copytree(f"{d}/ckpt", f"{d}/before")
    _intake(spark, d)
    want = sorted(map(str, scans.read_ledger(spark, f"{d}/ledger").select("id", "status", "run_id").collect()))
    _intake(spark, d, ckpt="before")  # the checkpoint as it was before batch 1
    assert sorted(map(str, scans.read_ledger(spark, f"{d}/ledger").select("id", "status", "run_id").collect())) == want
    assert sorted(r.id for r in spark.read.parquet(f"{d}/sink").collect()) == ["1", "2", "3"]


class SlowClient:
    def call(self, request, options):
        import time

        time.sleep(0.05)
        if request == "r7":
            raise ValueError("down")
        return f"{request} {sorted(options.items())}"


def test_calls_in_flight(spark):
    import time

    df = spark.createDataFrame([(i, f"r{i}", "plan" if i % 2 else "html") for i in range(160)], "id int, request string, kind string").coalesce(1)
    options = {"plan": {"top_p": 0.5}, "html": {}}

    def timed(k):
        began = time.time()
        out = model_score(df, "request", SlowClient, {"top_p": 0.9}, in_flight=k, stage="kind", stage_options=options).collect()
        return time.time() - began, out

    timed(16)  # warm
    one, a = timed(1)
    many, b = timed(16)
    assert a == b and [r.id for r in a] == list(range(160)) and not a[7].ok
    assert a[1].response == "r1 [('top_p', 0.5)]" and a[2].response == "r2 [('top_p', 0.9)]"
    assert one > 8 and many < one / 4


def test_native_encoder_against_python(spark):
    import hashlib
    import re

    import numpy as np

    from atelier.operators.encode import encode_text, hash_counts

    texts = ["Hello hello wörld_1 42!", "", None, "... --", "a b c d e f g a b", "ÀÉ éa"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, `my text` string")
    got = {r.i: r for r in encode_text(hash_counts(df, "my text", "n", 8), "my text", dim=8).collect()}
    for i, t in enumerate(texts):
        want = np.zeros(8)
        for tok in re.findall(r"\w+", (t or "").lower()):
            slot = int(hashlib.md5(tok.encode()).hexdigest()[:1], 16) % 16
            want[slot % 8] += 1 if slot < 8 else -1
        assert got[i].n == want.tolist()
        assert np.allclose(got[i].embedding, want / (np.linalg.norm(want) or 1), atol=1e-6)


def test_entry_runs(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.columns == ["conv_id", "ok", "n_layers", "n_missing", "layout_prompt"]
    assert df.count() > 0


@pytest.mark.parametrize("key", sorted(__import__("__spark_entry__").queries()))
def test_every_query_runs_small(spark, key):
    import __spark_entry__ as E

    df = E.queries()[key](spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()
    assert key in E.queries()
    _ = F


def test_layout_prompts_keep_every_conversation(spark):
    import __spark_entry__ as E

    got = E.queries()["layout_prompts"](spark, SF_SMALL).collect()
    conv = {r.conv_id for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").collect()}
    assert {r.conv_id for r in got} == conv and len(got) == len(conv)
    for r in got:
        assert (r.parse_status == "OK") == (r.failed_stage != "plan")
        assert r.ok == (r.failed_stage is None) == (r.layout_prompt is not None)


def test_model_score_keeps_other_columns(spark):
    from decimal import Decimal

    rows = [(2**53 + 1, "a", Decimal("1.10"), [1, None]), (None, None, None, None), (7, "b", Decimal("2.00"), [])]
    df = spark.createDataFrame(rows, "`my id` bigint, request string, d decimal(10,2), ok array<int>")
    got = model_score(df, "request", stub_factory(0.0)).collect()
    assert sorted((str(r["my id"]), str(r.d), r.ok) for r in got) == sorted((str(r[0]), str(r[2]), r[1] is not None) for r in rows)


class CountingClient:
    def __init__(self, path, bad):
        self.path, self.bad = path, bad

    def call(self, request, options):
        with open(f"{self.path}/{request}", "a") as f:
            f.write("x")
        if request in self.bad:
            raise ValueError("down")
        return request.upper()


def test_score_stage_resumes(spark, tmp_path):
    from atelier.operators.score import score_stage

    calls = tmp_path / "calls"
    calls.mkdir()
    df = spark.createDataFrame([(i, f"r{i}") for i in range(12)], "id bigint, request string")
    where = dict(results=f"{tmp_path}/results", ledger=f"{tmp_path}/ledger", stage="html")
    folder = str(calls)
    first = score_stage(df, "request", lambda: CountingClient(folder, {"r3", "r5"}), run_id="1", **where)
    assert sorted(r.id for r in first.collect()) == [i for i in range(12) if i not in (3, 5)]
    assert sorted(r.id for r in R.current_failures(scans.read_ledger(spark, where["ledger"])).collect()) == ["3", "5"]
    second = score_stage(df, "request", lambda: CountingClient(folder, set()), run_id="2", **where)
    assert sorted((r.id, r.response) for r in second.collect()) == [(i, f"R{i}") for i in range(12)]
    assert {p.name: len(p.read_text()) for p in calls.iterdir()} == {f"r{i}": 2 if i in (3, 5) else 1 for i in range(12)}
    third = score_stage(df, "request", lambda: CountingClient(folder, {"r1"}), run_id="3", **where)
    assert third.count() == 12


def test_sinks_and_scans_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a/1", "<p>x</p>", 0), ("b", "<p>y</p>", 1)], "id string, html string, shard int")
    sinks.write_layout_prompts(df.withColumnRenamed("html", "layout_prompt"), f"{tmp_path}/prompts")
    assert spark.read.parquet(f"{tmp_path}/prompts").filter("shard = 1").first().id == "b"
    sinks.write_artifacts(df.drop("shard"), f"{tmp_path}/art", "init")
    sinks.write_artifacts(sinks.copy_stage(df.drop("shard"), "after").withColumn("ok", F.lit(False)), f"{tmp_path}/art", "after", 1)
    art = spark.read.parquet(f"{tmp_path}/art")
    assert sorted((r.id, r.stage, r.round, r.ok, r.path) for r in art.collect()) == [("a/1", "after", 1, False, None), ("a/1", "init", 0, True, None), ("b", "after", 1, False, None), ("b", "init", 0, True, None)]
    sinks.write_intake(df, f"{tmp_path}/intake")
    assert spark.read.parquet(f"{tmp_path}/intake").count() == 2
    summary = spark.createDataFrame([("a", [1], 0.5), ("b", [], 0.0)], "id string, refined_layers array<int>, refine_rate double")
    sinks.write_repair_summary(summary, f"{tmp_path}/summary")
    assert [r.id for r in spark.read.json(f"{tmp_path}/summary").collect()] == ["a"]
    spark.createDataFrame([(3, [0.5, 1.0])], "pos int, embedding array<double>").write.parquet(f"{tmp_path}/vec")
    assert [(r.pos, r.embedding) for r in scans.vector_scan(spark, f"{tmp_path}/vec").collect()] == [(3, [0.5, 1.0])]
    for name in ("x", "y"):
        os.makedirs(f"{tmp_path}/files/{name}")
        open(f"{tmp_path}/files/{name}/out.html", "w").write(name)
        open(f"{tmp_path}/files/{name}/img.png", "wb").write(b"1")
    assert sorted(r.text for r in scans.artifact_scan(spark, f"{tmp_path}/files").collect() if r.path.endswith("html")) == ["x", "y"]
    assert scans.image_bytes_scan(spark, f"{tmp_path}/files").count() == 2
