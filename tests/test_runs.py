"""Intake, sharding, ledgers, duplicates, rounds and outcomes."""

from pyspark.sql import functions as F

from atelier.operators import runs as R
from atelier.plans.inspect import formatted


def test_intake_edges(spark):
    lines = [
        "",
        "   ",
        '{"prompt": "p"}',
        '{"id": "1"}',
        '{"id": "2", "prompt": null}',
        '{"id": ',
        '{"id": 7, "prompt": "numeric id"}',
        '{"id": "3", "prompt": "ok", "extra": [1]}',
        "[1, 2]",
    ]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "pos int, value string")
    out = {r.pos: r for r in R.intake_lines(df, keep=("pos",)).collect()}
    assert [out[i].status for i in range(len(lines))] == [
        "BLANK", "BLANK", "MISSING_KEY", "MISSING_KEY", "OK", "MALFORMED", "OK", "OK", "MISSING_KEY",
    ]
    assert out[4].has_null is True and out[4].prompt is None
    assert out[6].id == "7"  # ids are strings after intake


def py_shards(ids, n, i):
    order = sorted(range(len(ids)), key=lambda k: (ids[k], k))
    return [order[j] for j in range(i, len(order), n)]


def test_shard_stride_matches_slice(spark):
    ids = ["10", "9", "a", "A", "9", "b", "", "Z", "10"] * 7
    df = spark.createDataFrame([(p, s) for p, s in enumerate(ids)], "pos int, id string")
    for n in (1, 3, 4, 100):
        for i in range(min(n, 4)):
            got = sorted(r.pos for r in R.shard_stride(df, "id", "pos", n, i, partitions=5).collect())
            assert got == sorted(py_shards(ids, n, i)), (n, i)


def test_shard_stride_plan_has_no_global_window(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("id"), F.col("id").alias("pos"))
    # the ordered rows are written once; ranks and counts come from there
    assert "rangepartitioning" in formatted(R.locally_numbered(df, "id", "pos", "n")).lower()
    plan = formatted(R.shard_stride(df, "id", "pos", 4, 1))
    # the only single-partition step is the window over per-partition counts
    assert plan.count("Window") <= 2


def test_shard_stride_many_files(spark, tmp_path):
    """Exact ranks of more rows than a range partitioning samples, with
    further columns, and separate shard runs that cover every row once."""
    n = 200_000
    df = spark.range(0, n, 1, 16).select((F.col("id") * 7919 % n).alias("id"), F.col("id").alias("pos"), F.repeat(F.lit("x"), 20).alias("payload"))
    df.write.parquet(f"{tmp_path}/in")
    df = spark.read.parquet(f"{tmp_path}/in")
    ranked = R.shard_stride(df, "id", "pos", 4, partitions=13)
    want = {s: i for i, s in enumerate(sorted((str(i * 7919 % n), i) for i in range(n)))}
    rows = ranked.select("id", "pos", "rank").toPandas()
    assert [want[(str(i), p)] for i, p in zip(rows["id"], rows["pos"])] == rows["rank"].tolist()
    seen = [r.pos for k in range(4) for r in R.shard_stride(df, "id", "pos", 4, k, partitions=13 - k).select("pos").collect()]
    assert sorted(seen) == list(range(n))


def test_intake_is_json_loads(spark):
    import json

    lines = [
        "{'id': 'a', 'prompt': 'b'}", '{"id": "a\tb", "prompt": "p"}', '{"id": "a", "prompt": "x	y"}', '{"id": NaN, "prompt": "p"}',
        '{"id": "1", "prompt": "p", "n": -Infinity}', '{"id": "1", "prompt": "p"} x', '{"id": "1", "prompt": "p"}}', '[], "x": 1', '1', '"s"', 'null',
        ' {"id": "1", "prompt": "p"} ', '{"id": "1", "prompt": "p",}', '{"id": 01, "prompt": "p"}', '{id: 1, "prompt": "p"}', '{"id": "1", "prompt": "p"} // c',
        '{"id": "\x41", "prompt": "p"}', '\u00a0{"id": "1", "prompt": "p"}'.encode().decode("unicode_escape"), '{"id": {"a": 1}, "prompt": [1]}', '{"id": null, "prompt": null}', "{", "}",
    ]
    df = spark.createDataFrame(list(enumerate(lines)), "pos int, value string")
    for r in R.intake_lines(df, keep=("pos",)).collect():
        try:
            v = json.loads(lines[r.pos])
            want = "OK" if isinstance(v, dict) and "id" in v and "prompt" in v else "MISSING_KEY"
        except ValueError:
            want = "MALFORMED"
        assert r.status == want, lines[r.pos]
        assert r.status != "OK" or r.has_null or r.id is not None


def test_intake_nested_schema_and_types(spark):
    schema = "id decimal(20,2), prompt struct<a:int,b:array<string>>"
    lines = ['{"id": 1.25, "prompt": {"a": 1, "b": ["x"]}}', '{"id": "no", "prompt": {"a": 1}}', '{"id": null, "prompt": {"a": 1}}']
    df = spark.createDataFrame(list(enumerate(lines)), "pos int, value string")
    got = {r.pos: r for r in R.intake_lines(df, value_schema=schema, keep=("pos",)).collect()}
    assert [got[i].status for i in range(3)] == ["OK", "MISTYPED", "OK"]
    assert str(got[0].id) == "1.25" and got[0].prompt.b == ["x"] and got[2].has_null and not got[0].has_null


def test_prompt_intake_file_order(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": "a0", "prompt": "p"}\n\n{"id": "a2", "prompt": "p"}\n')
    (tmp_path / "b.jsonl").write_text("".join(f'{{"id": "b{i}", "prompt": "{"x" * 50}"}}\n' for i in range(5000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        good, bad = R.prompt_intake(spark, str(tmp_path))
        got = {r.id: r.pos for r in good.collect()}
        assert got == {"a0": 0, "a2": 2} | {f"b{i}": 3 + i for i in range(5000)}
        assert [(r.pos, r.status) for r in bad.collect()] == [(1, "BLANK")]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_ledger_statuses(spark, tmp_path):
    from atelier.sources import scans, sinks

    path = f"{tmp_path}/ledger"
    prompts = spark.createDataFrame([(str(i), i) for i in range(5)], "id string, pos bigint")
    assert R.resume_pending(prompts, scans.read_ledger(spark, path)).count() == 5
    sinks.write_ledger(prompts.filter("pos = 1"), path, "z-first")
    sinks.write_ledger(prompts.filter("pos in (2, 3)").withColumn("stage", F.lit("plan")), path, "z-first", "failure")
    sinks.write_ledger(prompts.filter("pos = 2"), path, "a-second")
    sinks.write_ledger(prompts.filter("pos = 4").withColumn("stage", F.lit("html")), path, "a-second", "failure")
    ledger = scans.read_ledger(spark, path)
    assert sorted(r.id for r in R.resume_pending(prompts, ledger).collect()) == ["0", "3", "4"]
    assert [r.id for r in R.current_failures(ledger).collect()] == ["4"]
    assert {(r.id, r.pos, r.stage) for r in ledger.filter("status = 'failure'").collect()} == {("2", 2, "plan"), ("3", 3, "plan"), ("4", 4, "html")}


def py_duplicates(attempts):
    """Replay of the sequential loop with success/failure ledgers."""
    success, failed, runs = set(), set(), {}
    for i, ok in attempts:
        if i in success:
            continue
        runs[i] = runs.get(i, 0) + 1
        if not ok:
            failed.add(i)
        elif i not in failed:
            success.add(i)
    return {i: (i in success, runs[i]) for i in runs}


def test_duplicate_id_policy(spark):
    attempts = [("okok", True), ("okok", True), ("failok", False), ("failok", True), ("okfail", True), ("okfail", False),
                ("failfail", False), ("failfail", False), ("single", True)]
    df = spark.createDataFrame([(i, p, ok) for p, (i, ok) in enumerate(attempts)], "id string, pos int, ok boolean")
    got = {r.id: (r.ok, r.attempts) for r in R.duplicate_id_policy(df, "id", "pos", "ok").collect()}
    assert got == py_duplicates(attempts)


def test_last_good_round(spark):
    data = [("r1", 1, False), ("r1", 2, True), ("mid", 1, True), ("mid", 2, False), ("mid", 3, True),
            ("never", 1, True), ("never", 2, True)]
    df = spark.createDataFrame(data, "id string, round int, ok boolean").withColumn("path", F.concat(F.lit("refined_"), F.col("round").cast("string"), F.lit(".html")))
    got = {r.id: (r.good_rounds, r.all_ok, r.current_path) for r in R.last_good_round(df, "id", "round", "ok", "path", "after_image_refine.html").collect()}
    assert got == {
        "r1": (0, False, "after_image_refine.html"),
        "mid": (1, False, "refined_1.html"),
        "never": (2, True, "refined_2.html"),
    }


def test_stage_outcome_policies(spark):
    stages = [("plan", "a"), ("html", "b"), ("image_repair", "c"), ("layout_refine", "d")]
    rows = [(i, *[j != i for j in range(4)]) for i in range(4)] + [(9, True, True, True, True)]
    df = spark.createDataFrame(rows, "k int, a boolean, b boolean, c boolean, d boolean")
    strict = {r.k: (r.ok, r.failed_stage) for r in R.stage_outcome(df, stages, "strict").collect()}
    lenient = {r.k: (r.ok, r.failed_stage, r.warnings) for r in R.stage_outcome(df, stages, "lenient").collect()}
    assert strict == {0: (False, "plan"), 1: (False, "html"), 2: (False, "image_repair"), 3: (False, "layout_refine"), 9: (True, None)}
    assert lenient[2] == (True, None, "image_repair") and lenient[3] == (True, None, "layout_refine")
    assert lenient[0][:2] == (False, "plan")


def test_resume_and_promote(spark):
    prompts = spark.createDataFrame([(str(i), f"p{i}") for i in range(6)], "id string, prompt string")
    ledger = spark.createDataFrame([(" 1 ",), ("3",), ("",)], "id string")
    pending = sorted(r.id for r in R.resume_pending(prompts, ledger, "id").collect())
    assert pending == ["0", "2", "4", "5"]
    failed = spark.createDataFrame([("2",)], "id string")
    promoted = sorted(r.id for r in R.promote_success(prompts.select("id"), failed, "id").collect())
    assert promoted == ["0", "1", "3", "4", "5"]


def test_intake_parses_a_line_once(spark):
    """A filter on the status isn't pushed below the parses, where each of its
    terms would parse the line again."""
    lines = spark.createDataFrame([('{"id": "1", "prompt": "a"}',), (" ",), (None,), ('{"id": "2"}',), ("{",), ('{"id": 1, "prompt": null}',)], "value string")
    good = R.intake_lines(lines).filter("status = 'OK'").select("id", "prompt")
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 3, plan
    assert [tuple(r) for r in good.collect()] == [("1", "a"), ("1", None)]
