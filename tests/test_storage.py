"""Files and committed tables: copies, retries, split arrays, listings."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from atelier.operators import retrieve as RT
from atelier.sources import committed, scans, sinks, storage


def test_copies_and_retry(spark, tmp_path):
    lib, out = f"{tmp_path}/lib", f"{tmp_path}/out"
    names = [("a/b/x.png", b"x" * 10), ("y.png", b""), ("c/z z%.png", bytes(range(256)) * 50_000)]
    made = storage.write_files(spark.createDataFrame(names, "path string, content binary"), lib)
    assert {r.status for r in made.collect()} == {"COPIED"}
    hits = [("p1", 0, 1, "a/b/x.png"), ("p1", 1, 1, "y.png"), ("p1", 2, 2, "gone.png"), ("p2", 0, 1, "c/z z%.png"), ("p3", 0, 1, None)]
    manifest = RT.copy_manifest(spark.createDataFrame(hits, "id string, pos int, layer_id bigint, src string"), "id", "pos")

    def run():
        return {(r.id, r.dst[-5]): (r.status, r.n_bytes) for r in storage.copy_files(manifest, lib, out).collect()}

    assert run() == {("p1", "1"): ("COPIED", 0), ("p1", "2"): ("MISSING", None), ("p2", "1"): ("COPIED", 12_800_000), ("p3", "1"): ("MISSING", None)}
    assert open(f"{out}/p2/generated_images/layer1.png", "rb").read() == names[2][1]
    # what a cut run left behind: one file gone, one source there now
    os.remove(f"{out}/p2/generated_images/layer1.png")
    open(f"{lib}/gone.png", "wb").write(b"back")
    assert run() == {("p1", "1"): ("EXISTS", 0), ("p1", "2"): ("COPIED", 4), ("p2", "1"): ("COPIED", 12_800_000), ("p3", "1"): ("MISSING", None)}
    assert not [f for _, _, files in os.walk(out) for f in files if f.startswith(".")]
    # a destination that can't be a file is that row's fault
    os.makedirs(f"{out}/p4/generated_images/layer1.png")
    bad = spark.createDataFrame([("p4", "generated_images/layer1.png", "y.png")], "id string, dst string, src string")
    assert storage.copy_files(bad, lib, out).first().status == "FAILED"


def test_listing_in_tasks(spark, tmp_path):
    for i in range(40):
        os.makedirs(f"{tmp_path}/lib/{i % 7}/{i % 3}", exist_ok=True)
        open(f"{tmp_path}/lib/{i % 7}/{i % 3}/e{i}.png", "w").write("x" * i)
    open(f"{tmp_path}/lib/top.x.png", "w").close()
    open(f"{tmp_path}/lib/note.txt", "w").close()
    open(f"{tmp_path}/lib/.hidden.png", "w").close()
    for root in (f"{tmp_path}/lib", f"file://{tmp_path}/lib"):
        got = {r.elem_id: r.path for r in scans.library_scan(spark, root).collect()}
        assert set(got) == {f"e{i}" for i in range(40)} | {"top.x"}
        assert got["e5"].endswith("/lib/5/2/e5.png") and spark.read.format("binaryFile").load(got["e5"]).first().length == 5
    assert {r["size"] for r in storage.list_files(spark, f"{tmp_path}/lib").filter("path like '%/e%'").collect()} == set(range(40))
    with pytest.raises(FileNotFoundError):
        storage.list_files(spark, f"{tmp_path}/none")


def test_id_map_in_ranges(spark, tmp_path):
    rnd = random.Random(1)
    bits = ["a", "é😀", '"', "\\", ",", "[", "]", "{", "}", "\n", " ", "\\\\", '\\"', "x" * 70]
    ids = [rnd.choice([None, 5, -1.5, True]) if rnd.random() < 0.1 else "".join(rnd.choice(bits) for _ in range(rnd.randrange(6))) for _ in range(300)]
    want = [(i, v if v is None or isinstance(v, str) else json.dumps(v)) for i, v in enumerate(ids)]
    path = f"{tmp_path}/map.json"
    for text in (json.dumps(ids), json.dumps(ids, indent=2, ensure_ascii=False), " \n" + json.dumps(ids, separators=(",", ":"))):
        open(path, "w", encoding="utf-8").write(text)
        for split in (37, 1000, 1 << 20):
            df = scans.id_map_scan(spark, path, split)
            assert sorted((r.pos, r.elem_id) for r in df.collect()) == want, split
    assert scans.id_map_scan(spark, path, 1000).rdd.getNumPartitions() > 4
    for text, rows in (("[]", 0), ('["a"]', 1)):
        open(path, "w").write(text)
        assert scans.id_map_scan(spark, path).count() == rows
    for text in ('["a", ["b"]]', '[{"a": 1}]', '["a'):
        open(path, "w").write(text)
        with pytest.raises(Exception, match="flat array|broken JSON"):
            scans.id_map_scan(spark, path).collect()


def test_ledger_commits_once(spark, tmp_path):
    path, flag = f"{tmp_path}/ledger", f"{tmp_path}/fail"
    open(flag, "w").close()

    @F.udf("string")
    def fragile(i):
        if i == 73 and os.path.exists(flag):
            raise RuntimeError("lost")
        return str(i)

    ids = spark.range(100).repartition(5).select(fragile("id").alias("id"))
    with pytest.raises(Exception, match="lost"):
        sinks.write_ledger(ids, path, run_id="r 1/x")
    assert scans.read_ledger(spark, path).count() == 0
    os.remove(flag)
    for _ in range(2):  # the job run again, and once more after it was done
        sinks.write_ledger(ids, path, run_id="r 1/x")
        got = scans.read_ledger(spark, path)
        assert got.count() == 100 and {r.run_id for r in got.select("run_id").distinct().collect()} == {"r 1/x"}
    sinks.write_ledger(ids.filter("id < '2'"), path, run_id="r 1/x", key="html")
    sinks.write_ledger(ids.filter("id < '0'"), path, run_id="none")  # no rows: a commit without files
    sinks.write_ledger(ids, path, status="failure")
    log = {r.run: r.n_rows for r in committed.commits(spark, path).filter("run is not null").collect()}
    assert sorted(log.values()) == [0, 12, 100, 100] and scans.read_ledger(spark, path).count() == 212


def test_stream_sink_commits_each_batch_once(spark, tmp_path):
    spark.dataSource.register(committed.CommittedTable)
    os.makedirs(f"{tmp_path}/in")

    def run(name, checkpoint):
        q = spark.readStream.schema("id string").json(f"{tmp_path}/in").writeStream.format("committed")
        q = q.option("path", f"{tmp_path}/t").option("key", "s").option("checkpointLocation", f"{tmp_path}/{checkpoint}").trigger(availableNow=True).start()
        q.awaitTermination()

    open(f"{tmp_path}/in/a.json", "w").write('{"id": "1"}\n{"id": "2"}\n')
    run("a", "c")
    open(f"{tmp_path}/in/b.json", "w").write('{"id": "3"}\n')
    run("b", "c")
    assert sorted(r.id for r in committed.read_committed(spark, f"{tmp_path}/t", "id string").collect()) == ["1", "2", "3"]
    run("a", "fresh")  # a checkpoint that was lost: the batch of that number is not added again
    assert committed.read_committed(spark, f"{tmp_path}/t", "id string").count() == 3


def test_artifacts_under_a_key(spark, tmp_path):
    df = spark.createDataFrame([("a", "p1"), ("b", None)], "id string, path string")
    for _ in range(2):
        sinks.write_artifacts(df, f"{tmp_path}/art", "init", key="run1")
    sinks.write_artifacts(df, f"{tmp_path}/art", "init", 1, key="run1")
    got = scans.read_artifacts(spark, f"{tmp_path}/art").collect()
    assert sorted((r.id, r.round, r.stage, r.ok) for r in got) == [("a", 0, "init", True), ("a", 1, "init", True), ("b", 0, "init", True), ("b", 1, "init", True)]
