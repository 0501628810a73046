"""Tag, strip, strict JSON and verdict parsing against plain-Python oracles."""

import base64
import json
import os
import random
import re

from pyspark.sql import functions as F

from atelier.functions import chat as CH
from atelier.functions import jsonparse as J
from atelier.functions import text as T

WHITESPACE = [chr(c) for c in range(0x3001) if chr(c).isspace()]


def py_extract(s, tag):
    m = re.search(rf"<{tag}>(.*?)</{tag}>", s, re.DOTALL)
    return (False, None) if not m else (True, m.group(1).strip())


def py_parse_layers(s):
    ok, body = py_extract(s, "image_generator")
    if not ok:
        return "TAG_MISSING"
    try:
        v = json.loads(body)
    except Exception:
        return "JSON_INVALID"
    if not isinstance(v, list) or not all(isinstance(x, dict) and isinstance(x.get("layer_id"), int) and not isinstance(x.get("layer_id"), bool) and isinstance(x.get("layer_prompt"), str) for x in v):
        return "SCHEMA_MISMATCH"
    return "OK"


def test_strip_matches_python(spark):
    rnd = random.Random(42)
    alphabet = WHITESPACE + list("ab é​-")
    samples = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 12))) for _ in range(400)]
    samples += [" x　", "\x1c\x1dy\x1e\x1f", "\t\n z \r\x0b\x0c"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(samples)], "i int, s string")
    got = {r.i: r.t for r in df.select("i", T.strip("s").alias("t")).collect()}
    for i, s in enumerate(samples):
        assert got[i] == s.strip(), repr(s)


def test_extract_tag_edges(spark):
    cases = [
        "no tag here",
        "<image_generator></image_generator>",
        "<image_generator> [1] </image_generator> <image_generator>[2]</image_generator>",
        "<image_generator>\n[\n1\n]\n</image_generator>",
        "<image_generator>[1]",
        "<image_generator_result>[9]</image_generator_result>",
        "<image_generator_result>[9]</image_generator_result><image_generator>[3]</image_generator>",
        "<user_input>\n<image_generator>[0]</image_generator>\n</user_input>\n<image_generator>[1]</image_generator>",
    ]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(cases)], "i int, s string")
    out = {r.i: (r.t.present, r.t.body) for r in df.select("i", T.extract_tag("s", "image_generator").alias("t")).collect()}
    for i, s in enumerate(cases):
        assert out[i] == py_extract(s, "image_generator"), s


def test_parse_layers_edges(spark):
    bodies = [
        '[{"layer_id": 0, "layer_prompt": "a"}]',
        "[]",
        '[{"layer_id": 0, "layer_prompt": "a"}] junk',
        '[{"layer_id": 0, "layer_prompt": "a"}]}',
        '[{"layer_id": 0, "layer_prompt": "a"},]',
        '{"layer_id": 0, "layer_prompt": "a"}',
        "null",
        "[1, 2]",
        '[{"layer_id": "0", "layer_prompt": "a"}]',
        '[{"layer_id": 0}]',
        '[{"layer_id": 0, "layer_prompt": "a", "layer_prompt": "b"}]',
        '[], "x": 1',
        "",
        "'single'",
    ]
    texts = [f"<image_generator>{b}</image_generator>" for b in bodies] + ["missing"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(texts)], "i int, s string")
    out = {r.i: r.p for r in df.select("i", J.parse_layers(F.col("s")).alias("p")).collect()}
    for i, s in enumerate(texts):
        assert out[i].status == py_parse_layers(s), s
    # duplicate key: the last value wins, as in Python
    assert out[10]["items"][0]["layer_prompt"] == "b"
    assert out[1]["items"] == []


def test_extract_verdict_edges(spark):
    texts = [
        'Sure: {"bad_layers": [1, 2], "reason": {"1": "blurry"}} thanks',
        '{"bad_layers": [3]} }',
        '{"bad_layers": [1]} and {"bad_layers": [2]}',
        "no braces",
        '{"reason": {"1": "x"}}',
        '{"bad_layers": null}',
        '{"bad_layers": [4], "reason": {"4": "has {nested} braces"}}',
    ]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(texts)], "i int, s string")
    out = {r.i: r.v for r in df.select("i", J.extract_verdict(F.col("s")).alias("v")).collect()}

    def py(s):
        m = re.search(r"\{.*\}", s, re.DOTALL)
        if not m:
            return "NO_JSON", None
        try:
            v = json.loads(m.group(0))
        except Exception:
            return "JSON_INVALID", None
        return "OK", list(v.get("bad_layers") or [])

    for i, s in enumerate(texts):
        st, bad = py(s)
        assert out[i].status == st, s
        if st == "OK":
            assert list(out[i].bad_layers) == bad
    assert out[6].reason == {"4": "has {nested} braces"}


def test_bool_verdict(spark):
    vals = [" True\n", "true.", "FALSE", " TRUE　", "truE", None, ""]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r.b for r in df.select(T.bool_verdict("s").alias("b")).collect()]
    assert got == [(v or "").strip().lower() == "true" for v in vals]


def test_artifact_path_matches_splitext(spark):
    paths = ["a.b/c", ".hidden", "x..png", "a/b.c.html", "noext", "dir/.rc", "a/b/", "..", "a.", "x/y.tar.gz", "/abs/p.html", "a..b..c"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    got = [(r.root, r.ext, r.png) for r in df.select(T.path_root("p").alias("root"), T.path_extension("p").alias("ext"), T.artifact_path("p").alias("png")).collect()]
    for p, (root, ext, png) in zip(paths, got):
        assert (root, ext) == os.path.splitext(p), p
        assert png == os.path.splitext(p)[0] + ".png"


def test_data_url_and_back(spark):
    blobs = [bytes(range(256)) * 3, b"", "héllo".encode()]
    df = spark.createDataFrame([(b,) for b in blobs], "c binary")
    got = df.select(T.data_url("c").alias("u"), T.unbase64_payload(T.data_url("c")).alias("back")).collect()
    for b, r in zip(blobs, got):
        assert r.u == "data:image/png;base64," + base64.b64encode(b).decode()
        assert "\r" not in r.u and "\n" not in r.u
        assert bytes(r.back) == b


def test_manifest_json_matches_json_dumps(spark):
    items = [(0, "generated_images/layer0.png"), (3, 'q"uote\\back/é'), (3, "dup\nline")]
    df = spark.createDataFrame([(1, i, lid, u) for i, (lid, u) in enumerate(items)], "id int, pos int, layer_id bigint, url string")
    from atelier.operators.retrieve import layer_manifest

    got = layer_manifest(df, "id", "pos", "layer_id", url="url").collect()[0].manifest
    want = json.dumps([{"layer_id": lid, "url": u} for lid, u in items], ensure_ascii=False, separators=(", ", ": "))
    assert got == want


def test_chat_render_chatml(spark):
    df = spark.createDataFrame([("sys", "hi"), ("s2", None)], "s string, u string")
    got = [r.r for r in df.select(CH.chat_render(CH.chat_messages(F.col("s"), "u")).alias("r")).collect()]
    assert got[0] == "<|im_start|>system\nsys<|im_end|>\n<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\n"
    assert got[1] is None


def test_verdict_takes_any_reason(spark):
    from pyspark.sql import functions as F

    from atelier.functions.jsonparse import extract_verdict

    texts = ['x {"bad_layers": [1], "reason": {"1": "blurred"}} y', '{"reason": "all fine"}', '{"bad_layers": [], "reason": ["a", 1]}', '{"reason": null}', '{"bad_layers": [NaN]}', '{"n": NaN}']
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r.v for r in df.select("i", extract_verdict(F.col("t")).alias("v")).collect()}
    assert [got[i].status for i in (0, 1, 2, 3, 5)] == ["OK"] * 5
    assert got[0].reason == {"1": "blurred"} and got[0].bad_layers == [1]
    assert got[1].reason_json == "all fine" and got[1].reason == {} and got[2].reason_json == '["a",1]' and got[3].reason_json is None
