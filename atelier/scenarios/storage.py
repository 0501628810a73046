"""Keys of scans and sinks: tables are written as the files that a job finds
(stand-in input), the library's scan, copy or sink runs on them, and what it
returns or leaves in storage is compared."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from atelier.operators import retrieve as RT
from atelier.operators.files import render_ready_files as ready_files
from atelier.scenarios import scenario
from atelier.scenarios.text import _TOKEN, _container_sql
from atelier.session import scratch_path, table
from atelier.sources import scans, sinks
from atelier.sources.storage import copy_files as copy
from atelier.sources.storage import list_files, write_files
from atelier.streaming.intake import stream_intake


def _root(spark, what):
    return scratch_path(spark, f"{what}-{uuid.uuid4().hex}")


def _folder():
    return F.concat(F.lit("site"), (F.col("page_id") % 16).cast("string"))


def _page_files(spark, d, suffix: str = ".png"):
    """Each page as a file, a folder for every 16th; pages divisible by 5 have none."""
    root = _root(spark, "pages")
    pages = table(spark, d, "pages").filter("page_id % 5 != 0")
    named = pages.select(F.concat(_folder(), F.lit("/page"), F.col("page_id").cast("string"), F.lit(suffix)).alias("path"), "html")
    write_files(named, root, "path", "html")
    return root


@scenario(
    "copy_files",
    """
SELECT 'site' || CAST(page_id % 16 AS VARCHAR) AS id, 'generated_images/layer' || CAST(page_id AS VARCHAR) || '.png' AS dst,
  CASE WHEN page_id % 5 = 0 THEN 'MISSING' ELSE 'COPIED' END AS status, CASE WHEN page_id % 5 = 0 THEN 'MISSING' ELSE 'EXISTS' END AS again,
  CASE WHEN page_id % 5 != 0 THEN octet_length(encode(html)) END AS n_bytes, CASE WHEN page_id % 5 != 0 THEN sha256(html) END AS sha256
FROM pages
""",
)
def copy_files(spark, d):
    """The retrieved files of every example copied, the copy run again, and the
    destination's bytes read back."""
    library, out = _page_files(spark, d), _root(spark, "copies")
    hits = table(spark, d, "pages").select(_folder().alias("id"), F.col("page_id").alias("layer_id"), F.concat(_folder(), F.lit("/page"), F.col("page_id").cast("string"), F.lit(".png")).alias("src"))
    manifest = RT.copy_manifest(hits.withColumn("pos", F.col("layer_id")), "id", "pos", "layer_id", "src")
    first, again = copy(manifest, library, out), copy(manifest, library, out)
    there = scans.image_bytes_scan(spark, out).select(F.regexp_extract("path", "[^/]+/generated_images/[^/]+$", 0).alias("rel"), F.sha2("content", 256).alias("bytes"), F.length("content").cast("bigint").alias("n_bytes"))
    both = first.select("id", "dst", "status").join(again.select("id", "dst", F.col("status").alias("again")), ["id", "dst"])
    both = both.join(there, F.concat("id", F.lit("/"), "dst") == F.col("rel"), "left")
    return both.select("id", "dst", "status", "again", "n_bytes", F.col("bytes").alias("sha256"))


@scenario("render_ready_files", f"SELECT page_id, page_id % 5 != 0 AND {_container_sql(_TOKEN)} AS ready FROM (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN replace(html, 'class=\"ad\"', '') ELSE html END AS html FROM pages)")
def render_ready_files(spark, d):
    """Pages with the container whose file is there; every third has lost it."""
    root = _page_files(spark, d, ".html")
    rel = F.regexp_extract("path", "[^/]+/[^/]+$", 0)
    files = list_files(spark, root).select(rel.alias("path"))
    html = F.when(F.col("page_id") % 3 == 0, F.replace("html", F.lit('class="ad"'), F.lit(""))).otherwise(F.col("html"))
    pages = table(spark, d, "pages").select("page_id", html.alias("html"), F.concat(_folder(), F.lit("/page"), F.col("page_id").cast("string"), F.lit(".html")).alias("path"))
    return ready_files(pages, "html", "path", files, _TOKEN).select("page_id", "ready")


@scenario("library_scan", "SELECT 'page' || CAST(page_id AS VARCHAR) AS elem_id, 'site' || CAST(page_id % 16 AS VARCHAR) AS folder FROM pages WHERE page_id % 5 != 0")
def library_scan(spark, d):
    found = scans.library_scan(spark, _page_files(spark, d))
    return found.select("elem_id", F.element_at(F.split("path", "/"), -2).alias("folder"))


@scenario("image_bytes_scan", "SELECT 'page' || CAST(page_id AS VARCHAR) || '.png' AS name, sha256(html) AS sha256 FROM pages WHERE page_id % 5 != 0")
def image_bytes_scan(spark, d):
    found = scans.image_bytes_scan(spark, _page_files(spark, d))
    return found.select(F.substring_index("path", "/", -1).alias("name"), F.sha2("content", 256).alias("sha256"))


@scenario("artifact_scan", "SELECT 'page' || CAST(page_id AS VARCHAR) || '.html' AS name, length(html) AS n_chars, md5(html) AS md5 FROM pages WHERE page_id % 5 != 0")
def artifact_scan(spark, d):
    found = scans.artifact_scan(spark, _page_files(spark, d, ".html"))
    return found.select(F.substring_index("path", "/", -1).alias("name"), F.length("text").cast("bigint").alias("n_chars"), F.md5("text").alias("md5"))


@scenario(
    "id_map_scan",
    """
SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS pos,
  CASE WHEN p_size <= 45 THEN p_name || ', "' || p_brand || '\\' || CAST(p_partkey AS VARCHAR) END AS elem_id
FROM part
""",
)
def id_map_scan(spark, d):
    """One JSON array with quotation marks, commas and backslashes in its
    strings, scanned in ranges of 32 KiB."""
    root = _root(spark, "map")
    p = table(spark, d, "part")
    name = F.concat("p_name", F.lit(', "'), "p_brand", F.lit("\\"), F.col("p_partkey").cast("string"))
    one = F.to_json(F.array(name))
    text = F.when(F.col("p_size") <= 45, F.substring(one, 2, 1 << 20).substr(F.lit(1), F.length(one) - 2)).otherwise("null")
    first, last = p.agg(F.min("p_partkey"), F.max("p_partkey")).first()
    lines = p.select("p_partkey", F.concat(F.when(F.col("p_partkey") == first, "[").otherwise(","), text, F.when(F.col("p_partkey") == last, "]").otherwise("")).alias("value"))
    lines.coalesce(1).sortWithinPartitions("p_partkey").select("value").write.text(root)
    path = spark.read.text(root).select("_metadata.file_path").first()[0]
    return scans.id_map_scan(spark, path, 1 << 15)


@scenario(
    "training_scan",
    """
SELECT p_name AS prompt, p_brand AS layout_thought, CASE WHEN p_size <= 45 THEN p_type END AS grouping,
  'a' || chr(10) || CAST(p_size AS VARCHAR) AS image_generator, '"' || p_brand || '"' AS generate_text FROM part
""",
)
def training_scan(spark, d):
    root = _root(spark, "train")
    p = table(spark, d, "part")
    fields = [
        F.col("p_name").alias("prompt"), F.col("p_brand").alias("layout_thought"), F.when(F.col("p_size") <= 45, F.col("p_type")).alias("grouping"),
        F.concat(F.lit("a\n"), F.col("p_size").cast("string")).alias("image_generator"), F.concat(F.lit('"'), "p_brand", F.lit('"')).alias("generate_text"), F.lit(1).alias("other"),
    ]
    p.select(*fields).write.json(root)
    return scans.training_scan(spark, root)


@scenario("vector_scan", "SELECT vec_id AS pos, len(embedding) AS dim, round(CAST(embedding[1] AS DOUBLE), 6) AS first, round(CAST(embedding[64] AS DOUBLE), 6) AS last FROM embeddings")
def vector_scan(spark, d):
    root = _root(spark, "vectors")
    table(spark, d, "embeddings").select(F.col("vec_id").cast("int").alias("n"), F.col("embedding").cast("array<double>").alias("v")).write.parquet(root)
    got = scans.vector_scan(spark, root, "n", "v")
    return got.select("pos", F.size("embedding").cast("bigint").alias("dim"), *[F.round(F.col("embedding")[i].cast("double"), 6).alias(n) for i, n in ((0, "first"), (63, "last"))])


@scenario("ledger_scan", "SELECT DISTINCT CAST(user_id AS VARCHAR) AS id FROM events")
def ledger_scan(spark, d):
    root = _root(spark, "lines")
    e = table(spark, d, "events")
    e.select(F.when(F.col("event_id") % 7 == 0, "  ").otherwise(F.concat(F.lit(" "), F.col("user_id").cast("string"), F.lit("\t"))).alias("value")).write.text(root)
    e.select(F.col("user_id").cast("string").alias("value")).write.mode("append").text(root)
    return scans.ledger_scan(spark, root)


@scenario(
    "write_ledger",
    """
SELECT CAST(event_id AS VARCHAR) AS id, event_id AS pos, 'success' AS status, NULL AS stage, 'run 1' AS run_id FROM events WHERE event_type <> 'error'
UNION ALL SELECT CAST(event_id AS VARCHAR), NULL, 'failure', 'html', 'run 2' FROM events WHERE event_type = 'error'
""",
)
def write_ledger(spark, d):
    """Each run's rows once, although both jobs run twice."""
    root = _root(spark, "ledger")
    e = table(spark, d, "events")
    for _ in range(2):
        sinks.write_ledger(e.filter("event_type <> 'error'").select(F.col("event_id").alias("id"), F.col("event_id").alias("pos")), root, "run 1")
        sinks.write_ledger(e.filter("event_type = 'error'").select(F.col("event_id").alias("id"), F.lit("html").alias("stage")), root, "run 2", "failure")
    return scans.read_ledger(spark, root).select("id", "pos", "status", "stage", "run_id")


@scenario(
    "write_artifacts",
    """
SELECT 'p' || CAST(p_partkey AS VARCHAR) AS id, 0 AS round, p_name AS path, true AS ok, 'init' AS stage FROM part
UNION ALL SELECT 'p' || CAST(p_partkey AS VARCHAR), 1, NULL, p_size <= 45, 'after layout' FROM part
""",
)
def write_artifacts(spark, d):
    """The lineage of two stages, each written twice under one key."""
    root = _root(spark, "artifacts")
    p = table(spark, d, "part").select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("id"), F.col("p_name").alias("path"), "p_size")
    for _ in range(2):
        sinks.write_artifacts(p.select("id", "path"), root, "init", key="run")
        sinks.write_artifacts(p.select("id", (F.col("p_size") <= 45).alias("ok")), root, "after layout", 1, key="run")
    return scans.read_artifacts(spark, root).select("id", "round", "path", "ok", "stage")


@scenario("write_layout_prompts", "SELECT CAST(doc_id AS VARCHAR) AS id, doc_id % 4 AS shard, md5(coalesce(text, '')) AS md5 FROM documents")
def write_layout_prompts(spark, d):
    root = _root(spark, "prompts")
    docs = table(spark, d, "documents")
    sinks.write_layout_prompts(docs.select(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("layout_prompt"), (F.col("doc_id") % 4).alias("shard")), root)
    return spark.read.parquet(root).select("id", F.col("shard").cast("bigint"), F.md5(F.coalesce("layout_prompt", F.lit(""))).alias("md5"))


@scenario(
    "write_repair_summary",
    """
SELECT CAST(l_orderkey AS VARCHAR) AS id, count(*) FILTER (l_returnflag = 'R') AS n_refined, round(count(*) FILTER (l_returnflag = 'R') / count(*), 6) AS refine_rate
FROM lineitem GROUP BY l_orderkey HAVING count(*) FILTER (l_returnflag = 'R') > 0
""",
)
def write_repair_summary(spark, d):
    root = _root(spark, "summary")
    bad = F.col("l_returnflag") == "R"
    per = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").cast("string").alias("id"))
    # an order has a few lines
    rows = per.agg(F.collect_list(F.when(bad, F.col("l_linenumber"))).alias("refined_layers"), (F.count_if(bad) / F.count("*")).alias("refine_rate"))
    sinks.write_repair_summary(rows, root)
    got = spark.read.schema("id string, refined_layers array<int>, refine_rate double").json(root)
    return got.select("id", F.size("refined_layers").cast("bigint").alias("n_refined"), F.round("refine_rate", 6).alias("refine_rate"))


@scenario(
    "stream_ledger",
    """
WITH u AS (SELECT DISTINCT user_id AS u FROM events),
k AS (SELECT u, u % 3 = 0 AS done, u % 3 = 1 AND u % 2 = 0 AS good, u % 3 = 1 AND u % 2 = 1 AS bad FROM u)
SELECT CAST(u AS VARCHAR) AS id, CASE WHEN done THEN 0 WHEN bad THEN 2 ELSE 1 END AS n_pending,
  CASE WHEN done OR good THEN 1 ELSE 0 END AS n_success, CASE WHEN bad THEN 1 ELSE 0 END AS n_failure FROM k
""",
)
def stream_ledger(spark, d):
    """Two runs of the stream over the same ids: between them some of those in
    work succeed and some fail, and only these are taken again."""
    root = _root(spark, "stream")
    users = table(spark, d, "events").select(F.col("user_id").alias("u")).distinct()
    lines = table(spark, d, "events").select(F.to_json(F.struct(F.col("user_id").cast("string").alias("id"), F.col("event_type").alias("prompt"))).alias("value"))
    ids = lambda condition: users.filter(condition).select(F.col("u").cast("string").alias("id"))
    sinks.write_ledger(ids("u % 3 = 0"), f"{root}/ledger", "before")
    for _ in range(2):
        lines.write.mode("append").text(f"{root}/in")
        stream_intake(spark, f"{root}/in", f"{root}/ledger", f"{root}/sink", f"{root}/ckpt").awaitTermination()
        sinks.write_ledger(ids("u % 3 = 1 and u % 2 = 0"), f"{root}/ledger", "work")
        sinks.write_ledger(ids("u % 3 = 1 and u % 2 = 1"), f"{root}/ledger", "work", "failure", key="failed")
    counts = [F.count_if(F.col("status") == s).alias(f"n_{s}") for s in ("pending", "success", "failure")]
    return scans.read_ledger(spark, f"{root}/ledger").groupBy("id").agg(*counts)
