"""Thin queries over the driver's tables, one per operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from atelier.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per document and benchmark item found in it."""
    from atelier.llm.decontaminate import decontaminate

    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    per_item = "aggregate(filter(hits, h -> h.item <=> item), cast(null as bigint), (a, h) -> coalesce({f}(a, h.{c}), h.{c}))"
    return found.filter("size(hits) > 0").selectExpr("doc_id", "hits", "explode(array_distinct(hits.item)) as item").selectExpr(
        "doc_id", "item as item_id", per_item.format(f="least", c="start") + " as start", per_item.format(f="greatest", c="end") + " as end",
        "aggregate(filter(hits, h -> h.item <=> item), 0L, (a, h) -> a + h.probes) as n_probes",
        "aggregate(filter(hits, h -> h.item <=> item), 0L, (a, h) -> a + h.edits) as edits",
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from atelier.llm.common import labelled_sample
    from atelier.llm.toxicity import SAMPLE_ROWS, TOXIC_AT, classify_toxicity

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    labels = table(spark, sf_dir, "labels").filter(~held_out)
    labelled, counts = labelled_sample(docs, labels, "doc_id", "toxic", [0, 1], SAMPLE_ROWS)
    scored = classify_toxicity(docs, labelled, counts=counts)
    return scored.select("doc_id", held_out.alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= TOXIC_AT).cast("int").alias("predicted"))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from atelier.llm.personal_data import BASE, KINDS, find_personal_data, named_spans

    found = find_personal_data(table(spark, sf_dir, "documents"))
    counts = [F.size(f"found.{k.name}").cast("long").alias(f"n_{k.name}") for k in BASE]
    return found.select(
        "doc_id", *counts, F.sha2(named_spans("found", BASE), 256).alias("base_sha256"), named_spans("found", KINDS).alias("spans"), named_spans("found", KINDS, True).alias("scores"),
        sum((F.size(f"found.{k.name}") for k in KINDS), F.lit(0)).cast("long").alias("n_found"),
    )


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from atelier.llm.mixing import mix_report

    return mix_report(table(spark, sf_dir, "documents"))


def op5_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per repeated passage and document, first copies included."""
    from pyspark.sql import functions as F

    from atelier.llm.substring_dedup import repeated_passages

    rows = table(spark, sf_dir, "documents").select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").alias("key"), "text")
    return repeated_passages(rows).select(F.col("key").alias("doc_id"), "start", "end", "n_words", "first")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from atelier.llm.url_filter import filter_urls

    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages).select("page_id", "filter.host", "filter.path", "filter.rule", "filter.verdict", "filter.score")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from atelier.llm.common import shared_dir
    from atelier.llm.token_files import read_token_files, write_token_files

    manifest = write_token_files(table(spark, sf_dir, "documents"), shared_dir(spark, "tokens"), public_tokenizers.path("word_bpe_49k.json"))
    return read_token_files(manifest)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from atelier.llm.quality_rules import quality_rules

    return quality_rules(table(spark, sf_dir, "documents")).selectExpr(
        "doc_id", "rules.n_words", "rules.word_chars", "rules.n_symbols", "rules.n_dup_lines", "rules.n_repeat_words",
        "rules.base_failed", "rules.kept", "rules.class_distance", "rules.word_distance",
    )


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from atelier.llm.near_dedup import near_dedup

    return near_dedup(table(spark, sf_dir, "documents"), size=2).select("doc_id", "n_shingles", "component_id", "kept")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings 0 to 2 from the labels: low quality, good but toxic, good."""
    from pyspark.sql import functions as F

    from atelier.llm.common import labelled_sample
    from atelier.llm.quality_classifier import SAMPLE_ROWS, grade_quality

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
    labels = labels.withColumn("rating", F.when(F.col("quality") == 0, 0).otherwise(F.when(F.col("toxic") == 1, 1).otherwise(2)))
    rated, counts = labelled_sample(docs, labels, "doc_id", "rating", [0, 1, 2], SAMPLE_ROWS)
    return grade_quality(docs, rated, counts=counts).select("doc_id", "quality.expected", "quality.tail", "quality.grade", "quality.selected")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each filter removes per part, order of the five filters and step."""
    from atelier.llm.filter_audit import filter_masks, interaction_audit

    return interaction_audit(filter_masks(table(spark, sf_dir, "documents")), table(spark, sf_dir, "labels"))


def op12_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the text that they decode to."""
    import public_tokenizers

    from atelier.llm.bpe import bpe_round_trip

    made = bpe_round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))
    return made.selectExpr("doc_id", "bpe.n_tokens", "sha2(bpe.ids, 256) as ids_sha256", "sha2(cast(bpe.decoded as binary), 256) as decoded_sha256")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups, links and pair counts of two tokenizers for every document."""
    import public_tokenizers
    from pyspark.sql import functions as F

    from atelier.llm.alignment import align_tokenizers

    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2(F.col("groups"), 256))
    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return align_tokenizers(table(spark, sf_dir, "documents"), *paths, keep={"groups_sha256": digest})[0]


def queries() -> dict[str, Query]:
    return {name: f for name, f in sorted(globals().items()) if name.startswith("op") and name[2:3].isdigit()}


#: All pairs that share a shingle, then everything that can be reached.
_NEAR_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(ws) >= 2 THEN [ws[i] || ' ' || ws[i + 1] FOR i IN range(1, len(ws))] ELSE ws END)) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM i JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * i >= 80 * (p.n + q.n - i)),
b AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
r(doc_id, reach) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, b.y FROM r JOIN b ON r.reach = b.x),
m AS (SELECT doc_id, min(reach) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN m USING (doc_id)
"""


#: Masks of the failed filters, then every order of the five.
_AUDIT_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY t) AS least FROM d),
m AS (
  SELECT doc_id, part, (len(ws) < 200)::INT + 2 * (100 * len(list_distinct(ws)) < 50 * len(ws))::INT
    + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t))::INT
    + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(doc_id > least, false)::INT AS mask FROM w),
f AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
c AS (
  SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM m LEFT JOIN f USING (doc_id) GROUP BY part, mask),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS b),
o AS (
  SELECT p.x || q.x || r.x || s.x || t.x AS filter_order, [p.b, q.b, r.b, s.b, t.b] AS bits FROM l p, l q, l r, l s, l t
  WHERE p.b + q.b + r.b + s.b + t.b = 31 AND (p.b | q.b | r.b | s.b | t.b) = 31),
k AS (
  SELECT filter_order, step::INT AS step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
  FROM o, range(1, 6) AS steps(step))
SELECT part, filter_order, step,
  coalesce(sum(n) FILTER (mask & (before | bit) = 0), 0)::BIGINT AS kept,
  coalesce(sum(n) FILTER (mask & bit > 0 AND mask & before = 0), 0)::BIGINT AS removed,
  coalesce(sum(n) FILTER (mask & bit > 0 AND mask & before > 0), 0)::BIGINT AS redundant,
  coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
  coalesce(sum(good) FILTER (mask & bit > 0 AND mask & before = 0), 0)::BIGINT AS good_lost,
  coalesce(sum(toxic) FILTER (mask & bit > 0 AND mask & before = 0), 0)::BIGINT AS toxic_lost,
  coalesce(sum(n * (120 // greatest(bit_count(mask), 1))) FILTER (mask & bit > 0), 0)::BIGINT AS shapley
FROM c, k GROUP BY part, filter_order, step
"""


def oracle_sql() -> dict[str, str]:
    """SQL for the query that it can express on whole tables; tests hold the
    others against brute force, round trips or held-out rows."""
    return {"op10_near_dedup": _NEAR_SQL, "op11_filter_audit": _AUDIT_SQL}
