"""Model-call and streaming keys.

``model_score`` uses the deterministic stub client (a SHA-256 digest of the
request decides success, failure class and response), so DuckDB can
recompute every row with ``sha256``.  ``stream_intake`` writes events-derived
JSONL files and a ledger under the session's checkpoint folder, runs the
stream to completion and returns the distinct pending ids.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from atelier.constants import IMAGE_SYSTEM_PROMPT
from atelier.functions import chat as CH
from atelier.operators.agg import first_by
from atelier.operators.score import model_score as score
from atelier.operators.score import stub_factory
from atelier.scenarios import scenario, sql_literal
from atelier.session import scratch_path, table
from atelier.streaming.intake import stream_intake as start_stream

_FAIL_SHARE = 0.1
_REQ = f"{sql_literal(IMAGE_SYSTEM_PROMPT + chr(10) + 'user: ')} || text"


@scenario(
    "model_score",
    f"""
WITH r AS (SELECT doc_id, sha256({_REQ}) AS h FROM documents),
c AS (SELECT doc_id, h, CAST('0x' || left(h, 8) AS BIGINT) / 4294967295.0 < {_FAIL_SHARE} AS failed,
  CAST('0x' || substr(h, 9, 2) AS BIGINT) % 3 = 0 AS deprecated FROM r)
SELECT doc_id, NOT failed AS ok,
  CASE WHEN failed AND deprecated THEN 'DEPRECATED' WHEN failed THEN 'API_STATUS' END AS error_class,
  CASE WHEN failed THEN 'stub failure ' || left(h, 6) END AS error_text,
  CASE WHEN NOT failed THEN '<html><body><div class="poster">' || left(h, 16) || '</div></body></html>' END AS response
FROM c
""",
)
def model_score(spark, d):
    docs = table(spark, d, "documents").select("doc_id", CH.image_request(F.col("text")).alias("request"))
    out = score(docs, "request", stub_factory(_FAIL_SHARE))
    return out.select("doc_id", "ok", "error_class", "error_text", "response")


@scenario(
    "stream_intake",
    """
SELECT DISTINCT CAST(user_id AS VARCHAR) AS id FROM events
WHERE user_id NOT IN (SELECT user_id FROM events GROUP BY user_id HAVING arg_min(event_type, ts) IN ('view', 'click'))
""",
)
def stream_intake(spark, d):
    ev = table(spark, d, "events")
    root = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    lines = ev.select(F.to_json(F.struct(F.col("user_id").cast("string").alias("id"), F.col("event_type").alias("prompt"))).alias("value"))
    lines.write.text(f"{root}/in")
    # done already: users whose first event was a view or a click
    first = first_by(ev.select("user_id", "ts", "event_type"), "user_id", "ts")
    ledger = first.filter(F.col("event_type").isin("view", "click")).select(F.col("user_id").cast("string").alias("id"))
    ledger.write.parquet(f"{root}/ledger")
    q = start_stream(spark, f"{root}/in", f"{root}/ledger", f"{root}/sink", f"{root}/ckpt", max_files_per_trigger=2)
    q.awaitTermination()
    return spark.read.parquet(f"{root}/sink").select("id").distinct()
