"""Batch model calls from a DataFrame with a pluggable client.

A client is built once per partition by ``client_factory()``; it has
``call(request: str, options: dict) -> str`` and raises on failure.  Calls
never raise per row: the error is classified into the output.  Concurrency
is the number of partitions of the input times the calls that each keeps in
flight; there are no retries (as in the original tool).  Model output is non-deterministic and paid for, so
``score_and_materialize`` checkpoints the result: a lost executor never
repeats calls that finished.
"""

from __future__ import annotations

import hashlib
import threading
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atelier.constants import PLANNER_MAX_NEW_TOKENS, PLANNER_TEMPERATURE, PLANNER_TOP_P, STATUS_DEPRECATED

#: Options of a stage's requests.
STAGE_OPTIONS = {"plan": {"max_new_tokens": PLANNER_MAX_NEW_TOKENS, "temperature": PLANNER_TEMPERATURE, "top_p": PLANNER_TOP_P}}

RESULT_FIELDS = "response string, ok boolean, error_class string, error_text string"
_RESULT = pa.struct([("response", pa.string()), ("ok", pa.bool_()), ("error_class", pa.string()), ("error_text", pa.string())])


class ModelCallError(Exception):
    """An error raised by a client; ``kind`` is 'status' or 'api'."""

    def __init__(self, message: str | None, kind: str = "api", status_code: int | None = None):
        super().__init__(message)
        self.message = message
        self.kind = kind
        self.status_code = status_code


def classify(exc: BaseException) -> tuple[str, str]:
    kind = getattr(exc, "kind", None)
    code = getattr(exc, "status_code", None)
    if kind == "status":
        cls = "DEPRECATED" if code == STATUS_DEPRECATED else "API_STATUS"
    elif kind == "api":
        cls = "API_ERROR"
    else:
        cls = "UNEXPECTED"
    msg = getattr(exc, "message", None)
    return cls, (msg if msg is not None else str(exc))


def model_score(
    df: DataFrame,
    request: str,
    client_factory: Callable[[], object],
    options: dict | None = None,
    partitions: int | None = None,
    in_flight: int = 1,
    stage: str | Column | None = None,
    stage_options: dict[str, dict] | None = None,
) -> DataFrame:
    """Adds ``response, ok, error_class, error_text`` to every row.

    Only the request (and the stage) goes to Python; all other columns stay as
    they are.  A column of ``df`` with one of the four names is replaced.
    A partition keeps up to ``in_flight`` calls open, each on a thread with a
    client of its own, and returns the results in the rows' order.  A request's
    options are ``options`` with those that ``stage_options`` gives for the
    row's ``stage`` (a column) on top.
    """
    opts, by_stage = dict(options or {}), dict(STAGE_OPTIONS if stage_options is None else stage_options)
    src = df.repartition(partitions) if partitions else df

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        own = threading.local()

        def one(req: str | None, kind: str | None) -> dict:
            try:
                if not hasattr(own, "client"):
                    own.client = client_factory()
                return {"response": own.client.call(req, opts | by_stage.get(kind, {})), "ok": True, "error_class": None, "error_text": None}
            except Exception as e:  # classified, never raised per row
                error, text = classify(e)
                return {"response": None, "ok": False, "error_class": error, "error_text": text}

        with ThreadPoolExecutor(max(1, in_flight)) as pool:
            for requests, stages in batches:
                calls = zip(requests.to_pylist(), stages.to_pylist(), strict=True)
                yield pa.array(list(pool.map(lambda c: one(*c), calls)), _RESULT)

    where = F.lit(None).cast("string") if stage is None else (F.col(f"`{stage}`") if isinstance(stage, str) else stage).cast("string")
    call = F.arrow_udf(run, RESULT_FIELDS).asNondeterministic()
    names = [f.split()[0] for f in RESULT_FIELDS.split(", ")]
    keep = [c for c in src.columns if c not in names]
    called = src.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), call(F.col(f"`{request}`").cast("string"), where).alias("result"))
    return called.select(*[F.col(f"row.`{c}`").alias(c) for c in keep], *[f"result.{n}" for n in names])


def score_and_materialize(df: DataFrame, request: str, client_factory, options=None, partitions=None) -> DataFrame:
    from atelier.session import materialize

    return materialize(model_score(df, request, client_factory, options, partitions))


def score_stage(
    df: DataFrame, request: str, client_factory, results: str, ledger: str, stage: str, key: str = "id", run_id: str | None = None, options=None, partitions=None, in_flight: int = 1
) -> DataFrame:
    """One resumable model stage: calls only for rows whose key has no success
    in the ledger of this stage, stores the results, writes successes and
    failures to the ledger, and returns the stored successes of ``df``.

    ``results`` and ``ledger`` are tables in shared storage (see ``committed``);
    a second run after a fault or a failure repeats no call that succeeded and
    whose results were stored.  The calls have the options of their stage.
    """
    from atelier.operators.runs import SUCCESS, ledger_ids, resume_pending
    from atelier.session import written
    from atelier.sources.scans import read_ledger
    from atelier.sources.committed import read_committed, write_committed
    from atelier.sources.sinks import write_ledger

    run_id = run_id or uuid.uuid4().hex
    spark = df.sparkSession
    done = read_ledger(spark, ledger)
    if "stage" in done.columns:
        done = done.filter(F.col("stage") == stage)
    pending = resume_pending(df, done, key)
    scored = written(model_score(pending.select(F.col(key).cast("string").alias("id"), F.col(request).alias("request")), "request", client_factory, options, partitions, in_flight, F.lit(stage)), "scored")
    write_committed(scored.filter("ok").select("id", "response"), results, f"{stage}-{run_id}", ("stage", stage))
    write_ledger(scored.select("id", F.when(F.col("ok"), SUCCESS).otherwise("failure").alias("status"), F.lit(stage).alias("stage")), ledger, run_id, key=stage)
    stored = read_committed(spark, results, "id string, response string, stage string").filter(F.col("stage") == stage).select(F.col("id").alias("_id"), "response")
    good = ledger_ids(read_ledger(spark, ledger).filter(F.col("stage") == stage), status=SUCCESS)
    stored = stored.dropDuplicates(["_id"]).join(good, F.col("_id") == F.col("id"), "left_semi")
    return df.join(stored, F.col(key).cast("string") == F.col("_id")).drop("_id")


class StubClient:
    """Deterministic stand-in for a chat model (tests, fixtures).

    The response is a digest of the request; a request whose digest falls in
    ``fail_share`` raises a status error (410 for every third failure).
    """

    def __init__(self, fail_share: float = 0.1):
        self.fail_share = fail_share

    def call(self, request: str, options: dict) -> str:
        if request is None:
            raise ValueError("empty request")
        h = hashlib.sha256(request.encode("utf-8")).hexdigest()
        bucket = int(h[:8], 16) / 0xFFFFFFFF
        if bucket < self.fail_share:
            code = STATUS_DEPRECATED if int(h[8:10], 16) % 3 == 0 else 500
            raise ModelCallError(f"stub failure {h[:6]}", kind="status", status_code=code)
        return f"<html><body><div class=\"poster\">{h[:16]}</div></body></html>"


def stub_factory(fail_share: float = 0.1):
    return lambda: StubClient(fail_share)

