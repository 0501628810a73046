"""Physical-plan checks used by the tests and the bench (``explain`` text)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def plan_text(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df: DataFrame) -> str:
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def has_node(df: DataFrame, name: str) -> bool:
    return name in formatted(df)
