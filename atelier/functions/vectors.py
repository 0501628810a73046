"""Vector column expressions (``array<float>`` / ``array<double>``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from atelier.functions.text import _col


def norm(v) -> Column:
    """Euclidean length, accumulated in double."""
    return F.sqrt(F.aggregate(_col(v), F.lit(0.0).cast("double"), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def l2_normalize(v) -> Column:
    """Unit-length copy as ``array<double>``; a zero vector stays all zeros
    (no division by zero), NULL stays NULL."""
    col = _col(v)
    n = norm(col)
    return F.transform(col, lambda x: F.coalesce(F.try_divide(x.cast("double"), n), F.lit(0.0)))


def scale(v, factor) -> Column:
    f = factor if isinstance(factor, Column) else F.lit(factor)
    return F.transform(_col(v), lambda x: x.cast("double") * f)


def dot(a, b) -> Column:
    """Inner product in double."""
    return F.aggregate(
        F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0).cast("double"),
        lambda acc, x: acc + x,
    )


def add(a, b, wb: float = 1.0) -> Column:
    return F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") + F.lit(wb) * y.cast("double"))
