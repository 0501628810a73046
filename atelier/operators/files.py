"""File-name level operators on artifact listings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atelier.constants import LISTING_SUFFIX, POSTER_CLASS
from atelier.functions.html import render_ready

#: Prefix of the files that a listing shows, unless told otherwise.
REFINED_LISTING_PREFIX = "refined_"


def render_ready_files(examples: DataFrame, html: str, path: str, files: DataFrame, token: str = POSTER_CLASS, out: str = "ready") -> DataFrame:
    """Adds ``out``: an example can be rendered if its HTML file (``path``)
    exists, i.e. is among ``files (path)``, and its text has the container."""
    there = files.select(F.col("path").alias("_path")).distinct().withColumn("_there", F.lit(True))
    named = examples.filter(F.col(path).isNotNull()).join(there, F.col(path) == F.col("_path"), "left").drop("_path")
    joined = named.unionByName(examples.filter(F.col(path).isNull()).withColumn("_there", F.lit(False)))
    return joined.withColumn(out, F.coalesce(F.col("_there"), F.lit(False)) & render_ready(F.col(html), token)).drop("_there")


def artifact_listing(df: DataFrame, name: str = "name", prefix: str = REFINED_LISTING_PREFIX, suffix: str = LISTING_SUFFIX) -> DataFrame:
    """Names starting with ``prefix`` and ending with ``suffix``, sorted.

    The prefix is a parameter: the refinement rounds write ``refined_<i>.html``
    files, so that is the default (a ``refine_`` filter would never match
    its own output)."""
    return df.filter(F.col(name).startswith(prefix) & F.col(name).endswith(suffix)).orderBy(name)
