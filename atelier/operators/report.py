"""Evaluation result tables: leaderboard marks and ablation deltas."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# --- fixed values: published metrics and their direction (+1 higher is
# better, -1 lower is better)
METRIC_DIRECTIONS = {
    "Val": 1,
    "Ali": -1,
    "Rea": -1,
    "Clip": 1,
    "Text": 1,
    "Image": 1,
    "Layout": 1,
    "Color": 1,
}


def results_long(wide: DataFrame, id_cols: list[str], directions: dict[str, int]) -> DataFrame:
    """Wide result table -> ``(ids..., metric, direction, value)``; missing
    values are dropped."""
    metrics = list(directions)
    long = wide.unpivot(id_cols, metrics, "metric", "value")
    dirs = wide.sparkSession.createDataFrame(list(directions.items()), "metric string, direction int")
    return long.filter(F.col("value").isNotNull()).join(F.broadcast(dirs), "metric")


def leaderboard(results: DataFrame, group: list[str] = ["dataset", "metric"], method: str = "method") -> DataFrame:
    """Rank methods within each (dataset, metric) by ``value * direction``;
    ``mark`` is ``best`` for rank 1 and ``second`` for rank 2.  Ties share a
    rank.  Input: ``(dataset, method, metric, direction, value)``."""
    w = Window.partitionBy(*group).orderBy((F.col("value") * F.col("direction")).desc())
    ranked = results.withColumn("rank", F.rank().over(w).cast("bigint"))
    mark = F.when(F.col("rank") == 1, F.lit("best")).when(F.col("rank") == 2, F.lit("second"))
    return ranked.withColumn("mark", mark)


def ablation_delta(results: DataFrame, base_method: str, keys: list[str] = ["dataset", "metric"], method: str = "method") -> DataFrame:
    """Each method's value minus the base method's value for the same
    dataset and metric (the base table has one row per key)."""
    base = results.filter(F.col(method) == base_method).select(*keys, F.col("value").alias("_base"))
    return results.join(base, keys, "inner").withColumn("delta", F.col("value") - F.col("_base")).drop("_base")
