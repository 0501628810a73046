"""Result-table keys: leaderboard marks and ablation deltas over per-segment
(dataset) and per-nation (method) averages."""

from __future__ import annotations

from pyspark.sql import functions as F

from atelier.operators import report as RE
from atelier.scenarios import scenario
from atelier.session import table

_DIRECTIONS = {"avg_totalprice": 1, "avg_acctbal": -1}
BASE_METHOD = "NATION_0"


def _results(spark, d):
    o = table(spark, d, "orders")
    c = table(spark, d, "customer")
    n = table(spark, d, "nation")
    cn = c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    price = o.join(cn, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_mktsegment", "n_name").agg(F.avg("o_totalprice").alias("avg_totalprice"))
    bal = cn.groupBy("c_mktsegment", "n_name").agg(F.avg("c_acctbal").alias("avg_acctbal"))
    wide = price.join(bal, ["c_mktsegment", "n_name"], "full").select(
        F.col("c_mktsegment").alias("dataset"), F.col("n_name").alias("method"), "avg_totalprice", "avg_acctbal"
    )
    return RE.results_long(wide, ["dataset", "method"], _DIRECTIONS)


_LONG_SQL = """
p AS (SELECT c_mktsegment AS dataset, n_name AS method, avg(o_totalprice) AS v
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL),
b AS (SELECT c_mktsegment AS dataset, n_name AS method, avg(c_acctbal) AS v FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL),
l AS (SELECT dataset, method, 'avg_totalprice' AS metric, 1 AS direction, v AS value FROM p
  UNION ALL SELECT dataset, method, 'avg_acctbal', -1, v FROM b)
"""


@scenario(
    "leaderboard",
    f"""
WITH {_LONG_SQL},
r AS (SELECT *, rank() OVER (PARTITION BY dataset, metric ORDER BY value * direction DESC) AS rank FROM l)
SELECT dataset, method, metric, rank,
  CASE WHEN rank = 1 THEN 'best' WHEN rank = 2 THEN 'second' END AS mark
FROM r
""",
)
def leaderboard(spark, d):
    lb = RE.leaderboard(_results(spark, d))
    # the averages themselves are inputs; rank and mark are the result
    return lb.select("dataset", "method", "metric", "rank", "mark")


@scenario(
    "ablation_delta",
    f"""
WITH {_LONG_SQL}
SELECT l.dataset, l.method, l.metric, round(l.value - b.value, 6) AS delta
FROM l JOIN l b ON b.dataset = l.dataset AND b.metric = l.metric AND b.method = '{BASE_METHOD}'
""",
)
def ablation_delta(spark, d):
    ad = RE.ablation_delta(_results(spark, d), BASE_METHOD)
    return ad.select("dataset", "method", "metric", F.round("delta", 6).alias("delta"))
