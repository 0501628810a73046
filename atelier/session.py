"""Session helpers: local sessions for tests/bench, table loading, scratch space.

Library operators never build their own session; they take DataFrames.  The
helpers here are for the callers (tests, bench, scenarios).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "atelier") -> SparkSession:
    """A local session configured the way the tests and bench expect.

    On a cluster the session comes from the platform; nothing here is needed.
    """
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("ATELIER_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    scratch_root(spark)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for materialised intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session (a cluster names a shared
    folder there) and raises if a cluster names none, as its executors can't
    see each other's folders.  Only a local session, which is one process, gets
    a fresh temporary folder of its own.
    """
    sc = spark.sparkContext
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="atelier-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(conf_dir)
    return conf_dir


def scratch_path(spark: SparkSession, *parts: str) -> str:
    root = scratch_root(spark).rstrip("/")
    return "/".join([root, *parts])


def materialize(df: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder.

    Used after expensive or non-deterministic stages (model calls, ids from
    ``monotonically_increasing_id``) so a lost executor never recomputes them.
    """
    spark = spark or df.sparkSession
    scratch_root(spark)
    return df.checkpoint(eager=True)


def written(df: DataFrame, what: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: what follows
    starts from the same rows, however often it is evaluated."""
    path = scratch_path(df.sparkSession, f"{what}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
