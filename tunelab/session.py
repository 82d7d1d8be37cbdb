"""Session defaults and the shared scratch folder.

Every setting here is a plain Spark setting.  The number of shuffle
partitions is left to the cluster: adaptive execution merges small shuffle
partitions and splits skewed ones, so one generous start value serves both a
laptop and a thousand executors.
"""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def get_session(app_name: str = "tunelab", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the defaults above; ``extra`` wins over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """This application's folder below the cluster's shared checkpoint folder.

    All executors must see it, so it is taken from ``spark.checkpoint.dir``.
    Only a local session, whose one machine is the whole cluster, may fall
    back to a temporary folder; it is remembered in the session.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("tunelab.scratch.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tunelab-")
        spark.conf.set("tunelab.scratch.dir", base)
    return f"{base.rstrip('/')}/tunelab/{spark.sparkContext.applicationId}"


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder for one written table; like checkpoints, it stays until the folder is cleaned."""
    return f"{scratch_root(spark)}/{name}-{uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the scratch folder and read it back: computed once, however often it is used."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
