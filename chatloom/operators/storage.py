"""Intermediate tables in the shared folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parents[2])


def reachable(spark: SparkSession | None = None) -> None:
    """Send the package to the executors if their Python can't find it by itself; to be called before functions that run there are
    made. Without a session, the active one is meant."""
    spark = spark or SparkSession.getActiveSession()
    here = {os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(":") if p} | {os.path.realpath(os.getcwd())}
    if spark is None or os.path.realpath(ROOT) in here or getattr(spark.sparkContext, "_chatloom_sent", False):
        return
    spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(), "chatloom"), "zip", ROOT, "chatloom"))
    spark.sparkContext._chatloom_sent = True


def stored(df: DataFrame, tag: str) -> DataFrame:
    """df, written as Parquet under spark.checkpoint.dir and read again, so that lost executors cost no more than one stage. Where
    that isn't set (tests), a temporary folder takes its place."""
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    path = f"{folder}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """df, dealt out evenly where it has fewer partitions than there are cores, as a table in one small file has."""
    n = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n) if df.rdd.getNumPartitions() < n else df
