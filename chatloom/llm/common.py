"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the given folder; the path may be of any store that Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reachable(spark: SparkSession) -> None:
    """Send the package to the executors if their Python can't find it by itself."""
    here = {os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(":") if p} | {os.path.realpath(os.getcwd())}
    if os.path.realpath(ROOT) in here or getattr(spark.sparkContext, "_chatloom_sent", False):
        return
    import shutil

    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(), "chatloom"), "zip", ROOT, "chatloom")
    spark.sparkContext.addPyFile(archive)
    spark.sparkContext._chatloom_sent = True


def scratch(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: spark.checkpoint.dir, or a temporary one where that is unset (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def materialize(df: DataFrame, tag: str, codec: str = "zstd") -> DataFrame:
    """Write df to the shared folder and read it again: cuts the lineage in a form that outlives executors."""
    spark = df.sparkSession
    path = f"{scratch(spark)}/{tag}-{uuid.uuid4().hex}"
    # what was shuffled for the table isn't needed once it is written
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(cleanup, "false")
    spark.conf.set(cleanup, "true")
    try:
        df.write.option("compression", codec).parquet(path)
    finally:
        spark.conf.set(cleanup, before)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """name, with as many underscores before it as make it differ from all columns of df, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def crc_fold(column: str, folds: int):
    """crc32 of an id as text, modulo the number of folds. A null id counts as the text 'null'."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("null")).cast("binary")) % folds


def label_sample(labels: DataFrame, value: str, keep, max_rows: int) -> DataFrame:
    """(doc_id, y) of at most max_rows labelled rows, chosen by a hash of the id.

    Rows with a null id or label take no part; where an id has several labels, the largest holds.
    """
    return labelled(labels, value, keep).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)


def labelled(labels: DataFrame, value: str, keep) -> DataFrame:
    """(doc_id, y) of all labelled rows. Rows with a null id or label take no part; where an id has several labels, the largest holds."""
    rows = labels.filter(F.col("doc_id").isNotNull() & F.col(value).isNotNull() & keep)
    return rows.groupBy("doc_id").agg(F.max(F.col(value).cast("int")).alias("y"))
