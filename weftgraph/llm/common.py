"""Helpers shared by the operators: reading tables, written intermediate tables, ranks without hot tasks."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftgraph.session import ensure_checkpoint_dir, materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ARROW_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage in a folder that all executors share, so a lost executor
    costs a re-read; a job that reads the frame several times computes it once.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return materialize(df, "table", name)


def ascii_lower(column):
    """Lower-case A-Z only."""
    return F.translate(column, UPPER, LOWER)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def prepare_workers(spark: SparkSession, batch: str = "8m") -> None:
    """Settings for Python stages: batches bounded by bytes too, and this package on the workers' path.

    The byte bound keeps very long texts from meeting in one batch of 10,000
    rows.  Workers that share the driver's file system import the package from
    where it lies; elsewhere ship it with ``--py-files`` or install it.
    """
    spark.conf.set(ARROW_BATCH_BYTES, batch)
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def rank_within(df: DataFrame, key: str, order: list[str], name: str = "rank_in_key") -> DataFrame:
    """Add ``name``: 0, 1, 2 … within each value of ``key`` (null is a value), with no task holding a whole key.

    Rows of a key are dealt by a hash of ``order`` into buckets; the rank is the
    number of rows in earlier buckets plus the place in the own bucket.  The
    window, the bucket counts and the join back all use one partitioning by
    (key, bucket), so a key with a third of all rows spreads over all tasks.
    """
    spark = df.sparkSession
    buckets = 4 * shuffle_partitions(spark)
    dealt = df.withColumn("_key", F.coalesce(F.col(key).cast("string"), F.lit("\0null"))) \
        .withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    placed = dealt.withColumn("_place", F.row_number().over(
        Window.partitionBy("_key", "_bucket").orderBy(*order)))
    sizes = dealt.groupBy("_key", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(
        Window.partitionBy("_key").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))) \
        .drop("_n")
    return placed.join(before, ["_key", "_bucket"]) \
        .withColumn(name, F.col("_before") + F.col("_place") - 1) \
        .drop("_key", "_bucket", "_place", "_before")
