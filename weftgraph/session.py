"""Session settings and lineage helpers.

The library never creates its own cluster settings behind the caller's back:
``get_session`` is a convenience for tests, the bench and the examples; library
functions take the caller's ``SparkSession`` as it is.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Settings the engine relies on for stable results (UTC day keys) and for a
# plan that adapts to the data at run time (AQE coalescing and skew splits).
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "weftgraph", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults.

    ``master`` defaults to ``local[*]``; on a cluster pass nothing and let
    ``spark-submit`` decide.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory, setting one only when unset.

    On a cluster the directory comes from ``spark.checkpoint.dir`` (a shared
    file system).  Only when nothing is configured, as in local tests, a fresh
    folder under the system temp directory is used.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        sc = None
    if sc is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on Spark Connect")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        master = sc.master or ""
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="weftgraph-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def _path_exists(spark: SparkSession, path: str) -> bool | None:
    try:
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
    except Exception:  # noqa: BLE001 - no JVM access (Spark Connect)
        return None
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return bool(jpath.getFileSystem(conf).exists(jpath))


def materialize(df: DataFrame, how: str = "table", name: str = "frame",
                written: list | None = None) -> DataFrame:
    """Cut lineage of a frame that is read several times.

    ``table`` writes it as Parquet under the checkpoint directory (a shared
    folder on a cluster) and reads it back: one job, no recomputation when an
    executor is lost, a plan leaf with real file statistics for later broadcast
    and skew decisions.  ``checkpoint`` uses ``DataFrame.checkpoint`` (the same
    folder, RDD files).  ``persist`` keeps it in executor memory/disk
    (recomputed from lineage if lost).  ``none`` leaves the plan lazy.
    """
    if how == "none":
        return df
    if how == "persist":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark)
    if how == "checkpoint":
        return df.checkpoint(eager=True)
    if how == "table":
        path = f"{root.rstrip('/')}/weftgraph-tables/{name}-{uuid.uuid4().hex}"
        df.write.mode("errorifexists").parquet(path)
        if written is not None:
            written.append(path)
        return spark.read.schema(_nullable(df.schema)).parquet(path)
    raise ValueError(f"unknown materialize mode: {how!r}")


def materialize_together(frames: dict[str, DataFrame], how: str = "table", name: str = "frames",
                         written: list | None = None) -> dict[str, DataFrame]:
    """Materialise several frames of one lineage in a single job.

    In ``table`` mode the frames (padded to one schema) are written once,
    partitioned by their name, and each is read back from its own folder, so
    its file statistics stay exact.  Being one plan, the shuffles they share
    are computed once (exchange reuse).  Other modes materialise each frame.
    """
    if how != "table":
        return {k: materialize(df, how, k, written) for k, df in frames.items()}
    spark = next(iter(frames.values())).sparkSession
    root = ensure_checkpoint_dir(spark)
    path = f"{root.rstrip('/')}/weftgraph-tables/{name}-{uuid.uuid4().hex}"
    columns: dict[str, object] = {}
    for df in frames.values():
        for field in df.schema.fields:
            columns.setdefault(field.name, field.dataType)
    from pyspark.sql import functions as F

    def padded(key, df):
        have = set(df.columns)
        return df.select(*[F.col(c) if c in have else F.lit(None).cast(t).alias(c) for c, t in columns.items()],
                         F.lit(key).alias("_part"))

    parts = [padded(k, df) for k, df in frames.items()]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    union.write.mode("errorifexists").partitionBy("_part").parquet(path)
    if written is not None:
        written.append(path)
    out = {}
    for key, df in frames.items():
        part = f"{path}/_part={key}"
        exists = _path_exists(spark, part)
        if exists:
            out[key] = spark.read.schema(_nullable(df.schema)).parquet(part)
        elif exists is None:  # cannot list files: read the whole table and filter on the part
            try:
                out[key] = spark.read.parquet(path).where(F.col("_part") == key).select(*df.columns)
            except Exception:  # noqa: BLE001 - nothing was written at all
                out[key] = spark.createDataFrame([], df.schema)
        else:
            out[key] = spark.createDataFrame([], df.schema)
    return out


def _nullable(schema):
    """The schema a Parquet read gives back (every field nullable), known without reading footers."""
    from pyspark.sql.types import StructField, StructType
    return StructType([StructField(f.name, f.dataType, True) for f in schema.fields])


def remove_paths(spark: SparkSession, paths: list) -> None:
    """Delete materialised tables (recursively) through the Hadoop file system.

    Only for tables that nothing reads again: on Spark Connect they stay, to the checkpoint folder's lifecycle.
    """
    try:
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
    except Exception:  # noqa: BLE001 - no JVM access: leave them to the checkpoint folder's lifecycle
        return
    for p in paths:
        jpath = jvm.org.apache.hadoop.fs.Path(p)
        jpath.getFileSystem(conf).delete(jpath, True)


def scale_settings(input_bytes: int, cores: int, partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Shuffle settings for a given input size: partitions of about ``partition_bytes``.

    AQE coalesces small post-shuffle partitions and splits skewed ones, so the
    initial count only needs to be large enough.  The engine's shuffles carry
    selected, map-side-combined rows, far fewer bytes than the input, so the
    input-based count is clamped to 2–8 waves of the cores (more reducers would
    only multiply shuffle blocks).
    """
    n = min(max(cores * 2, -(-input_bytes // partition_bytes)), cores * 8)
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
    }


def env_int(name: str, default: int) -> int:
    try:
        return int(os.environ.get(name, default))
    except ValueError:
        return default
