"""Build networks from a stream of request messages.

Request messages (JSON lines, one object per line) arrive as files in a
folder.  Structured Streaming reads them; each micro-batch's requests are
built together in one plan (``foreachBatch``), whatever their number.  All outputs of a batch are
staged and published together (``sinks.publish``), keyed by ``graph_id``: a batch that fails before its
commit leaves the earlier outputs alone, one that is replayed after it is only published.

Per request the batch writes:

* ``<out>/nodes``, ``<out>/edges``: N6 tables;
* N5 GEXF parts at the request's own ``path`` (``<path>/graph_id=<id>/``; a relative
  path lies under ``<out>/gexf``), so a network asked for at two paths is written at both;
* ``<out>/completed``: R5, the request with ``step = "analysis_network"``, as JSON;
* ``<out>/status``: R6, ``(graph_id, status, error, raw)``, one row per message; a
  message that cannot be read (no JSON, unknown platform, bad bounds) fails alone
  under an id of its own, with its text in ``raw``.  A network with a faulty document
  fails alone too, with the first of its errors: the build carries errors in its rows and goes on
  with the other networks.  What concerns all of them (a missing column, a store that cannot be
  read) fails the batch as a whole, after one build.  A network that fails loses its completion record.
"""

from __future__ import annotations

import hashlib

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weftgraph.functions.expressions import COMPLETED_STEP
from weftgraph.plans.build import build_graph
from weftgraph.sinks.publish import Stage, finish, last_published
from weftgraph.sources.requests import REQUEST_SCHEMA, decode_requests, normalize_requests

STATUS_OK = "done"
STATUS_FAILED = "failed"


def completion_records(requests: DataFrame) -> DataFrame:
    """The request as received plus ``step``; one JSON text per network."""
    fields = [F.col(f.name) for f in REQUEST_SCHEMA.fields]
    return requests.select("graph_id", F.to_json(F.struct(*fields, F.lit(COMPLETED_STEP).alias("step")))
                           .alias("value"))


def check_requests(requests: DataFrame, selection: str, ignore_platform: bool = False) -> DataFrame:
    """Normalise leniently and name what is wrong with a request (``error``, null when fine).

    Where the message's ``raw`` text is there, a faulty message gets an id made
    from it, so it shares no output folder with another message.
    """
    requests = requests.distinct()
    if ignore_platform:
        requests = requests.withColumn("_platform", F.col("platform")).withColumn("platform", F.lit(None).cast("string"))
    checked = normalize_requests(requests, selection, strict=False, dedupe=False)
    bad_platform = F.col("platform").isNotNull() & (F.col("platform") != "") & F.col("code").isNull()
    if selection != "timestamp_range":
        bad_platform = F.col("code").isNull()
    problem = (F.when(bad_platform, F.lit("unknown platform"))
               .when(F.col("criteria_id").isNull(), F.lit("missing criteria_id"))
               .when(F.col("path").isNull(), F.lit("missing path"))
               .when(F.col("from_ms").isNull() | F.col("to_ms").isNull(), F.lit("bad time range")))
    checked = checked.withColumn("error", problem)
    if "raw" in checked.columns:
        checked = checked.withColumn("graph_id", F.when(F.col("error").isNull(), F.col("graph_id")).otherwise(
            F.concat(F.lit("failed_"), F.md5(F.coalesce("raw", F.lit(""))))))
    if ignore_platform:
        checked = checked.withColumn("platform", F.col("_platform")).drop("_platform")
    return checked


def request_folder(path: str, out: str) -> str:
    """Where the document of a request goes: its path, under ``out/gexf`` when relative."""
    return path.rstrip("/") if "://" in path or path.startswith("/") else f"{out}/gexf/{path.strip('/')}".rstrip("/")


def _routes(good: DataFrame) -> DataFrame:
    """(graph_id, path, route): where the documents of the networks go; a route is the short name of a path."""
    return good.select("graph_id", "path", F.md5("path").alias("route")).distinct()


def _build_and_stage(stage: Stage, source: DataFrame, good: DataFrame, out: str, build_kw: dict) -> tuple[DataFrame, dict]:
    """Build the networks of ``good`` and stage them; returns ``good`` with each request's error, and the folders of the routes."""
    spark = good.sparkSession
    build, folders = None, {}
    try:
        build = build_graph(spark, source, good.drop("raw"), **{"on_bad": "report", **build_kw})
        told = good.withColumn("error", F.lit(None).cast("string"))
        if build.faults is not None:  # one row per network at most
            told = good.join(spark.createDataFrame(build.faults.collect(), "graph_id string, error string"), "graph_id", "left")
        stage.write_graphs(build.nodes, build.out_edges)
        routes = _routes(told.where(F.col("error").isNull()))
        folders = {r["route"]: request_folder(r["path"], out) for r in routes.select("route", "path").distinct().toLocalIterator()}
        stage.write_documents(routes.select("graph_id", "route"), folders.items())
        return told, folders
    except Exception as exc:  # noqa: BLE001 - R6: report the failure, keep the stream going
        stage.clear()
        return good.withColumn("error", F.lit(f"{type(exc).__name__}: {exc}")), {}
    finally:
        if build is not None:
            build.release()


def process_batch(spark: SparkSession, requests: DataFrame, source: DataFrame, out: str, batch_id: int = 0,
                  stream_id: str | None = None, **build_kw) -> None:
    """Build the networks of one batch of requests (all strings) and publish what it gives.

    A batch of an earlier run that was committed but not published is published
    first; if it is this one (same id and messages), nothing is left to do.  Batches of a
    stream (``stream_id``) are remembered once published, so one that comes again because the stream
    stopped before it acknowledged its messages is not built twice.
    """
    if "raw" not in requests.columns:
        requests = requests.withColumn("raw", F.to_json(F.struct(*[f.name for f in REQUEST_SCHEMA.fields])))
    checked = check_requests(requests, build_kw.get("selection", "day_range"),
                             build_kw.get("ignore_platform", False)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n, n_good, digest = checked.agg(F.count(F.lit(1)), F.count_if(F.col("error").isNull()),
                                        F.bit_xor(F.xxhash64("graph_id", "path", "raw"))).first()
        batch = {"stream": stream_id, "id": batch_id, "messages": n, "digest": digest}
        if batch in finish(spark, out) or (stream_id is not None and last_published(spark, out, stream_id) == batch):
            return
        stage = Stage(spark, out, batch_id)
        stage.clear()
        good = checked.where(F.col("error").isNull()).select(*[f.name for f in REQUEST_SCHEMA.fields], "graph_id", "raw")
        status = checked.where(F.col("error").isNotNull()).select(
            "graph_id", F.lit(STATUS_FAILED).alias("status"), "error", "raw")
        completed, built, failed, folders = None, [], [], {}
        if n_good:
            told, folders = _build_and_stage(stage, source, good, out, build_kw)
            # every request gets its record, also where several (with other paths) share a network
            completed = completion_records(told.where(F.col("error").isNull()))
            status = status.unionByName(told.select(
                "graph_id", F.when(F.col("error").isNull(), F.lit(STATUS_OK)).otherwise(F.lit(STATUS_FAILED))
                .alias("status"), "error", "raw"))
            for row in told.select("graph_id", "error").distinct().toLocalIterator():
                (built if row["error"] is None else failed).append(row["graph_id"])
        stage.write_records(completed, status.withColumn("batch_id", F.lit(batch_id)))
        stage.commit(batch, built, failed, folders)
        stage.publish()
    finally:
        checked.unpersist()


def run_stream(spark: SparkSession, request_dir: str, source: DataFrame, out: str, checkpoint: str, *,
               available_now: bool = True, max_files_per_trigger: int | None = None, acknowledged: str | None = None,
               **build_kw) -> StreamingQuery:
    """Watch ``request_dir`` for JSON-lines request files and build their networks.

    ``checkpoint`` is the stream's own checkpoint folder (on a shared file
    system on a cluster).  ``available_now`` processes what is there and stops
    (batch-like, for tests and scheduled runs); otherwise the query keeps
    running and picks up new files.

    ``acknowledged`` makes the folder a queue with one message file in flight: a
    file is taken when the one before is done, and goes to this folder (outside ``request_dir``)
    once a later batch has begun, which is when its own one is committed for good.
    A stream that stops in between takes the file again; what was published is then
    not built again.
    """
    reader = spark.readStream.format("text")
    if acknowledged:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", acknowledged)
        max_files_per_trigger = 1
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = reader.load(request_dir)
    requests = decode_requests(lines)

    stream_id = hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()

    def handle(batch: DataFrame, batch_id: int) -> None:
        process_batch(batch.sparkSession, batch, source, out, batch_id, stream_id, **build_kw)

    writer = requests.writeStream.option("checkpointLocation", checkpoint).foreachBatch(handle)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
