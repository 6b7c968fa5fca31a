"""Registered queries: one per operator group of the inventory.

Each query takes ``(spark, sf_dir)``, derives the interaction documents from
``<sf_dir>/events.parquet`` with Spark, and runs the networks of a fixed set of
requests.  Together the requests cover every criteria and platform over the
whole month of data, so every query works on the whole table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.functions.expressions import COMPLETED_STEP
from weftgraph.operators import cap as capops
from weftgraph.operators import graph as graphops
from weftgraph.plans.build import GraphBuild, build_graph, graph_counts
from weftgraph.sinks.gexf import gexf_edges, gexf_nodes
from weftgraph.sources.documents import document_counts, sample_documents
from weftgraph.sources.fixtures import INTERACTION_COLUMNS, load_interactions, wide_rows
from weftgraph.sources.requests import (DAY_LIST, DAY_RANGE, TIMESTAMP_RANGE, decode_requests,
                                        normalize_requests)
from weftgraph.sources.widerow import select_from_wide_rows

# Request bounds (epoch ms, UTC): the test window [2024-01-05, 2024-01-26] and the whole month.
WINDOW = ("1704412800000", "1706227200000")
MONTH = ("1704067200000", "1706745600000")
CRITERIA = ("crit_0", "crit_1", "crit_2")
PLATFORMS = ("twitter", "facebook", "instagram")


def _req(platform, criteria_id, bounds, path="out"):
    return {"path": path, "platform": platform, "criteria_id": criteria_id, "from": bounds[0], "to": bounds[1]}


# Day modes: one network per criteria and platform over the month, plus the test window of crit_0 on twitter.
DAY_REQUESTS = [_req("twitter", "crit_0", WINDOW)] + [_req(p, c, MONTH) for c in CRITERIA for p in PLATFORMS]
# Timestamp mode: platform optional; every platform per criteria, plus one platform-filtered request.
TS_REQUESTS = ([_req(None, "crit_0", WINDOW)] + [_req(None, c, MONTH) for c in CRITERIA]
               + [_req("facebook", "crit_1", MONTH)])

SMALL_CAP = 40

_BUILDS: dict = {}


def cached_build(spark: SparkSession, sf_dir: str, selection: str = DAY_RANGE, cap: int = 15000,
                 cap_mode: str = capops.INDUCED, source_kind: str = "flat") -> GraphBuild:
    """One build per session and configuration; its persisted frames serve several queries."""
    try:
        session_key = spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - Spark Connect: no SparkContext
        session_key = id(spark)
    key = (session_key, sf_dir, selection, cap, cap_mode, source_kind)
    if key not in _BUILDS:
        _BUILDS[key] = fresh_build(spark, sf_dir, selection, cap, cap_mode, source_kind)
    return _BUILDS[key]


def fresh_build(spark: SparkSession, sf_dir: str, selection: str = DAY_RANGE, cap: int = 15000,
                cap_mode: str = capops.INDUCED, source_kind: str = "flat") -> GraphBuild:
    requests = TS_REQUESTS if selection == TIMESTAMP_RANGE else DAY_REQUESTS
    inter = load_interactions(spark, sf_dir)
    source = wide_rows(inter) if source_kind == "wide" else inter
    return build_graph(spark, source, requests, selection=selection, cap=cap, cap_mode=cap_mode,
                       source_kind=source_kind, require_target=selection != TIMESTAMP_RANGE)


def clear_builds() -> None:
    for b in _BUILDS.values():
        try:
            b.release()
        except Exception:  # noqa: BLE001 - a stopped session has nothing to release
            pass
    _BUILDS.clear()


def _selected(selection: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark, sf_dir):
        return cached_build(spark, sf_dir, selection).documents.select("graph_id", *INTERACTION_COLUMNS)
    return run


def q_cells_explode(spark, sf_dir, selection=DAY_RANGE, extended_json=False):
    from weftgraph.plans.build import _request_bound
    from weftgraph.sources.requests import requests_frame
    requests = TS_REQUESTS if selection == TIMESTAMP_RANGE else DAY_REQUESTS
    wide = wide_rows(load_interactions(spark, sf_dir), extended_json=extended_json)
    normalized = normalize_requests(requests_frame(spark, requests), selection)
    docs = select_from_wide_rows(wide, normalized, selection, require_target=selection != TIMESTAMP_RANGE,
                                 request_rows=_request_bound(requests, selection), n_requests=len(requests))
    return docs.select("graph_id", *INTERACTION_COLUMNS)


def _mixed_types(value, key):
    """The timestamp of a document's JSON text as a plain number, a typed double, a date in ms or a date as text."""
    plain = '"timestamp":([0-9]+)'
    ms = F.regexp_extract(value, plain, 1).cast("bigint")
    iso = F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    form = F.pmod(F.xxhash64(key), F.lit(4))
    return F.when(form == 0, value) \
        .when(form == 1, F.regexp_replace(value, plain, r'"timestamp":{"\$numberDouble":"$1.0"}')) \
        .when(form == 2, F.regexp_replace(value, plain, r'"timestamp":{"\$date":{"\$numberLong":"$1"}}')) \
        .otherwise(F.coalesce(F.regexp_replace(value, F.lit(plain), F.concat(F.lit(r'"timestamp":{"\$date":"'), iso, F.lit('"}'))), value))


def q_cells_variant(spark, sf_dir):
    """Documents with typed values of extended JSON, read as variants."""
    from weftgraph.sources.requests import requests_frame
    wide = wide_rows(load_interactions(spark, sf_dir)).withColumn(
        "cells", F.transform_values("cells", lambda k, v: _mixed_types(v, k)))
    normalized = normalize_requests(requests_frame(spark, DAY_REQUESTS), DAY_RANGE)
    docs = select_from_wide_rows(wide, normalized, DAY_RANGE, n_requests=len(DAY_REQUESTS))
    return docs.select("graph_id", *INTERACTION_COLUMNS)


def q_sel_document_store(spark, sf_dir):
    """R3 document-store variant: ordinary messages over documents without platform and day."""
    docs = load_interactions(spark, sf_dir).drop("platform", "day")
    b = build_graph(spark, docs, DAY_REQUESTS, selection=TIMESTAMP_RANGE, require_target=False, ignore_platform=True)
    return b.documents.select("graph_id", *[c for c in INTERACTION_COLUMNS if c not in ("platform", "day")])


def _signed(column: str, sign_modulus: int = 3):
    """Account ids divisible by ``sign_modulus`` become negative, all are zero-padded to 20 digits."""
    digits = F.regexp_extract(column, r"^TW_([0-9]+)$", 1)
    sign = F.when(digits.cast("bigint") % sign_modulus == 0, F.lit("-")).otherwise(F.lit(""))
    return F.when(digits != "", F.concat(F.lit("TW_"), sign, F.lpad(digits, 20, "0"))).otherwise(F.col(column))


def q_resolve_signed_ids(spark, sf_dir):
    """E2 + D4: negative and zero-padded account ids; surrogates stay below the lowest account."""
    docs = load_interactions(spark, sf_dir).withColumn("source", _signed("source")).withColumn("target", _signed("target"))
    b = build_graph(spark, docs, DAY_REQUESTS, selection=DAY_RANGE)
    return b.vertices.select("graph_id", "id", "name", "type")


def q_written(kind):
    """N6 + N5: what was written, read back."""
    def run(spark, sf_dir):
        from weftgraph.session import ensure_checkpoint_dir
        from weftgraph.sinks.gexf import write_gexf
        from weftgraph.sinks.tables import write_tables
        out = f"{ensure_checkpoint_dir(spark).rstrip('/')}/written-{uuid.uuid4().hex}"
        b = cached_build(spark, sf_dir)
        ids = b.requests.select("graph_id")
        if kind == "gexf":
            write_gexf(ids, b.nodes, b.out_edges, f"{out}/gexf")
            line = F.trim("value")
            return spark.read.text(f"{out}/gexf").where(line.startswith("<node id") | line.startswith("<edge id")) \
                .select("graph_id", F.regexp_extract("value", r'source="([^"]*)"', 1).alias("source"),
                        F.regexp_extract("value", r'target="([^"]*)"', 1).alias("target"),
                        F.regexp_extract("value", r'<node id="([^"]*)"', 1).alias("node"))
        write_tables(b.nodes, b.out_edges, out, graph_ids=ids)
        return spark.read.parquet(f"{out}/{kind}")
    return run


MESSY_MESSAGES = [json.dumps(r) for r in (
    _req("twitter", "crit_0", MONTH, "a"), _req("twitter", "crit_0", MONTH, "b"),
    _req("twitter", "crit_1", (int(MONTH[0]), int(MONTH[1]))), _req("twitter", "crit_1", MONTH, "c"),
    _req("myspace", "crit_2", MONTH), _req(None, "crit_2", MONTH), _req("", "crit_2", MONTH, "d"),
    _req("twitter", None, MONTH), _req("twitter", "crit_1", MONTH, None))] + ["not json", "{also not"]


def q_requests_messy(spark, sf_dir):
    """R1 + R6: one row per message, whatever is wrong with it, with its text and its document count."""
    from weftgraph.operators.select import select_documents
    from weftgraph.streaming import check_requests
    lines = spark.createDataFrame([(m,) for m in MESSY_MESSAGES], "value string")
    checked = check_requests(decode_requests(lines), TIMESTAMP_RANGE)
    networks = normalize_requests(checked.where(F.col("error").isNull()).select(
        "path", "platform", "criteria_id", "from", "to"), TIMESTAMP_RANGE)
    docs = select_documents(load_interactions(spark, sf_dir), networks, TIMESTAMP_RANGE, require_target=False)
    return (checked.join(document_counts(docs), "graph_id", "left")
            .select("graph_id", "raw", "error", F.coalesce("documents", F.lit(0)).cast("bigint").alias("documents")))


def q_docs_sample(spark, sf_dir):
    return sample_documents(load_interactions(spark, sf_dir), "crit_0", 10)


def _stage(attr: str, selection=DAY_RANGE, cap=15000, cap_mode=capops.INDUCED, cols=None):
    def run(spark, sf_dir):
        df = getattr(cached_build(spark, sf_dir, selection, cap, cap_mode), attr)
        return df.select(*cols) if cols else df
    return run


def q_deg_total(spark, sf_dir):
    return cached_build(spark, sf_dir).degrees.select("graph_id", "id", "degree")


def q_deg_in(spark, sf_dir):
    return cached_build(spark, sf_dir).degrees.where(F.col("in_degree") > 0).select("graph_id", "id", "in_degree")


def q_deg_out(spark, sf_dir):
    return cached_build(spark, sf_dir).degrees.where(F.col("out_degree") > 0).select("graph_id", "id", "out_degree")


def q_graph_vertices_default(spark, sf_dir):
    b = cached_build(spark, sf_dir)
    return graphops.vertices_with_default(b.edges, b.vertices)


def q_name_counts(spark, sf_dir):
    return graphops.name_counts(cached_build(spark, sf_dir).vertices)


def q_max_degree_vertex(spark, sf_dir):
    return graphops.max_degree_vertex(cached_build(spark, sf_dir).nodes_deg)


def _thresholds(cap):
    def run(spark, sf_dir):
        return cached_build(spark, sf_dir, DAY_RANGE, cap).thresholds
    return run


def _gexf_nodes(spark, sf_dir):
    return gexf_nodes(cached_build(spark, sf_dir).nodes)


def _gexf_edges(spark, sf_dir):
    return gexf_edges(cached_build(spark, sf_dir).out_edges)


def _counts(selection=DAY_RANGE, cap=15000, cap_mode=capops.INDUCED, source_kind="flat"):
    def run(spark, sf_dir):
        return graph_counts(cached_build(spark, sf_dir, selection, cap, cap_mode, source_kind))
    return run


def _request_lines(spark: SparkSession, requests) -> DataFrame:
    """The queue messages: one JSON object per request."""
    return spark.createDataFrame([(json.dumps(r),) for r in requests], "value string")


def q_requests_interactions(spark, sf_dir):
    """R1 + R2 + S10: decode the request messages, select, count documents per network."""
    from weftgraph.operators.select import select_documents
    normalized = normalize_requests(decode_requests(_request_lines(spark, DAY_REQUESTS)), DAY_LIST)
    docs = select_documents(load_interactions(spark, sf_dir), normalized, DAY_LIST, require_target=True)
    return (normalized.select("graph_id").join(document_counts(docs), "graph_id", "left")
            .select("graph_id", F.coalesce("documents", F.lit(0)).cast("bigint").alias("documents")))


def q_requests_completed(spark, sf_dir):
    """The completion message of every request, beside its network size."""
    b = cached_build(spark, sf_dir)
    msg = F.to_json(F.struct("path", "platform", "criteria_id", "from", "to",
                             F.lit(COMPLETED_STEP).alias("step")))
    return (b.requests.select("graph_id", msg.alias("message"))
            .join(graph_counts(b), "graph_id"))


BAD_REQUESTS = [_req("myspace", "crit_0", MONTH), _req("twitter", "crit_1", ("yesterday", MONTH[1]))]


def q_requests_status(spark, sf_dir):
    """R6 beside R2/S10: every request's status (failed with its error, or done) and its document count."""
    from weftgraph.operators.select import select_documents
    from weftgraph.sources.requests import requests_frame
    from weftgraph.streaming import check_requests
    checked = check_requests(requests_frame(spark, DAY_REQUESTS + BAD_REQUESTS), DAY_RANGE)
    good = checked.where(F.col("error").isNull())
    counts = document_counts(select_documents(load_interactions(spark, sf_dir), good, DAY_RANGE))
    return (checked.join(counts, "graph_id", "left")
            .select("graph_id", F.when(F.col("error").isNull(), F.lit("done")).otherwise(F.lit("failed"))
                    .alias("status"), "error",
                    F.coalesce("documents", F.lit(0)).cast("bigint").alias("documents")))


def _batch_out(spark: SparkSession, name: str) -> str:
    from weftgraph.session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _string_requests(spark: SparkSession, requests) -> DataFrame:
    from weftgraph.sources.requests import REQUEST_SCHEMA
    names = [f.name for f in REQUEST_SCHEMA.fields]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in requests], REQUEST_SCHEMA)


def _published(spark: SparkSession, out: str, kind: str) -> DataFrame:
    return spark.read.schema("graph_id string").parquet(f"{out}/{kind}").groupBy("graph_id") \
        .agg(F.count(F.lit(1)).alias(kind))


#: Networks with a document whose account id cannot be read: (criteria, platform code, side).
FAULTY = (("crit_1", "IG", "source"), ("crit_2", "FB", "target"))


def q_requests_status_isolated(spark, sf_dir):
    """R6 through ``process_batch``: networks with unreadable documents fail with their first error, the others are published."""
    from weftgraph.streaming import process_batch
    docs = load_interactions(spark, sf_dir)
    for criteria, code, side in FAULTY:
        hit = (F.col("criteria_id") == criteria) & (F.col("platform") == code) & F.col(side).startswith("TW_")
        docs = docs.withColumn(side, F.when(hit, F.concat(F.lit("TW_x"), F.substring("post_id", 1, 8))).otherwise(F.col(side)))
    out = _batch_out(spark, "isolated")
    process_batch(spark, _string_requests(spark, DAY_REQUESTS + BAD_REQUESTS), docs, out)
    status = spark.read.schema("status string, error string, raw string, graph_id string").json(f"{out}/status")
    found = status
    for kind in ("nodes", "edges"):
        found = found.join(_published(spark, out, kind), "graph_id", "left")
    return found.select("graph_id", "status", "error", *[F.coalesce(k, F.lit(0)).cast("bigint").alias(k) for k in ("nodes", "edges")])


#: Every network at a path of its own, the first one also at a second.
PATH_REQUESTS = [{**r, "path": f"p{i}"} for i, r in enumerate(DAY_REQUESTS)] + [{**DAY_REQUESTS[0], "path": "again/p0"}]


def q_written_paths(spark, sf_dir):
    """N5 through ``process_batch``: the node and edge lines of the document at each request's own path."""
    from weftgraph.streaming import process_batch
    out = _batch_out(spark, "paths")
    process_batch(spark, _string_requests(spark, PATH_REQUESTS), load_interactions(spark, sf_dir), out)
    lines = spark.read.option("recursiveFileLookup", "true").text(f"{out}/gexf") \
        .select("value", F.regexp_extract("_metadata.file_path", "/gexf/(.*)/graph_id=", 1).alias("path"))
    return lines.groupBy("path").agg(
        F.count_if(F.trim("value").startswith("<node id")).alias("nodes"),
        F.count_if(F.trim("value").startswith("<edge id")).alias("edges"))


def q_stream_completed(spark, sf_dir):
    """R4 + R5: messages in a folder, the stream over them, and its completion records beside what was published."""
    from weftgraph.streaming import run_stream
    out = _batch_out(spark, "stream")
    _request_lines(spark, DAY_REQUESTS + BAD_REQUESTS).coalesce(1).write.text(f"{out}/messages")
    stream = run_stream(spark, f"{out}/messages", load_interactions(spark, sf_dir), f"{out}/out", f"{out}/offsets")
    stream.awaitTermination()
    done = spark.read.schema("value string, graph_id string").text(f"{out}/out/completed").withColumnRenamed("value", "message")
    for kind in ("nodes", "edges"):
        done = done.join(_published(spark, f"{out}/out", kind), "graph_id", "left")
    return done.select("graph_id", "message", *[F.coalesce(k, F.lit(0)).cast("bigint").alias(k) for k in ("nodes", "edges")])


#: Many overlapping ranges of two criteria, of lengths from an hour to three weeks.
BINNED_REQUESTS = [
    _req(None if i % 3 else "twitter", CRITERIA[i % 2],
         (str(int(MONTH[0]) + (i * 7_919_000) % 2_000_000_000), str(int(MONTH[0]) + (i * 7_919_000) % 2_000_000_000 + length)))
    for i, length in enumerate([3_600_000, 30_000_000, 200_000_000, 1_800_000_000] * 60)]


def q_sel_binned_ranges(spark, sf_dir):
    """R2 for many ranges of one criteria: documents per request through time bins."""
    b = build_graph(spark, load_interactions(spark, sf_dir), BINNED_REQUESTS, selection=TIMESTAMP_RANGE, require_target=False,
                    materialize_mode="none")
    return b.documents.groupBy("graph_id").agg(F.count(F.lit(1)).alias("documents"), F.min("post_id").alias("first_post"))


def _optional(attr: str, **kw):
    def run(spark, sf_dir):
        found = getattr(build_graph(spark, load_interactions(spark, sf_dir), DAY_REQUESTS, **kw), attr)
        return found.select("graph_id", "src", "dst", "typeedges", "text", "sourcename", "targetname", "timestamp", "post_id",
                            "sourcetype", "targettype", *(["weight"] if "weight" in found.columns else []))
    return run


def q_docs_filtered(spark, sf_dir):
    """One criteria and an inclusive millisecond range over the whole document table."""
    from weftgraph.sources.documents import filter_documents
    return filter_documents(load_interactions(spark, sf_dir), "crit_1", int(WINDOW[0]), int(WINDOW[1]))


def q_degree_filter(spark, sf_dir):
    """Vertices with degree >= 3."""
    return capops.degree_filter(cached_build(spark, sf_dir).nodes_deg, 3)


def q_gexf_sections(spark, sf_dir):
    """N5 structure: GEXF lines per network and section (0 header, 1 nodes, 2 separator, 3 edges, 4 footer)."""
    from weftgraph.sinks.gexf import gexf_lines
    b = cached_build(spark, sf_dir)
    lines = gexf_lines(b.requests.select("graph_id"), b.nodes, b.out_edges)
    return lines.groupBy("graph_id", "section").agg(F.count(F.lit(1)).alias("lines"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    node_cols = ["graph_id", "id", "name", "type"]
    return {
        "sel_day_range": _selected(DAY_RANGE),
        "sel_day_list": _selected(DAY_LIST),
        "sel_timestamp_range": _selected(TIMESTAMP_RANGE),
        "cells_explode": q_cells_explode,
        "cells_day_list": lambda s, d: q_cells_explode(s, d, DAY_LIST),
        "cells_timestamp_range": lambda s, d: q_cells_explode(s, d, TIMESTAMP_RANGE),
        "cells_extended_json": lambda s, d: q_cells_explode(s, d, extended_json=True),
        "cells_variant": q_cells_variant,
        "sel_document_store": q_sel_document_store,
        "resolve_signed_ids": q_resolve_signed_ids,
        "written_nodes": q_written("nodes"),
        "written_edges": q_written("edges"),
        "written_gexf": q_written("gexf"),
        "requests_messy": q_requests_messy,
        "docs_sample": q_docs_sample,
        "resolve_endpoints": _stage("interactions"),
        "endpoint_union": _stage("endpoints"),
        "nodes_by_name": _stage("by_name", cols=node_cols),
        "nodes_numbered": _stage("numbered", cols=node_cols),
        "nodes_final": _stage("vertices", cols=node_cols),
        "graph_vertices_default": q_graph_vertices_default,
        "edges_valid": _stage("valid_edges"),
        "deg_total": q_deg_total,
        "deg_in": q_deg_in,
        "deg_out": q_deg_out,
        "nodes_with_degree": _stage("nodes_deg"),
        "name_counts": q_name_counts,
        "degree_threshold": _thresholds(15000),
        "degree_threshold_cap40": _thresholds(SMALL_CAP),
        "nodes_capped": _stage("kept"),
        "nodes_capped_cap40": _stage("kept", cap=SMALL_CAP),
        "edges_induced": _stage("out_edges"),
        "edges_induced_cap40": _stage("out_edges", cap=SMALL_CAP),
        "nodes_edge_complete_cap40": _stage("nodes", cap=SMALL_CAP, cap_mode=capops.EDGE_COMPLETE),
        "max_degree_vertex": q_max_degree_vertex,
        "gexf_nodes": _gexf_nodes,
        "gexf_edges": _gexf_edges,
        "graph_counts": _counts(),
        "graph_counts_cap40": _counts(cap=SMALL_CAP),
        "graph_counts_day_list": _counts(DAY_LIST),
        "graph_counts_timestamp_edge_complete": _counts(TIMESTAMP_RANGE, SMALL_CAP, capops.EDGE_COMPLETE),
        "graph_counts_wide_rows": _counts(source_kind="wide"),
        "requests_interactions": q_requests_interactions,
        "requests_completed": q_requests_completed,
        "requests_status": q_requests_status,
        "docs_filtered": q_docs_filtered,
        "degree_filter_k3": q_degree_filter,
        "gexf_sections": q_gexf_sections,
        "requests_status_isolated": q_requests_status_isolated,
        "written_paths": q_written_paths,
        "stream_completed": q_stream_completed,
        "sel_binned_ranges": q_sel_binned_ranges,
        "edges_linked": _optional("valid_edges", link_non_accounts=True),
        "edges_merged": _optional("out_edges", merge_parallel_edges=True),
    }
