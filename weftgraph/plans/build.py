"""The whole lifecycle as one DataFrame plan keyed by ``graph_id``.

requests -> R1/S3/S4 -> R2 (one join for all requests) -> P1–P7 -> D1–D5 ->
G1–G7 -> G11/G12 -> G13 or G14 -> output node and edge tables.

Nothing is collected.  Frames that later steps read more than once are written
as Parquet tables under ``spark.checkpoint.dir`` and read back
(``materialize_mode="table"``): the resolved interactions, the vertex table
with the losing ids (one job), and the valid edges when their anti join has to
shuffle (otherwise they are a broadcast filter over the interactions table);
the node-sized vertices with degrees and the kept vertices are persisted.
That cuts lineage (a lost executor costs a re-read, not a re-run of the
shuffles behind it) and gives later joins real file statistics.
Broadcasts are limited to frames with a proven row bound: the request table
(days x requests), the per-network thresholds (one row per network), the
surrogate offsets (4096 per network), the kept vertices (at most ``cap`` per
network, or their count), and the losing ids when their count is under the
limit.  Everything else is left to shuffle joins with AQE skew
splitting.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from weftgraph.functions.expressions import ACCOUNT_TYPE, DEFAULT_CAP, ID_PREFIX, day_of_millis
from weftgraph.operators import cap as capops
from weftgraph.operators import graph as graphops
from weftgraph.operators import nodes as nodeops
from weftgraph.operators import resolve as resolveops
from weftgraph.operators.resolve import edges_of, faults_of, resolve_endpoints
from weftgraph.operators.select import boxes_of, pushdown_predicate, request_boxes, select_documents
from weftgraph.plans.broadcast import DEFAULT_MAX_BROADCAST_ROWS, size_checked_broadcast
from weftgraph.session import materialize, materialize_together
from weftgraph.sources.requests import (DAY_LIST, DAY_RANGE, MS_PER_DAY, SELECTIONS, TIMESTAMP_RANGE, day_count,
                                        normalize_requests, requests_frame, unique_requests)
from weftgraph.sources.widerow import key_range_predicate, select_from_wide_rows


@dataclass
class GraphBuild:
    """Every stage of a build, as lazy (or materialised) DataFrames."""

    requests: DataFrame
    documents: DataFrame
    interactions: DataFrame
    endpoints: DataFrame
    by_name: DataFrame
    numbered: DataFrame
    vertices: DataFrame
    losers: DataFrame
    edges: DataFrame
    valid_edges: DataFrame
    degrees: DataFrame
    nodes_deg: DataFrame
    thresholds: DataFrame
    kept: DataFrame
    nodes: DataFrame
    out_edges: DataFrame
    faults: DataFrame | None = None
    params: dict = field(default_factory=dict)
    tables: list = field(default_factory=list)

    def release(self) -> None:
        """Delete the tables this build wrote under the checkpoint directory.

        Call it once the outputs are written; frames of this build are unusable after.
        """
        from weftgraph.session import remove_paths
        self.kept.unpersist()
        self.nodes_deg.unpersist()
        remove_paths(self.requests.sparkSession, self.tables)
        self.tables.clear()


def _request_bound(requests: Sequence[Mapping] | None, selection: str) -> int | None:
    """Rows of the expanded request table: at most one per request and day (and one per request)."""
    if requests is None:
        return None
    days_mode = DAY_RANGE if selection == DAY_RANGE else DAY_LIST
    try:
        return sum(max(1, day_count(days_mode, int(r["from"]), int(r["to"]))) for r in requests)
    except (KeyError, TypeError, ValueError):
        return None


ON_BAD = ("fail", "drop", "report")


def _without_faults(resolved: DataFrame, keep: str, tables: list, n_graphs: int,
                    max_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """The interactions of the networks without a faulty document, and the others with their errors (None: no faults).

    The faulty documents are counted by the job that writes the interactions, so
    a build without any costs nothing more; else one row per network is anti-joined.
    """
    seen = Observation()
    counted = resolved.observe(seen, F.count("error").alias("faulty")) if keep == "table" else resolved
    interactions = materialize(counted, keep, "interactions", tables)
    if keep == "table" and not seen.get["faulty"]:
        return interactions.drop("error"), None
    faults = materialize(faults_of(interactions), keep, "faults", tables)
    lost = size_checked_broadcast(faults.select("graph_id"), n_graphs, max_rows)
    return interactions.drop("error").join(lost, "graph_id", "left_anti"), faults


def build_graph(spark: SparkSession, source: DataFrame, requests, *, selection: str = DAY_RANGE,
                source_kind: str = "flat", cap: int = DEFAULT_CAP, cap_mode: str = capops.INDUCED,
                account_type: str = ACCOUNT_TYPE, id_prefix: str = ID_PREFIX,
                require_target: bool = True, on_bad: str = "fail", strict_requests: bool = True,
                materialize_mode: str = "table", rebalance: bool = False,
                max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                ignore_platform: bool = False, link_non_accounts: bool = False,
                merge_parallel_edges: bool = False) -> GraphBuild:
    """Build the networks of all ``requests`` from ``source`` in one plan.

    ``source`` is the flat interaction table (``source_kind="flat"``) or the
    wide-row table (``source_kind="wide"``).  ``requests`` is a list of request
    dicts (``path, platform, criteria_id, from, to``, optionally ``graph_id``)
    or a DataFrame with those string columns.  ``ignore_platform`` (timestamp
    range only) serves every request from all platforms, as the document-store
    variant does; the documents then need no ``platform`` column.

    The selection does not shuffle, so the interaction table gets one file per
    input split; ``rebalance=True`` adds Spark's ``rebalance`` hint (one shuffle
    of the selected rows, AQE-sized output files) for very selective requests
    over very large inputs, where those files would be tiny and many.

    ``link_non_accounts`` (off: such edges end nowhere and go) ties the edges of non-accounts
    to their vertices; ``merge_parallel_edges`` (off: each interaction is an edge) gives
    one output edge per pair of vertices, with their number as ``weight``.  Degrees and
    the cap count every interaction either way.

    ``on_bad``: a document that cannot be read stops the build (``"fail"``), is
    left out (``"drop"``), or takes its networks out of the build, which goes on with
    the others (``"report"``): ``faults`` names them with their errors, null when there are none.
    """
    if on_bad not in ON_BAD:
        raise ValueError(f"on_bad must be one of {ON_BAD}")
    if selection not in SELECTIONS:
        raise ValueError(f"selection must be one of {SELECTIONS}")
    if cap_mode not in capops.CAP_MODES:
        raise ValueError(f"cap_mode must be one of {capops.CAP_MODES}")
    if ignore_platform and selection != TIMESTAMP_RANGE:
        raise ValueError("ignore_platform needs selection='timestamp_range'")
    request_list = None
    if isinstance(requests, DataFrame):
        req_df = requests.withColumn("platform", F.lit(None).cast("string")) if ignore_platform else requests
    else:
        if ignore_platform:
            requests = [{**r, "platform": None} for r in requests]
        request_list = unique_requests(requests, selection)
        req_df = requests_frame(spark, request_list)
    normalized = normalize_requests(req_df, selection, strict_requests, dedupe=request_list is None)
    # What prunes the documents: literal boxes that cover the requests, at most MAX_BOXES whatever their number.
    boxes = None
    if request_list is not None:
        n_graphs, request_rows = len(request_list), _request_bound(request_list, selection)
        if strict_requests:
            boxes = boxes_of(request_list)
    else:
        n_graphs, request_rows = normalized.agg(F.count(F.lit(1)), F.sum(
            F.floor(F.abs(F.col("to_ms") - F.col("from_ms")) / MS_PER_DAY) + 2)).first()
        boxes = request_boxes(normalized)
        # A table of requests prunes partitions at run time too; Spark looks for a selective filter to do so.
        normalized = normalized.where(F.col("criteria_id") >= "")

    # R2 + P1: the documents of every request.
    if source_kind == "flat":
        src = source
        if "day" not in src.columns:  # a document store without day keys: S4 on the timestamp
            if boxes:  # bounds that reach the scan; two days' margin for any time zone
                src = src.where(F.col("timestamp").between(min(b.lo for b in boxes) - 2 * MS_PER_DAY,
                                                           max(b.hi for b in boxes) + 2 * MS_PER_DAY))
            src = src.withColumn("day", day_of_millis(F.col("timestamp")))
        if boxes is not None:
            src = src.where(pushdown_predicate(boxes, selection, "day" in source.columns, request_list is None))
        documents = select_documents(src, normalized, selection, require_target, request_rows, max_broadcast_rows,
                                     n_graphs)
    elif source_kind == "wide":
        src = source
        if boxes is not None:
            src = src.where(key_range_predicate(boxes, selection))
        documents = select_from_wide_rows(src, normalized, selection, require_target, on_bad, request_rows,
                                          max_broadcast_rows, n_graphs)
    else:
        raise ValueError("source_kind must be 'flat' or 'wide'")

    # The interaction table; read by the node and the edge branches.
    keep = materialize_mode
    tables: list = []
    resolved = resolve_endpoints(documents, account_type, id_prefix, on_bad)
    if rebalance:
        resolved = resolved.hint("rebalance")
    faults = None
    if on_bad == "report":
        interactions, faults = _without_faults(resolved, keep, tables, n_graphs, max_broadcast_rows)
    else:
        interactions = materialize(resolved, keep, "interactions", tables)

    # Vertices, from the distinct endpoints: one scan of the interactions, written once (node-sized after
    # map-side combining).  The vertex table and the losing ids come from that table in one job.
    endpoints = nodeops.endpoint_union(interactions)
    distinct_eps = materialize(nodeops.distinct_endpoints(endpoints), keep, "endpoints", tables)
    by_name = nodeops.nodes_by_name(distinct_eps)
    numbered = nodeops.number_nodes(by_name, n_graphs, max_broadcast_rows, distinct_eps)
    node_tables = materialize_together(
        {"vertices": nodeops.nodes_final(numbered), "losers": nodeops.losing_accounts(distinct_eps, by_name)},
        keep, "node_tables", tables)
    vertices, losers = node_tables["vertices"], node_tables["losers"]
    # The bound is their real number (of a table, from its footers): compressed bytes say little of a hash relation.
    losers_rows = losers.count() if keep != "none" else None
    losers_broadcast = losers_rows is not None and losers_rows <= max_broadcast_rows

    # Valid edges, read by degrees, the cap and the output.  With a broadcast
    # anti join they are a filter over the interactions table, as cheap to re-derive
    # as to re-read; behind a shuffle join they are written as a table.
    linked = interactions
    if link_non_accounts:
        linked = materialize(resolveops.link_non_accounts(interactions, vertices, max_broadcast_rows), keep, "linked", tables)
    edges = edges_of(linked)
    valid = graphops.valid_edges(edges, losers, losers_rows, max_rows=max_broadcast_rows)
    if not losers_broadcast:
        valid = materialize(valid, keep, "valid_edges", tables)
    degs = graphops.degrees(valid)
    # Node-sized and read only by the cap below: kept in executor storage.
    nodes_deg = materialize(graphops.nodes_with_degree(vertices, degs), "persist" if keep != "none" else "none")

    # G11/G12 and G13/G14.
    thresholds = capops.degree_thresholds(nodes_deg, cap)
    # At most ``cap`` rows per network; read by the node output and both edge semi joins.
    kept = materialize(capops.capped_nodes(nodes_deg, capops.thresholds_k(nodes_deg, cap), n_graphs,
                                           max_broadcast_rows),
                       "persist" if keep != "none" else "none")
    kept_bound = cap * n_graphs
    if kept_bound > max_broadcast_rows:  # the proven bound is too weak: their real number
        kept_bound = kept.count() if cap_mode == capops.INDUCED and keep != "none" else None
    if cap_mode == capops.INDUCED:
        out_nodes = kept.select("graph_id", "id", "name", "type")
        out_edges = capops.induced_edges(valid, kept, kept_bound, max_broadcast_rows)
    else:
        out_nodes = capops.edge_complete_nodes(kept, valid)
        out_edges = valid
    if merge_parallel_edges:
        out_edges = graphops.merge_parallel_edges(out_edges)

    return GraphBuild(
        requests=normalized, documents=documents, interactions=interactions, endpoints=endpoints,
        by_name=by_name, numbered=numbered, vertices=vertices, losers=losers, edges=edges,
        valid_edges=valid, degrees=degs, nodes_deg=nodes_deg, thresholds=thresholds, kept=kept,
        nodes=out_nodes, out_edges=out_edges, faults=faults,
        params=dict(selection=selection, cap=cap, cap_mode=cap_mode, n_graphs=n_graphs), tables=tables,
    )


def graph_counts(build: GraphBuild) -> DataFrame:
    """Nodes and edges of each requested network (0 for an empty one)."""
    n = build.nodes.groupBy("graph_id").agg(F.count(F.lit(1)).alias("nodes"))
    e = build.out_edges.groupBy("graph_id").agg(F.count(F.lit(1)).alias("edges"))
    return (build.requests.select("graph_id").join(n, "graph_id", "left").join(e, "graph_id", "left")
            .select("graph_id", F.coalesce("nodes", F.lit(0)).cast("bigint").alias("nodes"),
                    F.coalesce("edges", F.lit(0)).cast("bigint").alias("edges")))
