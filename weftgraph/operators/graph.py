"""Graph operators (vertex joins, subgraphs, degrees, counts) as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftgraph.functions.expressions import MISSING_NAME, MISSING_TYPE
from weftgraph.plans.broadcast import DEFAULT_MAX_BROADCAST_ROWS, size_checked_broadcast


def valid_edges(edges: DataFrame, losers: DataFrame, losers_rows: int | None = None,
                count_if_unknown: bool = False, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """G1 + G2: keep the edges whose both ends are vertices.

    An end is not a vertex when it is 0 (absent or non-account) or an account
    that won no name (``losers``).  Instead of two semi joins of the edges with
    the whole vertex table, the edges are anti-joined with the losing ids, a set
    that is usually tiny: broadcast when its size is known to be small (a
    count, or the file statistics of a materialised table checked by Spark's
    broadcast threshold), so the edges are filtered where they are read, with
    no shuffle; a shuffle join otherwise.
    """
    kept = edges.where((F.col("src") != 0) & (F.col("dst") != 0))
    lost = size_checked_broadcast(losers, losers_rows, max_rows, count_if_unknown=count_if_unknown)
    lost_src = lost.select("graph_id", F.col("id").alias("src"))
    lost_dst = lost.select("graph_id", F.col("id").alias("dst"))
    return kept.join(lost_src, ["graph_id", "src"], "left_anti").join(lost_dst, ["graph_id", "dst"], "left_anti")


def vertices_with_default(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """G1: the vertices of ``Graph(vertices, edges, default)``.

    Edge ends that are not vertices get the default attribute ``("name",
    "Missing")``.
    """
    ends = (edges.select("graph_id", F.explode(F.array("src", "dst")).alias("id"))
            .distinct()
            .join(vertices.select("graph_id", "id"), ["graph_id", "id"], "left_anti")
            .select("graph_id", "id", F.lit(MISSING_NAME).alias("name"), F.lit(MISSING_TYPE).alias("type")))
    return vertices.select("graph_id", "id", "name", "type").unionByName(ends)


def merge_parallel_edges(edges: DataFrame) -> DataFrame:
    """C8 turned on: one edge per (network, src, dst) with the number of its parallels as ``weight``.

    Its attributes are those of one whole row, the earliest by (timestamp, post
    id, then the other attributes).  Both the number and that row combine map-side, so a pair
    with a third of all edges is one row per task in the shuffle.
    """
    attributes = [c for c in ("timestamp", "post_id", *edges.columns) if c not in ("graph_id", "src", "dst")]
    attributes = list(dict.fromkeys(attributes))
    one = edges.groupBy("graph_id", "src", "dst").agg(
        F.min(F.struct(*attributes)).alias("_first"), F.count(F.lit(1)).alias("weight"))
    return one.select(*[F.col(c) if c in ("graph_id", "src", "dst") else F.col(f"_first.{c}") for c in edges.columns],
                      F.col("weight").cast("double").alias("weight"))


def degrees(edges: DataFrame) -> DataFrame:
    """G4–G6 in one aggregation: ``(graph_id, id, in_degree, out_degree, degree)``.

    Each edge counts once at each end; a self-loop counts 2 in ``degree``;
    parallel edges count each time.  The aggregation combines map-side, so a hub
    costs one row per task in the shuffle.
    """
    ends = edges.select("graph_id", F.explode(F.array(
        F.struct(F.col("src").alias("id"), F.lit(0).alias("i"), F.lit(1).alias("o")),
        F.struct(F.col("dst").alias("id"), F.lit(1).alias("i"), F.lit(0).alias("o")))).alias("e"))
    return (ends.groupBy("graph_id", F.col("e.id").alias("id"))
            .agg(F.sum("e.i").cast("bigint").alias("in_degree"), F.sum("e.o").cast("bigint").alias("out_degree"))
            .withColumn("degree", F.col("in_degree") + F.col("out_degree")))


def nodes_with_degree(vertices: DataFrame, degs: DataFrame) -> DataFrame:
    """Vertices outer-joined with their degrees, 0 when the vertex has no edge."""
    joined = vertices.join(degs, ["graph_id", "id"], "left")
    return joined.select(
        "graph_id", "id", "name", "type",
        F.coalesce("in_degree", F.lit(0).cast("bigint")).alias("in_degree"),
        F.coalesce("out_degree", F.lit(0).cast("bigint")).alias("out_degree"),
        F.coalesce("degree", F.lit(0).cast("bigint")).alias("degree"))


def name_counts(vertices: DataFrame) -> DataFrame:
    """G8 + G9: vertices per name, summed per network (= the vertex count, not the distinct names)."""
    per_name = vertices.groupBy("graph_id", "name").agg(F.count(F.lit(1)).alias("n"))
    return per_name.groupBy("graph_id").agg(
        F.sum("n").cast("bigint").alias("n_vertices"), F.count(F.lit(1)).alias("n_names"))


def max_degree_vertex(nodes_deg: DataFrame, n_graphs: int | None = None) -> DataFrame:
    """The vertex of highest degree per network; ties go to the lowest id.

    Two hash aggregations: the top degree per network (one row per network,
    broadcast), then the lowest id among the vertices that reach it.
    """
    top = nodes_deg.groupBy("graph_id").agg(F.max("degree").alias("top"))
    top = size_checked_broadcast(top, n_graphs, count_if_unknown=False)
    return (nodes_deg.join(top, "graph_id").where(F.col("degree") == F.col("top"))
            .groupBy("graph_id").agg(F.min("id").alias("id"), F.max("degree").alias("degree")))
