"""Keep the best-connected vertices of each network under a size cap.

The reference raises a minimum degree ``i = 0, 1, 2, …`` one job at a time
until at most ``cap`` vertices have ``degree >= i``.  Here the threshold of
every network comes from one pass over its degree histogram: with ``running(d)``
the number of vertices of degree ``>= d``, the answer is ``k = 1 + max{d :
running(d) > cap}``, or ``k = 1`` when no degree qualifies (the network
already fits, and the reference then keeps ``degree > 0``).  The histogram
has one row per distinct degree, so its window is small whatever the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftgraph.plans.broadcast import DEFAULT_MAX_BROADCAST_ROWS, size_checked_broadcast

INDUCED = "induced"              # G13: edges among kept vertices only (wide-row variant)
EDGE_COMPLETE = "edge_complete"  # G14: every valid edge, its ends put back (document variant)
CAP_MODES = (INDUCED, EDGE_COMPLETE)


def thresholds_k(nodes_deg: DataFrame, cap: int) -> DataFrame:
    """``(graph_id, n_vertices, k)`` per network, from the degree histogram."""
    hist = nodes_deg.groupBy("graph_id", "degree").agg(F.count(F.lit(1)).alias("n"))
    down = Window.partitionBy("graph_id").orderBy(F.col("degree").desc()) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hist = hist.withColumn("running", F.sum("n").over(down))
    k = F.coalesce(F.max(F.when(F.col("running") > cap, F.col("degree"))) + 1, F.lit(1).cast("bigint"))
    return hist.groupBy("graph_id").agg(F.sum("n").cast("bigint").alias("n_vertices"), k.alias("k"))


def degree_thresholds(nodes_deg: DataFrame, cap: int) -> DataFrame:
    """G11 report: ``(graph_id, n_vertices, k, n_kept)`` per network."""
    ks = thresholds_k(nodes_deg, cap)
    kept = (nodes_deg.join(ks.select("graph_id", "k"), "graph_id").where(F.col("degree") >= F.col("k"))
            .groupBy("graph_id").agg(F.count(F.lit(1)).alias("n_kept")))
    return ks.join(kept, "graph_id", "left").select(
        "graph_id", "n_vertices", "k", F.coalesce("n_kept", F.lit(0)).cast("bigint").alias("n_kept"))


def degree_filter(nodes_deg: DataFrame, k: int) -> DataFrame:
    """G10 (and G12 with ``k = 1``): vertices with ``degree >= k``."""
    return nodes_deg.where(F.col("degree") >= k)


def capped_nodes(nodes_deg: DataFrame, thresholds: DataFrame, n_graphs: int | None = None,
                 max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """The kept vertices, ``degree >= k`` of their network."""
    ks = size_checked_broadcast(thresholds.select("graph_id", "k"), n_graphs, max_rows, count_if_unknown=False)
    return nodes_deg.join(ks, "graph_id").where(F.col("degree") >= F.col("k")).drop("k")


def induced_edges(valid: DataFrame, kept: DataFrame, kept_rows: int | None = None,
                  max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Valid edges with both ends kept.

    ``kept`` has at most ``cap`` rows per network, so ``kept_rows`` (cap x
    networks) is a proven bound; under the broadcast limit the edges are
    filtered where they are read.
    """
    ids = size_checked_broadcast(kept.select("graph_id", "id"), kept_rows, max_rows, count_if_unknown=False)
    return (valid.join(ids.withColumnRenamed("id", "src"), ["graph_id", "src"], "left_semi")
            .join(ids.withColumnRenamed("id", "dst"), ["graph_id", "dst"], "left_semi"))


def edge_complete_nodes(kept: DataFrame, valid: DataFrame) -> DataFrame:
    """G14 + N3: kept vertices plus the ends of every valid edge.

    The first writer of an id wins: a kept vertex before an edge end; between
    edge ends, the lowest ``(name, type)`` (the reference's order is the
    collect order, so any fixed rule is one of its outcomes).
    """
    first = kept.select("graph_id", "id", F.lit(0).alias("priority"), "name", "type")
    ends = valid.select("graph_id", F.explode(F.array(
        F.struct(F.col("dst").alias("id"), F.col("targetname").alias("name"), F.col("targettype").alias("type")),
        F.struct(F.col("src").alias("id"), F.col("sourcename").alias("name"), F.col("sourcetype").alias("type")),
    )).alias("e")).select("graph_id", "e.id", F.lit(1).alias("priority"), "e.name", "e.type").distinct()
    best = F.min(F.struct("priority", "name", "type"))
    return (first.unionByName(ends).groupBy("graph_id", "id").agg(best.alias("b"))
            .select("graph_id", "id", F.col("b.name").alias("name"), F.col("b.type").alias("type")))
