"""The networks as node and edge tables, partitioned by ``graph_id``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftgraph.sinks.files import Files
from weftgraph.sinks.gexf import gexf_edges, gexf_nodes, partition_dir


def write_table(df: DataFrame, path: str, fmt: str = "parquet", graph_ids: DataFrame | None = None) -> None:
    """Write so that only the networks present are replaced (dynamic partition overwrite).

    The rows are rebalanced by network first, so that a network has few files
    (AQE splits a large one).  ``graph_ids`` names the networks asked for: then the
    table is written beside and its folders moved once the job is done, and a network that
    became empty loses its old folder, so a failing job changes nothing (an
    error on Spark Connect, where folders can't be moved).
    """
    rows = df.hint("rebalance", F.col("graph_id")).write.partitionBy("graph_id").format(fmt)
    if graph_ids is None:
        rows.mode("overwrite").option("partitionOverwriteMode", "dynamic").save(path)
        return
    files, staged = Files(df.sparkSession), f"{path}/_staged-{uuid.uuid4().hex}"
    rows.save(staged)
    have = {n for n in files.names(staged) if n.startswith("graph_id=")}
    for name in sorted(have):
        files.move(f"{staged}/{name}", f"{path}/{name}")
    for row in graph_ids.distinct().toLocalIterator():
        if partition_dir(row[0]) not in have:
            files.delete(f"{path}/{partition_dir(row[0])}")
    files.delete(staged)


def write_tables(nodes: DataFrame, edges: DataFrame, path: str, fmt: str = "parquet",
                 graph_ids: DataFrame | None = None) -> None:
    """N1/N2 rows of every network under ``path/nodes`` and ``path/edges``."""
    write_table(gexf_nodes(nodes), f"{path}/nodes", fmt, graph_ids)
    write_table(gexf_edges(edges), f"{path}/edges", fmt, graph_ids)
