"""Connected components by contracting edges within tasks and halving what is left of the chains."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_partitions, stash

CONTRACT_EDGES = 1 << 20


def contract(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of the edges that is not the smallest of its component, with that smallest node."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y, up = at[:len(a)], at[len(a):], np.arange(len(nodes))
    while True:
        p, q = up[x], up[y]
        apart = p != q
        if not apart.any():
            break
        x, y, p, q = x[apart], y[apart], p[apart], q[apart]
        np.minimum.at(up, np.maximum(p, q), np.minimum(p, q))
        while (up != (over := up[up])).any():
            up = over
    low = np.flatnonzero(up != np.arange(len(up)))
    return nodes[low], nodes[up[low]]


def _contracted(batches):
    """Edges (u, v) with v < u of the same components; a task holds CONTRACT_EDGES at a time."""
    held, size = [], 0

    def out():
        u, v = contract(*(np.concatenate([h[i] for h in held]) for i in (0, 1)))
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    for batch in batches:
        if batch.num_rows:
            held.append([batch.column(i).to_numpy() for i in (0, 1)])
            size += batch.num_rows
            if size >= CONTRACT_EDGES:
                yield out()
                held, size = [], 0
    if held:
        yield out()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """node, component (its smallest reachable node) of every node of ``edges`` (a, b; in any direction, repeats allowed).

    Each round contracts the edges where they lie, so that a task sends a node
    once however many edges it has, brings a node's edges together, contracts
    again, and then hangs every node on the smallest node that its own one hangs
    on.  All of it keeps together what belongs together and only lowers the nodes
    hung on.  The join on these reads two written tables, so Spark can split a
    node with a third of all others.  The rounds end when no node hangs on two
    others or on one that hangs itself; the written rows tell.  They grow with the
    logarithm of the longest chain, not with the number of nodes.
    """
    tasks = shuffle_partitions(edges.sparkSession)
    now = edges.select(F.col("a").cast("long").alias("u"), F.col("b").cast("long").alias("v")).where("u <> v")
    for _ in range(max_rounds):
        met = stash(now.mapInArrow(_contracted, "u long, v long").repartition(tasks, "u")
                    .mapInArrow(_contracted, "u long, v long"), "met")
        lows = stash(met.groupBy("u").agg(F.min("v").alias("low"), F.max("v").alias("high")), "lows")
        over = lows.select(F.col("u").alias("v"), "low")
        moved = met.join(over, "v", "left").select("u", F.coalesce("low", "v").alias("v"), F.col("low").isNotNull().alias("open"))
        torn = lows.where("low < high").select("u", F.col("low").alias("v"), F.lit(True).alias("open"))
        written = stash(moved.unionByName(torn), "links")
        now = written.select("u", "v")
        if written.where("open").isEmpty():
            break
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.col("v").alias("component")),
                                        F.struct(F.col("v").alias("node"), F.col("v").alias("component")))).alias("e")) \
        .select("e.node", "e.component").distinct()
