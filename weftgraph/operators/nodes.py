"""The vertex table of each network.

Every step is an aggregation keyed by ``graph_id`` plus a node attribute, so
Spark combines map-side before the shuffle: a name or an account repeated in
a third of all documents collapses to one row per task before it moves.
No window ever spans a whole network.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftgraph.plans.broadcast import DEFAULT_MAX_BROADCAST_ROWS, size_checked_broadcast

# Surrogate numbering splits each network's non-account names into buckets
# by the first hex digits of md5(name); 3 digits = 4096 buckets per network.
SURROGATE_BUCKET_DIGITS = 3


def endpoint_union(interactions: DataFrame) -> DataFrame:
    """D1 + P5 + P6: source and target endpoints with a non-empty type, as ``(graph_id, id, name, type)``."""
    ends = [F.struct(F.col(f"{side}id").alias("id"), F.col(f"{side}name").alias("name"),
                     F.col(f"{side}type").alias("type")) for side in ("source", "target")]
    return (interactions.select("graph_id", F.explode(F.array(*ends)).alias("e"))
            .select("graph_id", "e.id", "e.name", "e.type").where(F.col("type") != ""))


def distinct_endpoints(endpoints: DataFrame) -> DataFrame:
    """The distinct ``(graph_id, name, id, type)`` of a network's endpoints, with their number ``n``.

    A hash aggregate with map-side combining: an account or a name repeated in a
    third of the documents leaves each task as one row.  The count keeps the
    step in the plan; without it Catalyst would merge it into the sort-based
    ``min`` of D2 (``RemoveRedundantAggregates``).
    """
    return endpoints.groupBy("graph_id", "name", "id", "type").agg(F.count(F.lit(1)).alias("n"))


def nodes_by_name(distinct_eps: DataFrame) -> DataFrame:
    """One row per name and network.

    The winner is fixed: an account before a non-account, then the lowest id,
    then the lowest type (``min`` over a struct, combined map-side).
    """
    best = F.min(F.struct((F.col("id") == 0).alias("non_account"), F.col("id"), F.col("type")))
    return (distinct_eps.groupBy("graph_id", "name").agg(best.alias("w"))
            .select("graph_id", F.col("w.id").alias("id"), "name", F.col("w.type").alias("type")))


def losing_accounts(distinct_eps: DataFrame, by_name: DataFrame) -> DataFrame:
    """Account ids seen in a network that won no name: their edges are dropped.

    Every non-zero edge endpoint is an account endpoint, so an edge is valid
    exactly when neither end is 0 nor in this set.
    """
    seen = distinct_eps.where(F.col("id") != 0).select("graph_id", "id").distinct()
    won = by_name.where(F.col("id") != 0).select("graph_id", "id")
    return seen.join(won, ["graph_id", "id"], "left_anti")


def number_nodes(by_name: DataFrame, n_graphs: int | None = None,
                 max_rows: int = DEFAULT_MAX_BROADCAST_ROWS, distinct_eps: DataFrame | None = None) -> DataFrame:
    """D3 + D4: non-accounts get a surrogate id ``-row_id``; accounts keep theirs.

    Where a network has negative accounts (winning or losing a name), its
    surrogates start below the lowest of them, so the two never meet.

    ``row_id`` numbers a network's non-account names 1..n in the order of
    ``(md5(name), name)``.  It is computed in two levels so no task holds a
    whole network: a count per md5-prefix bucket gives each bucket its offset
    (a table of at most 4096 rows per network), and a window per
    ``(graph_id, bucket)`` numbers the names inside a bucket.
    """
    digest = F.md5(F.coalesce(F.col("name"), F.lit("")))
    non_accounts = (by_name.where(F.col("id") == 0)
                    .withColumn("_h", digest)
                    .withColumn("_b", F.substring("_h", 1, SURROGATE_BUCKET_DIGITS)))
    counts = non_accounts.groupBy("graph_id", "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("graph_id").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("graph_id", "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    lowest = (by_name if distinct_eps is None else distinct_eps).where(F.col("id") < 0) \
        .groupBy("graph_id").agg(F.min("id").alias("_low"))
    offsets = offsets.join(size_checked_broadcast(lowest, n_graphs, max_rows, count_if_unknown=False),
                           "graph_id", "left") \
        .select("graph_id", "_b", "_off", F.coalesce("_low", F.lit(0)).alias("_low"))
    bound = None if n_graphs is None else n_graphs * 16 ** SURROGATE_BUCKET_DIGITS
    offsets = size_checked_broadcast(offsets, bound, max_rows, count_if_unknown=False)
    in_bucket = Window.partitionBy("graph_id", "_b").orderBy("_h", F.col("name").asc_nulls_first())
    numbered = (non_accounts.join(offsets, ["graph_id", "_b"])
                .select("graph_id", (F.col("_low") - F.col("_off") - F.row_number().over(in_bucket)).alias("id"),
                        "name", "type"))
    accounts = by_name.where(F.col("id") != 0).select("graph_id", "id", "name", "type")
    return accounts.unionByName(numbered)


def nodes_final(numbered: DataFrame) -> DataFrame:
    """One vertex per id; when an account won several names, the lowest name labels it."""
    best = F.min(F.struct(F.col("name"), F.col("type")))
    return (numbered.groupBy("graph_id", "id").agg(best.alias("v"))
            .select("graph_id", "id", F.col("v.name").alias("name"), F.col("v.type").alias("type")))
