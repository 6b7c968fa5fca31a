"""Resolve each document to a source and a target endpoint.

An endpoint is *absent* when its key is null: id 0, name and type ``""``.  A
present endpoint whose type is the account type gets the numeric id of its
key (every ``TW_`` removed); any other present endpoint is a non-account:
id 0, name and type kept (a null type becomes ``""``).  0 is the "no
account" sentinel, never a real id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftgraph.functions.expressions import ACCOUNT_TYPE, ID_PREFIX, account_id, bad_account_id
from weftgraph.plans.broadcast import DEFAULT_MAX_BROADCAST_ROWS, size_checked_broadcast

# Fixed values (P7): the attributes every edge carries.
EDGE_ATTRIBUTES = ["typeedges", "text", "sourcename", "targetname", "timestamp", "post_id",
                   "sourcetype", "targettype"]


# Stands for a null name in a dictionary of names; no name of a document holds a zero character.
NULL_NAME = "\0null"


def _endpoint(side: str, account_type: str, id_prefix: str, on_bad: str) -> tuple[Column, Column, Column, Column]:
    key, typ, name = F.col(side), F.col(f"{side}_type"), F.col(f"{side}_name")
    present = key.isNotNull()
    is_account = present & (typ == F.lit(account_type))
    parsed = account_id(key, id_prefix, on_bad)
    error = F.when(is_account & parsed.isNull(), bad_account_id(key))
    if on_bad != "fail":
        # Lenient: an account whose id cannot be read counts as absent.
        present = present & ~(is_account & parsed.isNull())
        is_account = present & (typ == F.lit(account_type))
    ident = F.when(is_account, parsed).otherwise(F.lit(0).cast("bigint"))
    label = F.when(present, name).otherwise(F.lit(""))
    kind = F.when(present, F.coalesce(typ, F.lit(""))).otherwise(F.lit(""))
    return ident, label, kind, error


def resolve_endpoints(docs: DataFrame, account_type: str = ACCOUNT_TYPE, id_prefix: str = ID_PREFIX,
                      on_bad: str = "fail") -> DataFrame:
    """Documents (with ``graph_id``) -> the 10-column interaction table per graph.

    ``on_bad="report"`` adds ``error``: what is wrong with the document (its own
    ``error`` if it came with one), null where nothing is.
    """
    sid, sname, stype, serror = _endpoint("source", account_type, id_prefix, on_bad)
    tid, tname, ttype, terror = _endpoint("target", account_type, id_prefix, on_bad)
    found = [F.col("error")] if "error" in docs.columns else []
    errors = [F.coalesce(*found, serror, terror).alias("error")] if on_bad == "report" else []
    return docs.select(
        "graph_id",
        sid.alias("sourceid"), tid.alias("targetid"),
        sname.alias("sourcename"), tname.alias("targetname"),
        stype.alias("sourcetype"), ttype.alias("targettype"),
        F.col("type").alias("typeedges"), F.col("text"), F.col("timestamp"), F.col("post_id"), *errors,
    )


def faults_of(interactions: DataFrame) -> DataFrame:
    """``(graph_id, error)``: the networks with a faulty document and the first of their errors (map-side minima)."""
    return interactions.where(F.col("error").isNotNull()).groupBy("graph_id").agg(F.min("error").alias("error"))


def link_non_accounts(interactions: DataFrame, vertices: DataFrame,
                      max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """C4 turned on: ends that are no accounts (id 0, with a type) get the id of their vertex, found by their name.

    A vertex below 0 is a non-account with its surrogate; its name is unique in its
    network.  This dictionary is broadcast when its counted rows are few, and the interactions
    stay where they are.  Else it is joined by shuffle: its side has one row per key, so
    Spark splits a hashtag with a third of all rows, and ends that look nothing up are spread by a salt.
    A non-account whose name an account won keeps 0, as it is no vertex.
    """
    dictionary = vertices.where(F.col("id") < 0).select("graph_id", F.coalesce("name", F.lit(NULL_NAME)).alias("_name"),
                                                        F.col("id").alias("_id"))
    dictionary = size_checked_broadcast(dictionary, max_rows=max_rows)
    salt = F.concat(F.lit("\0"), F.pmod(F.xxhash64("post_id", "timestamp"), F.lit(1 << 16)).cast("string"))
    out = interactions
    for side in ("source", "target"):
        open_end = (F.col(f"{side}id") == 0) & (F.col(f"{side}type") != "")
        name = F.when(open_end, F.coalesce(f"{side}name", F.lit(NULL_NAME))).otherwise(salt)
        out = out.withColumn("_name", name).join(dictionary, ["graph_id", "_name"], "left") \
            .withColumn(f"{side}id", F.coalesce("_id", f"{side}id")).drop("_name", "_id")
    return out.select(interactions.columns)


def edges_of(interactions: DataFrame) -> DataFrame:
    """One directed edge per interaction, ``(graph_id, src, dst, attributes…)``."""
    return interactions.select(
        "graph_id", F.col("sourceid").alias("src"), F.col("targetid").alias("dst"), *EDGE_ATTRIBUTES)
