"""The document store as a flat table of interactions.

The document-store variant asks for ``criteria_id = c`` and ``from <= timestamp
<= to``; the flat table keeps every document as one row, so the predicates
reach the Parquet scan as pushed filters (and prune partitions when the table
is stored partitioned by ``criteria_id``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def read_documents(spark, path: str, fmt: str = "parquet") -> DataFrame:
    """A stored interaction table (Parquet by default, JSON lines with ``fmt="json"``)."""
    if fmt == "json":
        from weftgraph.sources.fixtures import INTERACTION_SCHEMA
        return spark.read.schema(INTERACTION_SCHEMA).json(path)
    return spark.read.format(fmt).load(path)


def filter_documents(docs: DataFrame, criteria_id: str, from_ms: int, to_ms: int) -> DataFrame:
    """One criteria and an inclusive millisecond range, no platform filter."""
    return docs.where((F.col("criteria_id") == criteria_id) & F.col("timestamp").between(from_ms, to_ms))


def sample_documents(docs: DataFrame, criteria_id: str, n: int = 10) -> DataFrame:
    """The first ``n`` documents of a criteria, in a fixed order (timestamp, post id)."""
    return docs.where(F.col("criteria_id") == criteria_id).orderBy("timestamp", "post_id").limit(n)


def document_counts(selected: DataFrame) -> DataFrame:
    """Documents loaded per network."""
    return selected.groupBy("graph_id").agg(F.count(F.lit(1)).alias("documents"))
