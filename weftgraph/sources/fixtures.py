"""Test inputs derived by Spark from the driver's ``events`` table.

F1 ``interactions`` (one row per document) follows the rules written down in
``FIXTURES.md``; F2 ``wide_rows`` stores the same documents as JSON cells of a
wide-row table keyed by ``criteria_|_CODE_|_yyyyMMdd``.  Both are plain
DataFrame transformations, so they scale with ``events``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftgraph.functions.expressions import ACCOUNT_TYPE, ROW_KEY_SEPARATOR

INTERACTION_SCHEMA = T.StructType([
    T.StructField("criteria_id", T.StringType()),
    T.StructField("platform", T.StringType()),
    T.StructField("day", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("source_type", T.StringType()),
    T.StructField("source_name", T.StringType()),
    T.StructField("target", T.StringType()),
    T.StructField("target_type", T.StringType()),
    T.StructField("target_name", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("post_id", T.StringType()),
])

INTERACTION_COLUMNS = [f.name for f in INTERACTION_SCHEMA.fields]

# Fixed values of the fixture rules (FIXTURES.md, "Deriving F1 from events").
CRITERIA_PREFIX = "crit_"
CRITERIA_MODULUS = 3
PLATFORM_MODULUS = 10
PLATFORM_BY_REMAINDER = {8: "FB", 9: "IG"}
DEFAULT_PLATFORM = "TW"
NULL_SOURCE_MODULUS = 53
DUP_NAME_MODULUS = 17
DUP_NAME_REMAINDER = 16
DUP_NAME = "user_dup"
USER_NAME_PREFIX = "user_"
ACCOUNT_ID_PREFIX = "TW_"
HASHTAG_ID_PREFIX = "HT_"
HASHTAG_TYPE = "TW_Hashtag"
HASHTAG_NAME_PREFIX = "#tag_"
NO_TARGET_EVENT = "error"
HASHTAG_EVENT = "signup"


def _fixture_name(x: Column) -> Column:
    return F.when(x % DUP_NAME_MODULUS == DUP_NAME_REMAINDER, F.lit(DUP_NAME)) \
        .otherwise(F.concat(F.lit(USER_NAME_PREFIX), (x + 1).cast("string")))


def interactions_from_events(events: DataFrame) -> DataFrame:
    """one interaction document per event (see FIXTURES.md)."""
    eid = F.col("event_id")
    k = F.get_json_object(F.col("props"), "$.k").cast("bigint")
    no_source = eid % NULL_SOURCE_MODULUS == 0
    etype = F.col("event_type")
    null_str = F.lit(None).cast("string")

    platform = F.lit(DEFAULT_PLATFORM)
    for remainder, code in PLATFORM_BY_REMAINDER.items():
        platform = F.when(eid % PLATFORM_MODULUS == remainder, F.lit(code)).otherwise(platform)

    def target_case(account: Column, hashtag: Column) -> Column:
        return (F.when(etype == NO_TARGET_EVENT, null_str)
                .when(etype == HASHTAG_EVENT, hashtag)
                .otherwise(account))

    return events.select(
        F.concat(F.lit(CRITERIA_PREFIX), (eid % CRITERIA_MODULUS).cast("string")).alias("criteria_id"),
        platform.alias("platform"),
        F.date_format(F.col("ts"), "yyyyMMdd").alias("day"),
        F.when(no_source, null_str).otherwise(
            F.concat(F.lit(ACCOUNT_ID_PREFIX), (F.col("user_id") + 1).cast("string"))).alias("source"),
        F.when(no_source, null_str).otherwise(F.lit(ACCOUNT_TYPE)).alias("source_type"),
        F.when(no_source, null_str).otherwise(_fixture_name(F.col("user_id"))).alias("source_name"),
        target_case(F.concat(F.lit(ACCOUNT_ID_PREFIX), (k + 1).cast("string")),
                    F.concat(F.lit(HASHTAG_ID_PREFIX), k.cast("string"))).alias("target"),
        target_case(F.lit(ACCOUNT_TYPE), F.lit(HASHTAG_TYPE)).alias("target_type"),
        target_case(_fixture_name(k), F.concat(F.lit(HASHTAG_NAME_PREFIX), k.cast("string"))).alias("target_name"),
        etype.alias("type"),
        F.col("props").alias("text"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"),
        F.md5(eid.cast("string")).alias("post_id"),
    )


def load_interactions(spark, sf_dir: str) -> DataFrame:
    """F1 from ``<sf_dir>/events.parquet``."""
    return interactions_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


def wide_rows(interactions: DataFrame, cells_per_row: int = 10000, extended_json: bool = False) -> DataFrame:
    """documents as JSON cells of wide rows ``(row_key, chunk, cells)``.

    A logical wide row (one criteria, platform and day) is cut into physical
    rows of about ``cells_per_row`` cells, so no single map holds an unbounded
    day: the number of chunks of a key comes from its document count, and a
    document's chunk from a hash of its post id.  ``extended_json`` writes the
    timestamp as ``{"$numberLong": "…"}``.
    """
    fields = {c: F.col(c) for c in INTERACTION_COLUMNS}
    if extended_json:
        fields["timestamp"] = F.struct(F.col("timestamp").cast("string").alias("$numberLong"))
    docs = interactions.select(
        F.concat_ws(ROW_KEY_SEPARATOR, "criteria_id", "platform", "day").alias("row_key"),
        F.col("post_id").alias("qualifier"),
        F.to_json(F.struct(*[v.alias(c) for c, v in fields.items()])).alias("value"),
    )
    sizes = docs.groupBy("row_key").agg(
        F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / F.lit(cells_per_row))).cast("int").alias("n_chunks"))
    return (docs.join(sizes, "row_key")
            .withColumn("chunk", F.pmod(F.xxhash64("qualifier"), F.col("n_chunks")).cast("int"))
            .groupBy("row_key", "chunk")
            .agg(F.map_from_entries(F.collect_list(F.struct("qualifier", "value"))).alias("cells")))
