"""Operator 12: exact duplicates by counting quotient filters.

1. Every normalised text (A-Z lower-cased, null as empty) gets a fingerprint of ``BITS`` bits and its
   SHA-256, in the JVM; the narrow rows are written once.
2. Every task builds counting quotient filters of its fingerprints, one per range of them (``quotient``):
   a text with a third of all rows is one entry with a count.  The filters of a range meet in one task, which
   merges them by their sorted remainders; the merged ones are an output of their own (``filters``), which
   merge with those of later documents.
3. Fingerprints with a count above one route their documents to byte verification: these texts are
   grouped by all their bytes (map-side first, so a task sends a text once).  The others are alone.
4. The verified groups go back to the narrow rows by fingerprint and SHA-256; if two different
   texts shared both, the job would stop rather than join them.

Of equal texts the largest ``doc_id`` stays; a null ``doc_id`` is below all others (``keep_id`` is null where a
group has no other).  Of repeated rows with that doc_id exactly one is kept.  A null text equals an empty one.
Whole texts count, however long.  An empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import quotient
from .common import ascii_lower, prepare_workers, read, shuffle_partitions, stash

BITS = 56
TASK_FINGERPRINTS, SHARD_FINGERPRINTS = 1 << 21, 1 << 21
MAX_BROADCAST_ROWS = 1_000_000  # two or three narrow columns each


def normalised():
    return ascii_lower(F.coalesce(F.col("text"), F.lit("")))


def fingerprint(text):
    return F.shiftrightunsigned(F.xxhash64(text), 64 - BITS)


def narrow_rows(docs: DataFrame) -> DataFrame:
    """doc_id, fp, sha (hex) and row (a number of the row) of every document; written, as row must not change."""
    text = normalised()
    return stash(docs.select("doc_id", text.alias("t")).select(
        "doc_id", fingerprint(F.col("t")).alias("fp"), F.sha2("t", 256).alias("sha"),
        F.monotonically_increasing_id().alias("row")), "narrow")


def _shard_bits(n: int) -> int:
    """Ranges of fingerprints, so that a merged filter has about SHARD_FINGERPRINTS of them."""
    return max(0, -(-n // SHARD_FINGERPRINTS) - 1).bit_length()


def filters(narrow: DataFrame, shard_bits: int) -> DataFrame:
    """shard, filter: the merged counting quotient filter of each range of fingerprints (their first ``shard_bits`` bits)."""
    spark = narrow.sparkSession
    prepare_workers(spark)
    low_bits = BITS - shard_bits

    def built(batches):
        held, size = [], 0

        def out():
            values, counts = quotient.summed(np.concatenate(held), np.ones(size, np.int64))
            shard = (values >> np.uint64(low_bits)).astype(np.int64)
            low = values & np.uint64((1 << low_bits) - 1)
            cuts = np.append(np.flatnonzero(np.append(True, shard[1:] != shard[:-1])), len(shard))
            for i, j in zip(cuts[:-1], cuts[1:]):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard[i]], pa.int64()), pa.array([quotient.build(low[i:j], counts[i:j], low_bits)], pa.binary())],
                    ["shard", "filter"])

        for batch in batches:
            if batch.num_rows:
                held.append(np.sort(batch.column(0).to_numpy().astype(np.uint64)))
                size += batch.num_rows
                if size >= TASK_FINGERPRINTS:
                    yield from out()
                    held, size = [], 0
        if size:
            yield from out()

    def merged(batches):
        shard, held, size = None, [], 0

        def out():
            data = held[0] if len(held) == 1 else quotient.merge(held, low_bits)
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([data], pa.binary())], ["shard", "filter"])

        for batch in batches:
            for s, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if s != shard:
                    if held:
                        yield out()
                    shard, held, size = s, [], 0
                held.append(data)
                size += len(data)
                if len(held) > 1 and size > (64 << 20):
                    held = [quotient.merge(held, low_bits)]
                    size = 0
        if held:
            yield out()

    tasks = min(shuffle_partitions(spark), 1 << shard_bits)
    return narrow.select("fp").mapInArrow(built, "shard long, filter binary") \
        .repartition(tasks, "shard").sortWithinPartitions("shard").mapInArrow(merged, "shard long, filter binary")


def repeated(found: DataFrame, shard_bits: int) -> DataFrame:
    """fp, copies: the fingerprints whose count in the merged ``filters`` is above one."""
    low_bits = BITS - shard_bits

    def counted(batches):
        for batch in batches:
            for shard, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                f = quotient.Filter(data)
                high = np.uint64(shard << low_bits)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((f.values()[f.counted] | high).astype(np.int64)), pa.array(f.counts[f.counted])], ["fp", "copies"])

    return found.mapInArrow(counted, "fp long, copies long")


def _small(table: DataFrame) -> DataFrame:
    """A written table, broadcast where its counted rows are few; else Spark joins by shuffle and splits hot keys."""
    return F.broadcast(table) if table.count() <= MAX_BROADCAST_ROWS else table


def verified_groups(docs: DataFrame, suspects: DataFrame) -> DataFrame:
    """fp, sha, keep_id, n: the groups of byte-equal texts among the documents with a repeated fingerprint."""
    texts = docs.select("doc_id", normalised().alias("t")).withColumn("fp", fingerprint(F.col("t"))) \
        .join(suspects.select("fp"), "fp", "left_semi")
    by_bytes = texts.groupBy("fp", "t").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    one = by_bytes.groupBy("fp", F.sha2("t", 256).alias("sha")).agg(
        F.max("keep_id").alias("keep_id"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts"))
    return one.select("fp", "sha", "keep_id", F.when(F.col("texts") == 1, F.col("n")).otherwise(
        F.raise_error(F.lit("different texts with one fingerprint and one SHA-256"))).alias("n"))


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per row of ``docs`` (doc_id, text)."""
    narrow = narrow_rows(docs)
    shard_bits = _shard_bits(narrow.count())
    suspects = _small(stash(repeated(filters(narrow, shard_bits), shard_bits), "repeated"))
    # of the rows with the largest doc_id one stays
    top = narrow.join(suspects.select("fp"), "fp", "left_semi").groupBy("fp", "sha").agg(
        F.coalesce(F.max_by("row", "doc_id"), F.max("row")).alias("keep_row"))
    groups = _small(stash(verified_groups(docs, suspects).join(top, ["fp", "sha"], "left"), "groups"))
    alone = F.col("n").isNull()
    return narrow.join(groups, ["fp", "sha"], "left").select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"), F.col("sha").alias("text_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(read(spark, sf_dir, "documents"))


ORACLE = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
           FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS n FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, CAST(g.n AS BIGINT) AS group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t
"""
