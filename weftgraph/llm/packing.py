"""Operator 2: best-fit packing by length-histogram planning.

1. Every document is tokenised whole and followed by an end id; one longer than
   the sequence is cut into full pieces, the first of which may be shorter.
2. Only the histogram of piece lengths (at most ``size`` rows) goes to the
   driver.  Best-fit decreasing runs over counts: bins with the same free space
   form one group, and a group takes pieces of a length all at once.  The plan is
   a list of runs, whose number depends on the lengths, not on the documents.
3. Pieces get a rank within their length (no task holds a whole length, see
   ``common.rank_within``) and take their slot from the run of that rank.

A null text counts as empty: one piece with the end id alone.  Repeated rows are
packed as often as they stand; ties within a length are broken by (doc_id,
piece).  An empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chunks import encoder, tokenizer_path
from .common import prepare_workers, rank_within, read, stash

SIZE, END_ID = 2048, 0
TOKENIZER = "byte_bpe_50k.json"


def pieces(docs: DataFrame, tokenizer: str, size: int = SIZE, end_id: int = END_ID, with_ids: bool = False,
           doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, ids (little-endian unsigned 32-bit)."""
    end = int(end_id).to_bytes(4, "little")

    def cut(batches):
        enc = encoder(tokenizer)
        for batch in batches:
            rows: list[list] = [[], [], [], [], [], []]
            for doc, tx in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = enc.encode(tx.as_py()) + end
                n = len(ids) // 4
                at, k = 0, 0
                while at < n:
                    upto = min(n, at + ((n - 1) % size + 1 if k == 0 else size))
                    part = ids[4 * at:4 * upto]
                    for column, value in zip(rows, (doc, k, at, upto - at, zlib.crc32(part), part if with_ids else None)):
                        column.append(value)
                    at, k = upto, k + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int32()), pa.array(rows[2], pa.int64()),
                 pa.array(rows[3], pa.int64()), pa.array(rows[4], pa.int64()), pa.array(rows[5], pa.binary())],
                ["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    prepare_workers(docs.sparkSession)
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    found = plain.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary")
    return found if with_ids else found.drop("ids")


def plan_runs(counts: dict[int, int], size: int = SIZE) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts.

    Runs (length, first rank, end rank, first sequence, sequences, offset): rank
    r of the run goes to sequence ``first + (r - rank0) % sequences`` at
    ``offset + (r - rank0) // sequences * length``.
    """
    free: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]  # free space -> groups (first sequence, how many)
    runs, opened = [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            space = next((s for s in range(length, size) if free[s]), None)
            if space is None:
                space, first = size, opened
                many = left // (size // length) or 1
                opened += many
            else:
                first, many = free[space].pop()
            each = space // length  # a best fit goes on filling the same sequence
            if left >= each:
                use = min(many, left // each)
            else:
                use, each = 1, left
            if many > use:
                free[space].append((first + use, many - use))
            taken = use * each
            runs.append((length, rank, rank + taken, first, use, size - space))
            free[space - each * length].append((first, use))
            left, rank = left - taken, rank + taken
    return runs


def pack(found: DataFrame, size: int = SIZE) -> DataFrame:
    """Add sequence_id and offset to a table of pieces (with columns doc_id, piece, length, read more than once)."""
    spark = found.sparkSession
    counts = {r["length"]: r["n"] for r in
              found.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most ``size`` rows
    runs = spark.createDataFrame(plan_runs(counts, size) or [(0, 0, 0, 0, 1, 0)],
                                 "l long, r0 long, r1 long, first long, many long, off long")
    ranked = rank_within(found, "length", ["doc_id", "piece", "start"], "rank_in_length")
    inside = (F.col("length") == F.col("l")) & (F.col("rank_in_length") >= F.col("r0")) \
        & (F.col("rank_in_length") < F.col("r1"))
    k = F.col("rank_in_length") - F.col("r0")
    return ranked.join(F.broadcast(runs), inside) \
        .withColumn("sequence_id", F.col("first") + k % F.col("many")) \
        .withColumn("offset", F.col("off") + F.floor(k / F.col("many")) * F.col("length")) \
        .drop("l", "r0", "r1", "first", "many", "off", "rank_in_length")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = pieces(read(spark, sf_dir, "documents"), tokenizer_path(TOKENIZER))
    return pack(stash(cut, "pieces")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
