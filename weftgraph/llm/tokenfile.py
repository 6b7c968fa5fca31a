"""Operator 4: token ids in files of range-coded blocks.

The file format is a Parquet table of segments, written and committed by Spark
(so a lost executor or a second attempt leaves no half file).  A segment holds up
to ``LANES`` blocks of ``BLOCK`` ids (see ``rangecoder``): columns part, segment,
n_ids, payload (the coded blocks, each with its header and checksum), and the
index of the documents that begin in it: doc_ids and doc_lengths.  Parts follow
each other in ascending doc_id order, segments in order within a part.

Documents are dealt to parts by a range of doc_id (many parts, whatever the
sources), tokenised and coded in the task that sorts them.  Reading decodes part
by part; a document may go on over many blocks and segments.

A null text counts as empty: the end id alone.  A null doc_id sorts first.  Rows
that repeat a doc_id are all kept, in no fixed order among themselves.  An empty
table gives an empty file and an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftgraph.session import ensure_checkpoint_dir

from .chunks import encoder, tokenizer_path
from .common import prepare_workers, read, shuffle_partitions
from .rangecoder import BLOCK, LANES, decode_blocks, encode_blocks

TOKENIZER, END_ID = "word_bpe_49k.json", 1
FILE_SCHEMA = ("part int, segment int, n_ids long, payload binary, doc_ids array<long>, doc_lengths array<long>")


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, doc_id: str = "doc_id",
                 text: str = "text", parts: int | None = None) -> None:
    """Tokenise, append the end id to each document and write the file at ``path``."""
    spark = docs.sparkSession
    prepare_workers(spark)
    room = BLOCK * LANES

    def code(batches):
        enc, part, segment = encoder(tokenizer), TaskContext.get().partitionId(), 0
        held, size, doc_ids, doc_lengths = [], 0, [], []
        open_ids = 0  # of those held, ids of a document that began in an earlier segment

        def row(ids: np.ndarray, docs: int):
            nonlocal segment, doc_ids, doc_lengths
            out = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([segment], pa.int32()), pa.array([len(ids)], pa.int64()),
                 pa.array([b"".join(encode_blocks(ids))], pa.binary()), pa.array([doc_ids[:docs]], pa.list_(pa.int64())),
                 pa.array([doc_lengths[:docs]], pa.list_(pa.int64()))],
                ["part", "segment", "n_ids", "payload", "doc_ids", "doc_lengths"])
            segment, doc_ids, doc_lengths = segment + 1, doc_ids[docs:], doc_lengths[docs:]
            return out

        for batch in batches:
            ids, lengths = enc.encode_column(batch.column(1), end_id)
            doc_ids += batch.column(0).to_pylist()
            doc_lengths += lengths.tolist()
            held.append(ids)
            size += len(ids)
            while size >= room:
                joined = np.concatenate(held)
                ends = open_ids + np.cumsum(doc_lengths, dtype=np.int64)
                docs = int(np.searchsorted(ends, room)) + 1 if open_ids < room else 0
                open_ids = int(ends[docs - 1] if docs else open_ids) - room
                held, size = [joined[room:]], size - room
                yield row(joined[:room], docs)
        if size or doc_ids:
            yield row(np.concatenate(held), len(doc_ids))

    docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")) \
        .repartitionByRange(parts or shuffle_partitions(spark), F.col("doc_id").asc_nulls_first()) \
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first()) \
        .mapInArrow(code, FILE_SCHEMA).write.mode("errorifexists").parquet(path)


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Decode a file: doc_id, start (ids before it in the file), n_tokens, ids_crc32 and, if asked for, ids."""
    prepare_workers(spark)
    file = spark.read.schema(FILE_SCHEMA).parquet(path)

    def decode(batches):
        part, before, waiting, at = None, 0, [], 0  # waiting: documents of the part that are not complete
        crc, held = 0, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["part"] != part:
                    part, before, waiting, at, crc, held = row["part"], 0, [], 0, 0, []
                waiting += zip(row["doc_ids"], row["doc_lengths"])
                ids = decode_blocks(row["payload"]).astype("<u4").tobytes()
                done, here = [], 0
                k = 0
                while k < len(waiting):
                    doc, n = waiting[k]
                    take = min(n - at, len(ids) // 4 - here)
                    piece = ids[4 * here:4 * (here + take)]
                    crc = zlib.crc32(piece, crc)
                    if with_ids:
                        held.append(piece)
                    at, here = at + take, here + take
                    if at < n:
                        break
                    done.append((part, doc, before, n, crc, b"".join(held) if with_ids else None))
                    before, at, crc, held, k = before + n, 0, 0, [], k + 1
                waiting = waiting[k:]
                columns = list(zip(*done)) or [()] * 6
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(),
                                                              pa.binary()))],
                    ["part", "doc_id", "start_in_part", "n_tokens", "ids_crc32", "ids"])
        if waiting:
            raise ValueError("the file ends within a document")

    found = file.repartitionByRange(shuffle_partitions(spark), "part").sortWithinPartitions("part", "segment") \
        .mapInArrow(decode, "part int, doc_id long, start_in_part long, n_tokens long, ids_crc32 long, ids binary")
    # one row per part: where it begins
    sizes = file.groupBy("part").agg(F.sum("n_ids").alias("n"))
    begins = sizes.select("part", F.coalesce(F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("begin"))
    out = found.join(F.broadcast(begins), "part").select(
        "doc_id", (F.col("begin") + F.col("start_in_part")).alias("start"), "n_tokens", "ids_crc32", "ids")
    return out if with_ids else out.drop("ids")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/token-file-{uuid.uuid4().hex}"
    write_tokens(read(spark, sf_dir, "documents"), path, tokenizer_path(TOKENIZER))
    return read_tokens(spark, path)
