"""Corpus pipeline: quality rules, near-duplicates, source mix, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's ``docs``; all but the last return
the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.llm import hyperminhash, mixing, packing, quality
from weftgraph.llm.chunks import tokenizer_path
from weftgraph.llm.common import read, stash
from weftgraph.session import ensure_checkpoint_dir

#: Near-duplicates: shingles of five words, similarity of 0.8.
SHINGLE_WORDS, SIMILARITY_PCT = 5, 80
#: Target weight of a source: its number of documents to this power.
MIX_TEMPER = 0.9


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents that the rules reject go."""
    return quality.judge(docs).where("kept").select("row.*")


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: one document of each group of near-duplicates stays, once.

    Each row is judged by its own text, also where doc_ids repeat.
    """
    found = stash(hyperminhash.near_duplicates(docs, SHINGLE_WORDS, SIMILARITY_PCT, link_ids=False)
                  .where("doc_id is not null").select("doc_id", "text_hash", "stays"), "verdicts")
    gone = found.where("not stays").select("doc_id", "text_hash").distinct()
    repeated = found.where("stays").groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    rows = docs.select("doc_id", F.xxhash64(F.col("text").cast("string")).alias("text_hash"), F.struct("*").alias("row"))
    return rows.join(gone.unionByName(repeated), ["doc_id", "text_hash"], "left_anti").select("row.*").unionByName(
        rows.join(repeated, ["doc_id", "text_hash"], "left_semi").dropDuplicates(["doc_id", "text_hash"]).select("row.*"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: sources at their target weights; small sources come again, no document is dropped.  Rows are in the mix's order."""
    return mixing.mix(docs, temper=MIX_TEMPER).orderBy("slot", "place").select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: pieces of the documents with their sequence and offset."""
    return packing.pack(stash(packing.pieces(docs, tokenizer_path(packing.TOKENIZER)), "pieces"))


STAGES = [("quality_rules", quality_rules), ("minhash_dedup", minhash_dedup), ("mix_sources", mix_sources), ("pack", pack)]

#: The tokenizer and the earliest-deadline schedule are not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
    return docs
