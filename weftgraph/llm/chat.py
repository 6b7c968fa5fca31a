"""Operator 1: chat formatting by cumulative-snapshot collapse.

Conversations are logged again and again while they grow.  A log whose turns
are a prefix of another log's turns is a snapshot of it; only maximal
conversations are rendered.

* A conversation is the distinct ``(turn, role, text)`` rows of a ``conv_id``,
  ordered by turn (null first), role, text.  A row repeated exactly is one turn;
  rows that tie on the turn number are all kept, in that order.
* Null roles and texts count as empty.  Rows without a ``conv_id`` belong to no
  conversation and are left out.  Extra columns are ignored.
* Every prefix gets a rolling hash: the XOR of two 64-bit hashes of
  (position, role, text) over its turns.  XOR needs no order of evaluation, so
  prefix values come from two levels: within blocks of ``BLOCK`` turns and over
  block totals.  No task holds more than a block of a conversation's texts.
* An anti join on (length, hash) drops conversations that equal a proper prefix
  of another; of equal conversations the smallest ``conv_id`` stays.
* The rest is rendered in parts of ``BLOCK`` turns, one row per part, so that a
  conversation of any length never meets in one row.  An empty table gives an
  empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read, stash

BLOCK = 64
#: Fixed values of the rendered format.
OPEN, CLOSE, OPEN_SAFE = "<|im_start|>", "<|im_end|>", "< |im_"


def prefix_hashes(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                  text: str = "text") -> DataFrame:
    """One row per turn: c, pos (from 1), n (turns of the conversation), p1, p2 (hash of the prefix), r, x."""
    t = conversations.select(F.col(conv).alias("c"), F.col(turn).cast("long").alias("t"),
                             F.coalesce(F.col(role).cast("string"), F.lit("")).alias("r"),
                             F.coalesce(F.col(text).cast("string"), F.lit("")).alias("x")) \
        .where("c is not null").distinct() \
        .withColumn("b", F.expr(f"coalesce(t div {BLOCK}, bigint(-9223372036854775808))"))
    in_block = Window.partitionBy("c", "b").orderBy(F.col("t").asc_nulls_first(), "r", "x")
    upto = in_block.rowsBetween(Window.unboundedPreceding, 0)
    blocks_before = Window.partitionBy("c").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("c")

    placed = stash(t.withColumn("k", F.row_number().over(in_block)), "turns")
    sizes = placed.groupBy("c", "b").agg(F.count(F.lit(1)).alias("m"))
    starts = sizes.select("c", "b", F.coalesce(F.sum("m").over(blocks_before), F.lit(0)).alias("s"),
                          F.sum("m").over(whole).alias("n"))
    hashed = placed.join(starts, ["c", "b"]).withColumn("pos", F.col("s") + F.col("k")) \
        .withColumn("h1", F.xxhash64(F.lit(1), "pos", "r", F.lit(2), "x")) \
        .withColumn("h2", F.xxhash64(F.lit(3), "x", F.lit(4), "r", "pos"))
    rolled = hashed.withColumn("q1", F.bit_xor("h1").over(upto)).withColumn("q2", F.bit_xor("h2").over(upto)) \
        .select("c", "b", "pos", "n", "q1", "q2", "r", "x")
    rolled = stash(rolled, "rolled")
    ends = rolled.groupBy("c", "b").agg(F.max(F.struct("pos", "q1", "q2")).alias("e"))
    carried = ends.select("c", "b", F.coalesce(F.bit_xor("e.q1").over(blocks_before), F.lit(0)).alias("o1"),
                          F.coalesce(F.bit_xor("e.q2").over(blocks_before), F.lit(0)).alias("o2"))
    return rolled.join(carried, ["c", "b"]).select(
        "c", "pos", "n", F.col("q1").bitwiseXOR(F.col("o1")).alias("p1"),
        F.col("q2").bitwiseXOR(F.col("o2")).alias("p2"), "r", "x")


def collapse(conversations: DataFrame, **columns) -> DataFrame:
    """Maximal conversations, rendered: conv_id, part, n_turns (of the whole), n_copies, text."""
    turns = stash(prefix_hashes(conversations, **columns), "prefixes")
    shorter = turns.where("pos < n").select(F.col("pos").alias("n"), "p1", "p2").distinct()
    whole = turns.where("pos = n").groupBy("n", "p1", "p2") \
        .agg(F.min("c").alias("c"), F.count(F.lit(1)).alias("n_copies"))
    maximal = whole.join(shorter, ["n", "p1", "p2"], "left_anti").select("c", "n_copies")
    said = F.concat(F.lit(OPEN), F.replace("r", F.lit("<|im_"), F.lit(OPEN_SAFE)), F.lit("\n"),
                    F.replace("x", F.lit("<|im_"), F.lit(OPEN_SAFE)), F.lit(CLOSE + "\n"))
    return turns.join(maximal, "c") \
        .groupBy(F.col("c").alias("conv_id"), F.expr(f"(pos - 1) div {BLOCK}").alias("part"),
                 F.col("n").alias("n_turns"), "n_copies") \
        .agg(F.sort_array(F.collect_list(F.struct("pos", said.alias("s")))).alias("a")) \
        .select("conv_id", "part", "n_turns", "n_copies",
                F.array_join(F.transform("a", lambda e: e["s"]), "").alias("text"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collapse(read(spark, sf_dir, "conversations"))


ORACLE = f"""
WITH t AS (SELECT DISTINCT conv_id c, turn t, coalesce(role, '') r, coalesce(text, '') x
           FROM conversations WHERE conv_id IS NOT NULL),
p AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY t NULLS FIRST, r, x) pos,
             count(*) OVER (PARTITION BY c) n FROM t),
s AS (SELECT *, list((r, x)) OVER (PARTITION BY c ORDER BY pos) pre FROM p),
w AS (SELECT pre, min(c) c, count(*) n_copies, any_value(n) n FROM s WHERE pos = n GROUP BY pre),
m AS (SELECT * FROM w WHERE pre NOT IN (SELECT pre FROM s WHERE pos < n))
SELECT m.c AS conv_id, (p.pos - 1) // {BLOCK} AS part, m.n AS n_turns, m.n_copies AS n_copies,
       string_agg('{OPEN}' || replace(r, '<|im_', '{OPEN_SAFE}') || chr(10) || replace(x, '<|im_', '{OPEN_SAFE}')
                  || '{CLOSE}' || chr(10), '' ORDER BY p.pos) AS text
FROM m JOIN p USING (c) GROUP BY ALL
"""
