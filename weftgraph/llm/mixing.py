"""Operator 5: mixing sources to target weights by Pfair scheduling.

The documents of a source form blocks of ``block_docs``.  With a target weight w,
block j of a source has release time floor(j / w) and deadline ceil((j + 1) / w);
each slot of the mix goes to the released block with the earliest deadline.  At
every slot each source is then less than one block away from its share.

Releases and deadlines come from the weights themselves, as exact ratios of whole
numbers, so nothing drifts and no source gets a slot before its share is due.
The driver goes through the schedule once and keeps only the state (blocks done
per source) at the start of each range of slots: at most ``RANGES`` ranges, of
``period`` slots or more.  Tasks make the slots of a range from its state; the
rest are joins on (source, block number) and hash-dealt ranks
(``common.rank_within``), and no task holds a whole source.  Blocks grow with the
input, so that the walk has about ``MAX_SLOTS`` slots at most (some 20 s) at any size.

The mix ends when every block of every source has been scheduled once.  No
document is dropped: a source that runs out earlier begins again (``epoch`` 1, 2,
…), which is how a small source reaches its weight.

A null source is a source of its own.  A source without a weight in a given
``weights`` map, or with one that is not positive and finite, is an error; weights of absent sources are ignored.  Repeated
rows are documents of their own; an empty table gives an empty result.  All
columns of the input are kept, whatever their names; ``block``, ``epoch``, ``slot`` and ``place`` are
added (columns of the input with these names are replaced).
"""

from __future__ import annotations

import heapq
import math
from fractions import Fraction

import pyarrow as pa

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prepare_workers, rank_within, read, shuffle_partitions

BLOCK_DOCS, PERIOD, TEMPER = 8, 1024, 0.8
RANGES = 4096
MAX_SLOTS = 10_000_000


def tempered_weights(counts: dict, temper: float = TEMPER) -> dict:
    """Weights in proportion to size ** temper: large sources give way to small ones."""
    return {s: n ** temper for s, n in counts.items()}


def whole_weights(weights: list) -> list[int]:
    """Whole numbers in the exact proportion of the weights."""
    exact = [Fraction(w) for w in weights]
    unit = math.lcm(*(x.denominator for x in exact))
    whole = [int(x * unit) for x in exact]
    common = math.gcd(*whole)
    return [a // common for a in whole]


def slots_from(whole: list[int], names: list[str], done: list[int], at: int):
    """(slot, source, j) from slot ``at`` on, without end: earliest deadline first, ties by name.

    ``done``: blocks of each source before ``at``, as the same schedule leaves them; it is kept up to date.
    """
    total = sum(whole)
    order = {i: k for k, i in enumerate(sorted(range(len(names)), key=lambda i: names[i]))}
    waiting = [(done[i] * total // a, order[i], i) for i, a in enumerate(whole)]
    heapq.heapify(waiting)
    ready: list[tuple] = []
    slot = at
    while True:
        while waiting and waiting[0][0] <= slot:
            _, k, i = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(done[i] + 1) * total // whole[i]), k, i))
        _, k, i = heapq.heappop(ready)
        j = done[i]
        done[i] = j + 1
        heapq.heappush(waiting, ((j + 1) * total // whole[i], k, i))
        yield slot, i, j
        slot += 1


def ranges(whole: list[int], names: list[str], blocks: list[int], period: int = PERIOD):
    """(starts, end, done): (first slot, blocks done per source) of each range, the number of slots, blocks done by then.

    The schedule ends when every source has had all its ``blocks``.  Ranges have ``period`` slots, or more where there would
    be over ``RANGES`` of them or the state would be larger than the slots of a range.
    """
    total = sum(whole)
    # block b - 1 has its slot before its deadline
    most = max(-(-b * total // a) for a, b in zip(whole, blocks))
    size = max(period, 4 * len(whole), -(-most // RANGES))
    done, left, starts = [0] * len(whole), len(whole), []
    for slot, i, j in slots_from(whole, names, done, 0):
        if slot % size == 0:
            state = list(done)
            state[i] = j
            starts.append((slot, state))
        left -= j + 1 == blocks[i]
        if not left:
            return starts, slot + 1, done


def schedule(spark: SparkSession, whole: list[int], names: list[str], starts: list[tuple], end: int) -> DataFrame:
    """_s, _n, slot: block number _n of source _s is in slot ``slot``; each range is made in a task."""
    prepare_workers(spark)
    stops = [at for at, _ in starts[1:]] + [end]
    frame = spark.createDataFrame([(at, stop, done) for (at, done), stop in zip(starts, stops)], "at long, stop long, done array<long>")

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                picked = [t for t, _ in zip(slots_from(whole, names, r["done"], r["at"]), range(r["stop"] - r["at"]))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([names[i] for _, i, _ in picked], pa.string()), pa.array([j for _, _, j in picked], pa.int64()),
                     pa.array([t for t, _, _ in picked], pa.int64())], ["_s", "_n", "slot"])

    return frame.repartition(min(len(starts), shuffle_partitions(spark)), "at").mapInArrow(run, "_s string, _n long, slot long")


def mix(docs: DataFrame, weights: dict | None = None, block_docs: int = BLOCK_DOCS, period: int = PERIOD,
        temper: float = TEMPER, source: str = "source", order: list[str] | None = None) -> DataFrame:
    """The documents with block, epoch, slot (of their block in the mix) and place (in the block)."""
    spark = docs.sparkSession
    added = ["block", "epoch", "slot", "place"]
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in added]
    order = order or [c for c in ("doc_id", "text") if c in docs.columns]
    # the row is one value, so that no name of its columns meets one of ours
    rows = docs.select(F.coalesce(F.col(source).cast("string"), F.lit("\0null")).alias("_s"), F.struct(*kept).alias("_row"),
                       *[F.col(f"`{c}`").alias(f"_o{i}") for i, c in enumerate(order)])
    counts = {r["_s"]: r["n"] for r in rows.groupBy("_s").agg(F.count(F.lit(1)).alias("n")).collect()}
    if weights is None:
        weights = tempered_weights(counts, temper)
    else:
        weights = {"\0null" if s is None else str(s): w for s, w in weights.items()}
        if missing := [s for s in counts if s not in weights]:
            raise ValueError(f"no weight for sources {missing[:5]}")
        weights = {s: weights[s] for s in counts}
    if not counts:
        return docs.select(*kept, *[F.lit(0).cast("long").alias(c) for c in added])
    if bad := [s for s, w in weights.items() if not (w > 0 and math.isfinite(w))]:
        raise ValueError(f"weights of {bad[:5]} are not positive and finite")
    names = sorted(counts)
    whole = whole_weights([weights[s] for s in names])
    block_docs = max(block_docs, -(-sum(counts.values()) // MAX_SLOTS))
    blocks = [-(-counts[s] // block_docs) for s in names]
    starts, end, done = ranges(whole, names, blocks, period)
    table = schedule(spark, whole, names, starts, end)
    sizes = spark.createDataFrame(list(zip(names, blocks, done)), "_s string, _b long, _done long")

    ranked = rank_within(rows, "_s", [f"_o{i}" for i in range(len(order))], "_rank")
    with_block = ranked.withColumn("block", F.floor(F.col("_rank") / block_docs)) \
        .withColumn("place", F.col("_rank") % block_docs)
    # occurrence e of a block is the source's block number block + e * blocks; sizes has a row per source
    seen = with_block.join(F.broadcast(sizes), "_s")\
        .withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(
            (F.col("_done") - 1 - F.col("block")) / F.col("_b"))))) \
        .withColumn("_n", F.col("block") + F.col("epoch") * F.col("_b")).drop("_b", "_done")
    return seen.join(table, ["_s", "_n"]).select("_row.*", *added)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source")
    return mix(docs, order=["doc_id"]).select("doc_id", "source", "block", "epoch", "slot", "place")
