"""Operator 11: hard negatives by angular triangle filtering.

1. Vectors become integers, ``floor(256 * x)``; the score of two of them is their integer inner product.
2. ``REFERENCES`` directions are fitted on a bounded sample (spherical k-means).  Every row is indexed: its norm and its
   angle to each reference are stored once.
3. By the triangle inequality of angles, two vectors with angles s and t to a reference are at an angle
   from |s - t| to min(s + t, 2 pi - s - t).  The cosines of the narrowest such interval, multiplied by the norms and
   widened by more than all rounding (``SLACK``), bound the integer score on both sides.
4. Rows lie in blocks of one nearest reference (its cell) and one bucket of labels.  A block's intervals of angles and norms
   bound its scores, so an anchor visits only blocks that may hold what it looks for.
5. Positives: in each block only rows whose upper bound reaches the fifth lower bound are scored.  Negatives: a
   positive's score gives a window; only rows whose interval overlaps a window, and can still be among its first ten,
   are scored.  Blocks put out a few rows per anchor, of which the best are taken by rank.

Anchors (``vec_id`` divisible by 100) meet the rows in a grid of blocks and slices, both of bounded size, so
that neither a hot label nor a hot cell makes a large task; nothing is capped.  The bounds of all blocks
(``MAX_BLOCKS`` at most) are broadcast.

Rows with a null label or vector, or any null or non-finite component, take no part, nor do rows without ``vec_id``.
Rows that share a ``vec_id`` count once (the one with the smallest label, then vector).  Missing
trailing components of a shorter vector are 0; a zero vector scores 0 with all.  A score
beyond 64 bits stops the job with an error.  An empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import prepare_workers, read, stash

SCALE, ANCHOR_STEP = 256, 100
POSITIVES, NEGATIVES, LOW_PCT, HIGH_PCT = 5, 10, 30, 90
REFERENCES, SAMPLE_ROWS, FIT_ROUNDS = 16, 8192, 8
LABEL_BUCKETS, BLOCK_ROWS, SLICE_ANCHORS, MAX_BLOCKS = 16, 16_384, 65_536, 65_536
TILE = 1 << 16  # bounds computed at once, in a core's cache
SLACK = 1e-6  # of the product of the norms; arc cosines are off by some 2e-8 at most
INDEX = "vec_id long, label long, q binary, norm double, angles binary, cell int"


def matrix(rows: list[bytes], width: int = 0) -> np.ndarray:
    """float64 rows, shorter ones filled up with zeros."""
    width = max([width, *(len(r) // 8 for r in rows)])
    if all(len(r) == 8 * width for r in rows):
        return np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), width)
    out = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        out[i, :len(r) // 8] = np.frombuffer(r, np.float64)
    return out


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label, q (bytes of the integers, as doubles): the rows that take part, with their changed labels."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & fine) \
        .groupBy("vec_id").agg(F.min(F.struct(F.col("label").cast("long").alias("label"), "embedding")).alias("r")) \
        .select("vec_id", F.when(F.col("vec_id") % 7 == 0, (F.col("r.label") + 1) % 10).otherwise(F.col("r.label")).alias("label"),
                F.col("r.embedding").cast("array<double>").alias("x"))

    def floored(batches):
        for batch in batches:
            x = batch.column(2)
            q = np.floor(SCALE * x.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            if not np.isfinite(q).all():
                raise OverflowError("a component beyond the range of doubles")
            ends = np.cumsum(x.value_lengths().to_numpy())
            out = [q[e - n:e].tobytes() for e, n in zip(ends, x.value_lengths().to_numpy())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())],
                                             ["vec_id", "label", "q"])

    return rows.mapInArrow(floored, "vec_id long, label long, q binary")


def fit_references(sample: list[bytes], seed: int = 5) -> np.ndarray:
    """Unit directions: spherical k-means on the sample, started from rows of it that lie far apart."""
    x = matrix(sample)
    norms = np.linalg.norm(x, axis=1)
    x = x[norms > 0] / norms[norms > 0][:, None]
    if not len(x):
        return np.ones((1, max(1, x.shape[1]))) / max(1, x.shape[1]) ** 0.5
    found = [x[seed % len(x)]]
    nearest = x @ found[0]
    while len(found) < min(REFERENCES, len(x)):
        found.append(x[int(np.argmin(nearest))])
        nearest = np.maximum(nearest, x @ found[-1])
    refs = np.stack(found)
    for _ in range(FIT_ROUNDS):
        cell = np.argmax(x @ refs.T, axis=1)
        sums = np.zeros_like(refs)
        np.add.at(sums, cell, x)
        length = np.linalg.norm(sums, axis=1)
        refs = np.where((length > 0)[:, None], sums / np.maximum(length, 1e-300)[:, None], refs)
    return refs


def angles_to(q: np.ndarray, norms: np.ndarray, refs: np.ndarray) -> np.ndarray:
    width = min(q.shape[1], refs.shape[1])  # what one side lacks is 0
    unit = q[:, :width] / np.where(norms > 0, norms, 1)[:, None]
    return np.arccos(np.clip(unit @ refs[:, :width].T, -1, 1))


def index(rows: DataFrame, refs: np.ndarray) -> DataFrame:
    """Every row with its norm, its angles to the references and its cell."""
    def indexed(batches):
        for batch in batches:
            if batch.num_rows:
                q = matrix(batch.column(2).to_pylist())
                top = np.abs(q).max(axis=1, initial=1)
                norm = top * np.linalg.norm(q / top[:, None], axis=1)  # no overflow in the squares
                theta = angles_to(q, norm, refs)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(norm), pa.array([t.tobytes() for t in theta], pa.binary()),
                     pa.array(np.argmin(theta, axis=1).astype(np.int32))], [*batch.schema.names, "norm", "angles", "cell"])

    return rows.mapInArrow(indexed, INDEX)


def bounds(theta_a, norm_a, low_theta, high_theta, low_norm, high_norm):
    """Lowest and highest score of each anchor (first axis) with rows of such angles and norms (second axis)."""
    shape = (len(theta_a), len(low_theta))
    least, most = np.zeros(shape), np.full(shape, np.pi)
    for r in range(theta_a.shape[1]):
        a, lo, hi = theta_a[:, r, None], low_theta[None, :, r], high_theta[None, :, r]
        np.maximum(least, a - hi, out=least)
        np.maximum(least, lo - a, out=least)
        # the widest angle grows with s up to pi - t and falls after it
        np.minimum(most, np.where(lo + a > np.pi, 2 * np.pi - a - lo, np.minimum(a + hi, np.pi)), out=most)
    high, low = np.cos(least), np.cos(np.maximum(most, least))
    small, large = norm_a[:, None] * low_norm, norm_a[:, None] * high_norm
    slack = SLACK * large + 1e-6
    return np.where(low < 0, low * large, low * small) - slack, np.where(high > 0, high * large, high * small) + slack


def pair_bounds(theta_a, norm_a, theta_x, norm_x):
    """The same for single rows, in fewer steps."""
    least, least_sum = np.zeros((len(theta_a), len(theta_x))), np.zeros((len(theta_a), len(theta_x)))
    work = np.empty_like(least)
    for r in range(theta_a.shape[1]):
        a, x = theta_a[:, r, None], theta_x[None, :, r]
        np.maximum(least, np.abs(np.subtract(a, x, out=work), out=work), out=least)
        np.maximum(least_sum, np.abs(np.subtract(np.pi - a, x, out=work), out=work), out=least_sum)
    size = norm_a[:, None] * norm_x
    slack = SLACK * size + 1e-6
    high = np.cos(least, out=work) * size + slack
    return np.cos(np.maximum(np.pi - least_sum, least)) * size - slack, high


def inner(q: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Exact integer inner products."""
    size = float(np.abs(q).max(initial=0)) * float(np.abs(a).max(initial=0)) * max(1, len(a))
    if size < 2.0 ** 53:  # sums of integers that doubles hold
        return (q @ a).astype(np.int64)
    exact = [sum(int(x) * int(y) for x, y in zip(row, a)) for row in q]
    if any(abs(s) >= 1 << 63 for s in exact):
        raise OverflowError("a score beyond 64 bits")
    return np.array(exact, np.int64)


def first(scores: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the n highest scores, ties by smaller id."""
    at = np.flatnonzero(scores >= np.partition(scores, len(scores) - n)[len(scores) - n]) if len(scores) > n else np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))[:n]]


def kth_largest(values: np.ndarray, k: int) -> float:
    return -np.inf if len(values) < k else float(np.partition(values, len(values) - k)[len(values) - k])


class Block:
    """The rows of a block, read once, and what an anchor finds among them."""

    def __init__(self, rows: list, width: int):
        self.ids = np.concatenate([r.column("vec_id").to_numpy() for r in rows])
        self.label = np.concatenate([r.column("label").to_numpy() for r in rows])
        self.norm = np.concatenate([r.column("norm").to_numpy() for r in rows])
        self.theta = matrix([t for r in rows for t in r.column("angles").to_pylist()])
        self.q = matrix([t for r in rows for t in r.column("q").to_pylist()], width)

    def score(self, at, a):
        width = min(self.q.shape[1], len(a))
        return inner(self.q[at, :width], a[:width])

    def positives(self, anchor: dict, low, high):
        at = np.flatnonzero((self.label == anchor["label"]) & (self.ids != anchor["vec_id"]))
        at = at[high[at] >= kth_largest(low[at], POSITIVES)]
        scores = self.score(at, anchor["q"])
        for i in first(scores, self.ids[at], POSITIVES):
            yield anchor["vec_id"], int(self.ids[at[i]]), int(scores[i])

    def negatives(self, anchor: dict, low, high):
        # (positive, its score, lowest and highest score of its negatives)
        windows = [(pid, p, -(-LOW_PCT * p // 100), HIGH_PCT * p // 100) for pid, p in zip(anchor["pids"], anchor["pscores"]) if p >= 0]
        if not windows:
            return
        at = np.flatnonzero((self.label != anchor["label"]) & (high >= min(w[2] for w in windows))
                            & (low <= max(w[3] for w in windows)))
        lo, hi = low[at], high[at]
        wanted = np.zeros(len(at), bool)
        for _, _, least, most in windows:
            meets = (hi >= least) & (lo <= most)
            sure = lo[meets & (lo >= least) & (hi <= most)]
            if len(sure) >= NEGATIVES:  # so many are inside for certain
                meets &= hi >= kth_largest(sure, NEGATIVES)
            wanted |= meets
        at = at[wanted]
        scores, ids = self.score(at, anchor["q"]), self.ids[at]
        for pid, p, least, most in windows:
            inside = np.flatnonzero((scores >= least) & (scores <= most))
            for i in inside[first(scores[inside], ids[inside], NEGATIVES)]:
                yield anchor["vec_id"], pid, int(ids[i]), p, int(scores[i])


def _runs(batches, columns: int):
    """(key, slice of a batch) for every run of equal first ``columns`` columns."""
    for batch in batches:
        if batch.num_rows:
            keys = np.stack([batch.column(i).to_numpy() for i in range(columns)], axis=1)
            cuts = np.append(np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1))), len(keys))
            for i, j in zip(cuts[:-1], cuts[1:]):
                yield tuple(keys[i]), batch.slice(i, j - i)


def meet(blocks: DataFrame, anchors: DataFrame, what: str, schema: str) -> DataFrame:
    """Anchors (block, slice, …) with the rows of their block; ``what`` names the method of ``Block`` that finds."""
    names = [f.split()[0] for f in schema.split(", ")]

    def found(batches):
        key, rows, block, out = None, [], None, []

        def batch_of(out):
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names)

        for (b, s, kind), part in _runs(batches, 3):
            if (b, s) != key:
                key, rows, block = (b, s), [], None
            if not kind:
                rows.append(part)
                continue
            if not rows:
                continue  # a slice without rows
            qs = [np.frombuffer(q, np.float64) for q in part.column("q").to_pylist()]
            block = block or Block(rows, 0)
            theta, norm = matrix(part.column("angles").to_pylist()), part.column("norm").to_numpy()
            ids, labels = part.column("vec_id").to_pylist(), part.column("label").to_pylist()
            pids, pscores = part.column("pids").to_pylist(), part.column("pscores").to_pylist()
            step = max(1, TILE // len(block.ids))
            for i in range(0, len(ids), step):
                low, high = pair_bounds(theta[i:i + step], norm[i:i + step], block.theta, block.norm)
                for j in range(i, min(i + step, len(ids))):
                    anchor = {"vec_id": ids[j], "label": labels[j], "q": qs[j], "pids": pids[j], "pscores": pscores[j]}
                    out.extend(getattr(block, what)(anchor, low[j - i], high[j - i]))
                if len(out) > 50_000:
                    yield batch_of(out)
                    out = []
        if out:
            yield batch_of(out)

    none = F.lit(None).cast("array<long>")
    columns = ["block", "slice", "kind", "vec_id", "label", "q", "norm", "angles", "pids", "pscores"]
    rows = blocks.withColumn("kind", F.lit(0)).withColumn("pids", none).withColumn("pscores", none)
    both = rows.select(columns).unionByName(anchors.withColumn("kind", F.lit(1)).select(columns))
    return both.repartition("block", "slice").sortWithinPartitions("block", "slice", "kind").mapInArrow(found, schema)


class Blocks:
    """Blocks of an indexed table and the bounds of their rows."""

    def __init__(self, indexed: DataFrame):
        n, anchors = indexed.agg(F.count(F.lit(1)), F.count_if(F.col("vec_id") % ANCHOR_STEP == 0)).first()
        self.size = max(BLOCK_ROWS, -(-n // (MAX_BLOCKS - LABEL_BUCKETS * REFERENCES)))
        self.slices = max(1, -(-anchors // SLICE_ANCHORS))
        buckets = max(1, min(LABEL_BUCKETS, n // (REFERENCES * BLOCK_ROWS)))  # none too small to be worth a visit
        bucketed = indexed.withColumn("bucket", F.pmod(F.xxhash64("label"), F.lit(buckets)).cast("int"))
        sizes = bucketed.groupBy("cell", "bucket").agg(F.ceil(F.count(F.lit(1)) / self.size).cast("int").alias("chunks"))
        numbered = sizes.withColumn("base", (F.sum("chunks").over(  # REFERENCES * LABEL_BUCKETS rows at most
            Window.orderBy("cell", "bucket")) - F.col("chunks")).cast("int"))
        self.rows = stash(bucketed.join(F.broadcast(numbered), ["cell", "bucket"]).withColumn(
            "block", F.col("base") + F.pmod(F.xxhash64("vec_id"), F.col("chunks")).cast("int")), "blocks")
        self.anchors = self.rows.where(F.col("vec_id") % ANCHOR_STEP == 0) \
            .withColumn("slice", F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(self.slices)).cast("int"))
        self.bounds = self._bounds()

    def gridded(self) -> DataFrame:
        return self.rows.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(self.slices - 1)))) if self.slices > 1 \
            else self.rows.withColumn("slice", F.lit(0))

    def _bounds(self):
        """Per block its bucket, the least and largest angle to each reference, and the least and largest norm."""
        def partial(batches):
            seen = {}
            for (block, bucket), part in _runs(batches, 2):
                theta, norm = matrix(part.column(2).to_pylist()), part.column(3).to_numpy()
                new = (bucket, theta.min(axis=0), theta.max(axis=0), norm.min(), norm.max())
                old = seen.get(block, new)
                seen[block] = (bucket, np.minimum(old[1], new[1]), np.maximum(old[2], new[2]), min(old[3], new[3]), max(old[4], new[4]))
            for block, (bucket, lo, hi, least, most) in seen.items():
                yield pa.RecordBatch.from_pylist([{"block": int(block), "bucket": int(bucket), "low": lo.tolist(), "high": hi.tolist(),
                                                   "least": float(least), "most": float(most)}], schema=arrow)

        arrow = pa.schema([("block", pa.int32()), ("bucket", pa.int32()), ("low", pa.list_(pa.float64())),
                           ("high", pa.list_(pa.float64())), ("least", pa.float64()), ("most", pa.float64())])
        rows = self.rows.select("block", "bucket", "angles", "norm").mapInArrow(
            partial, "block int, bucket int, low array<double>, high array<double>, least double, most double") \
            .select("block", "bucket", "least", "most", F.posexplode(F.arrays_zip("low", "high")).alias("ref", "z")) \
            .groupBy("block", "bucket", "ref").agg(F.min("z.low").alias("low"), F.max("z.high").alias("high"),
                                                   F.min("least").alias("least"), F.max("most").alias("most")) \
            .groupBy("block", "bucket").agg(F.array_sort(F.collect_list(F.struct("ref", "low", "high"))).alias("refs"),
                                            F.min("least").alias("least"), F.max("most").alias("most")).collect()  # MAX_BLOCKS at most
        return [np.array(c) for c in zip(*((r["block"], r["bucket"], [x["low"] for x in r["refs"]], [x["high"] for x in r["refs"]],
                                            r["least"], r["most"]) for r in rows))]

    def visits(self, anchors: DataFrame, negatives: bool) -> DataFrame:
        """``anchors``, once for each block that may hold what they look for."""
        known = anchors.sparkSession.sparkContext.broadcast(self.bounds)

        def routed(batches):
            block, bucket, low_theta, high_theta, least, most = known.value
            for batch in batches:
                for i in range(0, batch.num_rows, step := max(1, TILE // len(block))):
                    part = batch.slice(i, step)
                    low, high = bounds(matrix(part.column("angles").to_pylist()), part.column("norm").to_numpy(),
                                       low_theta, high_theta, least, most)
                    if negatives:
                        go = np.zeros(low.shape, bool)
                        for j, scores in enumerate(part.column("pscores").to_pylist()):
                            for p in scores:
                                if p >= 0:
                                    go[j] |= (high[j] >= LOW_PCT * p / 100 - 1) & (low[j] <= HIGH_PCT * p / 100 + 1)
                    else:
                        go = part.column("bucket").to_numpy()[:, None] == bucket
                    at, to = np.nonzero(go)
                    out = part.take(pa.array(at))
                    yield pa.RecordBatch.from_arrays([pa.array(block[to].astype(np.int32)), *out.columns],
                                                     ["block", *out.schema.names])

        columns = ["slice", "bucket", "vec_id", "label", "q", "norm", "angles", "pids", "pscores"]
        return anchors.select(columns).mapInArrow(
            routed, "block int, slice int, bucket int, vec_id long, label long, q binary, norm double, angles binary, "
                    "pids array<long>, pscores array<long>")


def _ranked(found: DataFrame, keys: list[str], score: str, of: str, n: int) -> DataFrame:
    return found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(score), of))).where(f"rank <= {n}")


def hard_negatives(vectors: DataFrame) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score from vec_id, label, embedding."""
    spark = vectors.sparkSession
    prepare_workers(spark)
    rows = stash(usable(vectors), "rows")
    sample = [bytes(r["q"]) for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).select("q").collect()]
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not sample:
        return spark.createDataFrame([], schema)
    blocks = Blocks(index(rows, fit_references(sample)))
    grid = blocks.gridded()
    none = F.lit(None).cast("array<long>")
    seekers = blocks.anchors.withColumn("pids", none).withColumn("pscores", none)
    positives = stash(_ranked(meet(grid, blocks.visits(seekers, False), "positives",
                                   "vec_id long, positive_id long, positive_score long"),
                              ["vec_id"], "positive_score", "positive_id", POSITIVES), "positives")
    lists = positives.groupBy("vec_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("p")) \
        .select("vec_id", F.col("p.positive_id").alias("pids"), F.col("p.positive_score").alias("pscores"))  # POSITIVES at most
    found = meet(grid, blocks.visits(blocks.anchors.join(lists, "vec_id"), True), "negatives",
                 "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long")
    return _ranked(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", NEGATIVES) \
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(read(spark, sf_dir, "embeddings"))


ORACLE = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE) FOR x IN embedding] AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER w::INTEGER AS rank, s.vec_id AS negative_id, positive_score,
       s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
  AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER w <= 10
"""
