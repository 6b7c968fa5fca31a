"""Operator 10: near-duplicate texts by HyperMinHash.

1. Every text becomes the set of its word shingles (64-bit hashes).  One hash per
   shingle picks a bucket; a bucket keeps of its smallest hash only the leading
   zero count and ``MANTISSA`` mantissa bits (16-bit registers).
2. Texts with the same set form a class at once (128-bit fingerprint).  The class is the node of everything
   that follows; the text of its smallest document stands for it.
3. Empty buckets borrow from the next full one, and ``BANDS`` bands of ``ROWS``
   registers each are joined: documents that share a band are candidates.
4. Candidates are estimated from the registers: the share of equal registers,
   corrected for chance collisions of the compressed values, with a margin of
   ``SIGMAS`` standard errors below the threshold.  What passes is verified on the
   full shingle sets of both texts.
5. In a band's bucket all documents are first compared with its smallest one (its
   hub).  Only buckets that still hold more than one component then compare
   across components: in blocks of bounded size, on four bits of each register and
   with the same margin.  A block puts out a spanning set of its likely pairs, not
   the pairs; the components of these are families, within which blocks verify
   every likely pair that is still apart on the full sets.  So a group of
   thousands of copies costs a comparison or two per document, while no pair of
   candidates in different components is left out.  Links are exact; the
   components follow from them.

A null or empty text, or one without words, has an empty set, links with nothing
and is its own component.  A row with a null doc_id links with nothing
(component null, kept).  Repeated rows are each returned.  Rows that share a
doc_id keep the links of each of their texts; with ``link_ids`` (as in the query) such rows
belong together, so that a doc_id has one component, without it each text is judged alone.  An empty table
gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import chunk_pairs, pairs_in, whole_groups
from .common import prepare_workers, read, shuffle_partitions, stash
from .components import components

SHINGLE, THRESHOLD = 2, 80  # words, percent
BANDS, ROWS = 40, 5  # a pair at 0.8 misses all bands with a chance of 1e-7
MANTISSA, SIGMAS = 10, 5.0
REGISTERS = BANDS * ROWS
#: Chance that two different minima share a register: the known constant for HyperMinHash, 0.1699, over the mantissa's values.
COLLISION = 0.1699 / (1 << MANTISSA)
CACHE_WORDS = 200_000
BLOCK_ROWS, VERIFY_ROWS = 2048, 128
M1, M2, STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (wrapping arithmetic)."""
    h = (h ^ (h >> np.uint64(30))) * M1
    h = (h ^ (h >> np.uint64(27))) * M2
    return h ^ (h >> np.uint64(31))


class Words(dict):
    """word -> 64-bit hash, bounded."""

    def __missing__(self, word):
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_words = Words()


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's k-word shingles; with fewer words, of the whole sequence."""
    words = text.encode().lower().split() if text else []  # bytes: A-Z only, and white space 20 09-0D only
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_words.__getitem__, words), np.uint64, n)
    w = min(n, k)
    acc = np.full(n - w + 1, w, np.uint64)
    for j in range(w):
        acc = mix((acc + h[j:n - w + 1 + j]) * STEP + np.uint64(j + 1))
    return np.unique(acc)


def registers(shingles: np.ndarray) -> np.ndarray:
    """16-bit registers, 0 where the bucket is empty."""
    out = np.zeros(REGISTERS, np.uint16)
    if len(shingles):
        bucket = ((shingles >> np.uint64(32)) * np.uint64(REGISTERS)) >> np.uint64(32)  # ascending, as the set is sorted
        starts = np.flatnonzero(np.diff(bucket, prepend=np.uint64(REGISTERS)))
        least = np.minimum.reduceat(mix(shingles + STEP), starts) >> np.uint64(1)
        # the bits of a double: the exponent counts leading zeros, the first bits after it are the mantissa
        bits = least.astype(np.float64).view(np.uint64) >> np.uint64(52 - MANTISSA)
        value = np.maximum(bits.astype(np.int64) - (1022 << MANTISSA), 1)
        out[bucket[starts].astype(np.int64)] = value
    return out


def band_keys(regs: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of the densified registers."""
    full = np.flatnonzero(regs)
    dense = regs[full[np.searchsorted(full, np.arange(REGISTERS)) % len(full)]].astype(np.uint64).reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for j in range(ROWS):
        key = mix(key * STEP + dense[:, j] + np.uint64(1))
    return key.view(np.int64)


def signatures(docs: DataFrame, k: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text_hash, n_shingles, f1, f2 (fingerprint of the set), regs (null for an empty set)."""
    def sign(batches):
        for batch in batches:
            n, f1, f2, regs = [], [], [], []
            for tx in batch.column(1):
                s = shingle_set(tx.as_py(), k)
                n.append(len(s))
                f1.append(int(np.bitwise_xor.reduce(mix(s)).view(np.int64)) if len(s) else 0)
                f2.append(int(np.add.reduce(mix(s ^ STEP)).view(np.int64)) if len(s) else 0)
                regs.append(registers(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()),
                 pa.array(regs, pa.binary())], ["doc_id", "text_hash", "n_shingles", "f1", "f2", "regs"])

    return keyed(docs, doc_id, text).select("doc_id", "text", "text_hash") \
        .mapInArrow(sign, "doc_id long, text_hash long, n_shingles long, f1 long, f2 long, regs binary")


def keyed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text, text_hash: a document's key is its doc_id and the hash of its text."""
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")) \
        .withColumn("text_hash", F.xxhash64("text"))


def single_texts(docs: DataFrame, shared: DataFrame) -> DataFrame:
    """doc_id, text_hash, text of ``docs``, each once; only the rows of doc_ids that come more than once (``shared``) are compared."""
    alone = docs.join(shared, "doc_id", "left_anti").select("doc_id", "text_hash", "text")
    return alone.unionByName(docs.join(shared, "doc_id", "left_semi").select("doc_id", "text_hash", "text")
                             .dropDuplicates(["doc_id", "text_hash"]))


def _bands(batches):
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        keys = [band_keys(np.frombuffer(r.as_py(), np.uint16)) for r in batch.column(1)]
        if len(ids):
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, BANDS)), pa.array(np.concatenate(keys))], ["doc", "key"])


def _nibbles(batches):
    """Four bits per register: 0 for an empty one, else 1 to 15."""
    for batch in batches:
        if batch.num_rows:
            regs = np.stack([np.frombuffer(r.as_py(), np.uint16) for r in batch.column(1)])
            nibs = np.where(regs > 0, regs % 15 + 1, 0).astype(np.uint8)
            packed = nibs[:, ::2] | (nibs[:, 1::2] << 4)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in packed], pa.binary())],
                                             ["doc", "nibs"])


class Trees:
    """Union-find over the rows of a block; rows of one component start in one tree."""

    def __init__(self, labels: np.ndarray):
        _, self.tree = np.unique(labels, return_inverse=True)
        self.up = list(range(int(self.tree.max(initial=-1)) + 1))

    def root(self, row: int) -> int:
        up, t = self.up, int(self.tree[row])
        while up[t] != t:
            up[t] = up[up[t]]
            t = up[t]
        return t

    def join(self, p: int, q: int) -> None:
        self.up[q] = p


def _unpacked(column) -> np.ndarray:
    rows = column.to_pylist()
    packed = np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1)
    nibs = np.empty((len(rows), REGISTERS), np.uint8)
    nibs[:, ::2], nibs[:, 1::2] = packed & 15, packed >> 4
    return nibs


def _block_links(threshold: int, k: int, exact: bool):
    """Links of a block between components, from its likely pairs.

    Without ``exact``: a spanning set of links between component labels (a, b)
    and each document that has a likely partner (doc, with its label as a and b).
    With ``exact``: a spanning set of document pairs that verify on the texts.
    """
    t, chance = threshold / 100, 1 / 15

    def run(batches):
        for table in whole_groups(batches):
            g, doc, c, own, chunk = (table.column(n).to_numpy() for n in ("g", "doc", "c", "own", "chunk"))
            nibs = _unpacked(table.column("nibs"))
            # components meet only within a block: the same label in another block is another tree
            trees = Trees(np.stack([g, c], axis=1).view([("g", np.int64), ("c", np.int64)]).reshape(-1))
            sets = [shingle_set(x.as_py(), k) for x in table.column("text")] if exact else None
            out, marked = [], np.zeros(len(g), bool)
            for i, j in pairs_in(g, own, chunk):
                apart = c[i] != c[j]
                i, j = i[apart], j[apart]
                if not len(i):
                    continue
                x, y = nibs[i], nibs[j]
                used = np.count_nonzero(x | y, axis=1)
                same = np.count_nonzero((x == y) & (x > 0), axis=1) / used
                least = t - SIGMAS * np.sqrt(t * (1 - t) / used)
                ok = same >= least + (1 - least) * chance - SIGMAS * np.sqrt(chance / used) * (1 - t)
                marked[i[ok]] = marked[j[ok]] = True
                for p, q in zip(i[ok].tolist(), j[ok].tolist()):
                    r, s = trees.root(p), trees.root(q)
                    if r == s:
                        continue
                    if exact:
                        a, b = sets[p], sets[q]
                        if 100 * min(len(a), len(b)) < threshold * max(len(a), len(b)):
                            continue
                        both = len(np.intersect1d(a, b, assume_unique=True))
                        if 100 * both < threshold * (len(a) + len(b) - both):
                            continue
                    trees.join(r, s)
                    out.append((p, q))
            e, m = np.array(out, np.int64).reshape(-1, 2), np.flatnonzero(marked)
            if exact:
                yield pa.RecordBatch.from_arrays([pa.array(doc[e[:, 0]]), pa.array(doc[e[:, 1]])], ["a", "b"])
            else:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([c[e[:, 0]], c[m]])), pa.array(np.concatenate([c[e[:, 1]], c[m]])),
                     pa.array([None] * len(e) + doc[m].tolist(), pa.int64())], ["a", "b", "doc"])
    return run


def estimate(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected Jaccard estimate of register rows, and the number of buckets it rests on."""
    used = ((a > 0) | (b > 0)).sum(axis=1)
    same = ((a == b) & (a > 0)).sum(axis=1) / np.maximum(used, 1)
    return np.clip((same - COLLISION) / (1 - COLLISION), 0, 1), used


def verified(pairs: DataFrame, classes: DataFrame, texts: DataFrame, k: int, threshold: int) -> DataFrame:
    """The pairs of classes (a, b) whose sets have 100 * intersection >= threshold * union."""
    t = threshold / 100

    def likely(batches):
        for batch in batches:
            if batch.num_rows:
                a, b = (np.stack([np.frombuffer(r.as_py(), np.uint16) for r in batch.column(i)]) for i in (6, 7))
                j, used = estimate(a, b)
                ok = j >= t - SIGMAS * np.sqrt(t * (1 - t) / np.maximum(used, 1))
                yield batch.select(range(6)).filter(pa.array(ok))

    def check(batches):
        known: dict[int, np.ndarray] = {}

        def of(doc, tx):
            if doc not in known:
                if len(known) >= 64:
                    known.pop(next(iter(known)))
                known[doc] = shingle_set(tx.as_py(), k)
            return known[doc]

        for batch in batches:
            ok = []
            for a, b, ta, tb in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                sa, sb = of(a, ta), of(b, tb)
                both = len(np.intersect1d(sa, sb, assume_unique=True))
                ok.append(100 * both >= threshold * (len(sa) + len(sb) - both))
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    def side(x):
        return classes.select(F.col("node").alias(x), F.col("doc_id").alias(f"d{x}"), F.col("text_hash").alias(f"h{x}"),
                              F.col("regs").alias(f"r{x}"))

    near = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "da", "ha", "db", "hb", "ra", "rb") \
        .mapInArrow(likely, "a long, b long, da long, ha long, db long, hb long")
    near = stash(near, "estimated")

    def text(x):
        return texts.select(F.col("doc_id").alias(f"d{x}"), F.col("text_hash").alias(f"h{x}"), F.col("text").alias(f"t{x}"))

    return near.join(text("a"), ["da", "ha"]).join(text("b"), ["db", "hb"]) \
        .select("a", "b", "ta", "tb").mapInArrow(check, "a long, b long")


def id_links(some: DataFrame, shared: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs of classes (a, b) that hold texts of one doc_id, each with the doc_id's smallest class."""
    named = some.join(shared, "doc_id", "left_semi").select("doc_id", "f1", "f2").distinct() \
        .join(classes.select("f1", "f2", "node"), ["f1", "f2"]).select("doc_id", "node")
    least = named.groupBy("doc_id").agg(F.min("node").alias("a"))
    return named.join(least, "doc_id").where("a <> node").select("a", F.col("node").alias("b"))


def near_duplicates(docs: DataFrame, k: int = SHINGLE, threshold: int = THRESHOLD, doc_id: str = "doc_id",
                    text: str = "text", link_ids: bool = True) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id of the group), kept (doc_id = component_id), text_hash, stays.

    ``stays``: the row has the doc_id and text that stand for its group (or links
    with nothing), so one text of each group stays even where doc_ids repeat.
    """
    prepare_workers(docs.sparkSession)
    docs = keyed(docs, doc_id, text)
    sigs = stash(signatures(docs, k), "signatures")
    # classes of equal sets; the text of their smallest document stands for them
    some = sigs.where("n_shingles > 0 and doc_id is not null")
    classes = stash(some.groupBy("f1", "f2").agg(
        F.min("doc_id").alias("doc_id"), F.min_by("text_hash", "doc_id").alias("text_hash"), F.any_value("regs").alias("regs"))
        .withColumn("node", F.monotonically_increasing_id()), "classes")
    shared = stash(some.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id"), "shared_ids")
    texts = docs if shared.isEmpty() else single_texts(docs, shared)
    bands = stash(classes.select("node", "regs").mapInArrow(_bands, "doc long, key long"), "bands")
    hubs = bands.groupBy("key").agg(F.min("doc").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    members = stash(bands.join(hubs, "key"), "members")
    # round 1: every member with its buckets' hubs
    first = stash(members.where("doc <> hub").select(F.col("hub").alias("a"), F.col("doc").alias("b")).distinct(), "pairs")
    links = stash(verified(first, classes, texts, k, threshold), "links")
    # round 2: within buckets, whatever the first links have not joined
    joined = components(links)
    placed = members.select("key", "doc").join(joined.select(F.col("node").alias("doc"), "component"), "doc", "left") \
        .select("key", "doc", F.coalesce("component", "doc").alias("c"))
    placed = stash(placed, "placed")
    split = stash(placed.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count(F.lit(1)).alias("_n"))
                  .where("lo < hi").select("key", "_n"), "split")
    open_ = chunk_pairs(placed, "key", "doc", BLOCK_ROWS, split)
    small = stash(classes.select("node", "regs").mapInArrow(_nibbles, "doc long, nibs binary"), "sketches")
    tasks = shuffle_partitions(docs.sparkSession)
    likely = stash(open_.join(small, "doc").select("g", "doc", "c", "own", "chunk", "nibs")
                   .repartition(tasks, "g").sortWithinPartitions("g")
                   .mapInArrow(_block_links(threshold, k, False), "a long, b long, doc long"), "likely")
    families = components(likely.where("doc is null").select("a", "b")) \
        .select(F.col("node").alias("c"), F.col("component").alias("family"))
    whole = likely.where("doc is not null").select("doc", F.col("a").alias("c")).dropDuplicates(["doc"]) \
        .join(small, "doc").join(classes.select(F.col("node").alias("doc"), "doc_id", "text_hash"), "doc") \
        .join(texts.select("doc_id", "text_hash", "text"), ["doc_id", "text_hash"]).join(families, "c")
    more = chunk_pairs(stash(whole.select("family", "doc", "c", "nibs", "text"), "families"), "family", "doc", VERIFY_ROWS) \
        .select("g", "doc", "c", "own", "chunk", "nibs", "text").repartition(tasks, "g").sortWithinPartitions("g") \
        .mapInArrow(_block_links(threshold, k, True), "a long, b long")
    edges = links.unionByName(more)
    if link_ids and not shared.isEmpty():
        edges = edges.unionByName(id_links(some, shared, classes))
    final = stash(components(edges), "components")
    # the smallest document of a component's classes stands for all of them
    placed = final.join(classes.select("node", "doc_id", "text_hash"), "node")
    stand = placed.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.min_by("text_hash", "doc_id").alias("stays_hash"))
    named = classes.select("f1", "f2", "node", F.col("doc_id").alias("least"), F.col("text_hash").alias("least_hash")) \
        .join(final, "node", "left").join(stand, "component", "left") \
        .select("f1", "f2", F.coalesce("component_id", "least").alias("found"), F.coalesce("stays_hash", "least_hash").alias("found_hash"))
    linked = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    return sigs.join(named, ["f1", "f2"], "left").select(
        "doc_id", "n_shingles", F.when(linked, F.col("found")).otherwise(F.col("doc_id")).alias("component_id"), "text_hash",
        (~linked | ((F.col("found") == F.col("doc_id")) & (F.col("found_hash") == F.col("text_hash")))).alias("stays")) \
        .select("doc_id", "n_shingles", "component_id",
                (F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id"))).alias("kept"), "text_hash", "stays")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents")).drop("text_hash", "stays")
