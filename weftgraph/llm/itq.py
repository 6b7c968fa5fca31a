"""Operator 9: near-duplicate embeddings by iterative quantisation and multi-index Hamming tables.

1. Equal vectors of a label form one class at once; its smallest vec_id stands
   for it, with the number of copies.
2. On a bounded sample per dimension (``SAMPLE_ROWS``) the data are centred,
   projected on their principal axes and rotated so that the signs of the
   coordinates lose as little as possible (iterative quantisation).  Every vector
   gets the code of its signs (64 bits).  On the sample the recall of pairs right
   at the cosine bound is measured; while it is under ``RECALL`` (vectors with a
   strong common direction, which centring takes away), the code gets further
   words of 64 bits from random directions, and the radius follows.  Where the largest
   number of words does not do (a background cosine near the bound, which codes can't tell from it),
   all pairs of a label are compared by cosine in blocks of bounded size instead: exact, at quadratic work per label.
3. Each word of a code is cut into four 16-bit parts, one table each.  A vector stands in a
   table under its part and under the 16 parts one bit away, so two vectors meet
   wherever a part differs in at most two bits: always up to 11 bits of the code,
   nearly always beyond.  Each pair counts in one place only: the first table in
   which it meets, under the smallest common key.
4. First only codes are dealt to the keys, to find the vectors that meet a partner
   within the radius; only these are then dealt with their vectors, and the
   cosine of the original vectors (double precision) decides.  A key with many
   vectors is cut into chunks and the chunks meet in pairs, so no task holds a
   key.  A task puts out a count of links per vector and a spanning set of links,
   not the pairs.

Vectors that are null, empty, zero or hold null or non-finite components, and
vectors without a label, link with nothing.  Vectors of different length never
link.  Repeated rows of a vec_id are each returned; they count as copies of each
other.  An empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import chunk_pairs, pairs_in, whole_groups
from .common import prepare_workers, read, shuffle_partitions, stash
from .components import components, contract

COSINE = 0.93
BITS, TABLES, PART = 64, 4, 16
RADIUS = 18  # of 64 bits at least; without a common direction a pair at cosine 0.93 differs in 8, with a deviation of 2.6
RECALL, WORDS = 0.98, (1, 2, 4, 8, 16, 32)
SAMPLE_ROWS, ITERATIONS, CHUNK, EXACT_CHUNK = 8192, 50, 256, 1024
POP16 = np.array([bin(i).count("1") for i in range(1 << PART)], np.uint8)


def fit_rotation(sample: np.ndarray, bits: int = BITS, iterations: int = ITERATIONS, seed: int = 3):
    """(mean, projection) of unit vectors; the code of x is the signs of (x - mean) @ projection."""
    rng = np.random.default_rng(seed)
    n, d = sample.shape
    mean = sample.mean(axis=0) if n else np.zeros(d)
    axes = np.linalg.qr(rng.normal(size=(d, d)))[0]
    if n > 1:
        values, vectors = np.linalg.eigh(np.cov((sample - mean).T).reshape(d, d))
        axes = vectors[:, np.argsort(-values)]
    c = min(bits, d)
    axes = axes[:, :c]
    rotation = np.linalg.qr(rng.normal(size=(c, c)))[0]
    v = (sample - mean) @ axes
    for _ in range(iterations if n > c else 0):
        u, _, w = np.linalg.svd(np.where(v @ rotation >= 0, 1.0, -1.0).T @ v)
        rotation = (u @ w).T
    projection = axes @ rotation
    if c < bits:  # fewer dimensions than bits: further bits from random directions
        projection = np.hstack([projection, rng.normal(size=(d, bits - c))])
    return mean, projection


def with_words(model, words: int, seed: int = 7):
    """The model with ``words`` words of 64 bits: those after the first from random directions, the same for any ``words``."""
    mean, projection = model
    rng = np.random.default_rng(seed)
    return mean, np.hstack([projection, *(rng.normal(size=(len(mean), BITS)) for _ in range(words - 1))])


def codes_of(unit: np.ndarray, model) -> np.ndarray:
    """Codes as rows of 64-bit words."""
    mean, projection = model
    bits = ((unit - mean) @ projection >= 0).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64).reshape(len(unit), projection.shape[1] // BITS)


def pairs_at(sample: np.ndarray, mean: np.ndarray, cosine: float, seed: int = 11):
    """Pairs of unit vectors at exactly ``cosine``: sampled ones and partners that share their part along the mean.

    The partner differs in the direction of another sampled vector, as the table's own vectors differ.
    """
    length = np.linalg.norm(mean)
    axis = mean / length if length > 1e-9 else np.zeros_like(mean)
    along = (sample @ axis)[:, None] * axis
    rest = sample - along
    size = np.linalg.norm(rest, axis=1)
    other = rest[np.random.default_rng(seed).permutation(len(rest))]
    share = np.einsum("ij,ij->i", other, rest) / np.maximum(size ** 2, 1e-300)
    off = other - share[:, None] * rest
    off_size = np.linalg.norm(off, axis=1)
    # within the part off the mean, the cosine that makes the whole one
    inner = (cosine - (1 - size ** 2)) / np.maximum(size ** 2, 1e-300)
    ok = (off_size > 1e-9) & (np.abs(inner) < 1)
    i, inner = np.flatnonzero(ok), inner[ok]
    turn = np.sqrt(1 - inner ** 2) * size[i] / off_size[i]
    return sample[i], along[i] + inner[:, None] * rest[i] + turn[:, None] * off[i]


def choose_words(sample: np.ndarray, model, cosine: float) -> tuple[int, int] | None:
    """(words, radius in bits per word) with which ``RECALL`` of the pairs at ``cosine`` meet; None where no number of words does."""
    x, y = pairs_at(sample, model[0], cosine)
    if not len(x):
        return WORDS[0], RADIUS
    full = with_words(model, WORDS[-1])
    gap = _gaps(codes_of(x, full) ^ codes_of(y, full))
    for words in WORDS:
        here = gap[:words * TABLES]
        met, bits = (here <= 2).any(axis=0), here.sum(axis=0, dtype=np.int64)
        # a little more than the distance that all but a hundredth of the pairs keep to
        radius = max(RADIUS, int(np.ceil(np.quantile(bits, 0.995) / words)))
        recall = (met & (bits <= radius * words)).mean()
        if recall >= RECALL:
            return words, radius
    return None


def _rows(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that no square over- or underflows
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _part(code: np.ndarray, t) -> np.ndarray:
    return ((code >> (np.asarray(t, np.uint64) * np.uint64(PART))) & np.uint64(0xFFFF)).astype(np.int64)


def _gaps(diff: np.ndarray) -> np.ndarray:
    """Bits set in each 16-bit part (one row per table) of code differences."""
    return np.stack([POP16[_part(diff[:, t // TABLES], t % TABLES)] for t in range(diff.shape[1] * TABLES)])


def _meet_here(x: np.ndarray, y: np.ndarray, table: np.ndarray, key: np.ndarray, radius: int) -> np.ndarray:
    """Whether this is the one place where codes x and y count, and they are within the radius (bits per word)."""
    gap = _gaps(x ^ y)
    near = gap.sum(axis=0, dtype=np.int64) <= radius * x.shape[1]
    first = np.argmax(gap <= 2, axis=0)  # they meet in the table at hand, so there is one
    rows = np.arange(len(x))
    a, b = _part(x[rows, table // TABLES], table % TABLES), _part(y[rows, table // TABLES], table % TABLES)
    d = a ^ b
    low = d & -d
    one = np.minimum(a, b)  # one bit apart: both parts are common keys
    two = np.minimum(a ^ low, a ^ (d ^ low))  # two bits apart: the two parts between them
    g = POP16[d]
    common = np.where(g == 0, a, np.where(g == 1, one, two))
    # equal parts share 17 keys, of which the part itself counts
    return near & (first == table) & (common == key)


def _columns(t: pa.Table):
    n = lambda c: t.column(c).to_numpy()
    code = t.column("code").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(t.num_rows, -1)
    return n("g"), n("id"), code, n("tab").astype(np.int64), n("key"), n("own"), n("chunk"), n("lab")


def _find_partners(radius: int):
    """Keys and vectors that meet a partner there."""
    def run(batches):
        for t in whole_groups(batches):
            g, _, code, tab, key, own, chunk, lab = _columns(t)
            mark = np.zeros(len(g), bool)
            for i, j in pairs_in(g, own, chunk):
                ok = (lab[i] == lab[j]) & (tab[i] == tab[j]) & (key[i] == key[j])
                i, j = i[ok], j[ok]
                ok = _meet_here(code[i], code[j], tab[i], key[i], radius)
                mark[i[ok]] = mark[j[ok]] = True
            if mark.any():
                yield from t.filter(pa.array(mark)).to_batches()
    return run


def _link(cosine: float, radius: int):
    def run(batches):
        for t in whole_groups(batches):
            g, ids, code, tab, key, own, chunk, lab = _columns(t)
            copies = t.column("copies").to_numpy()
            size = pa.compute.list_value_length(t.column("embedding")).to_numpy()
            links = np.zeros(len(g), np.int64)
            root = np.arange(len(g))
            vectors: dict[int, tuple] = {}
            for d in np.unique(size):  # lab holds the dimension, so partners have the same one
                rows = np.flatnonzero(size == d)
                where = np.full(len(g), -1)
                where[rows] = np.arange(len(rows))
                vectors[int(d)] = (where, _unit(_rows(t.column("embedding").take(pa.array(rows)).combine_chunks())))
            edges = []
            for i, j in pairs_in(g, own, chunk):
                ok = (lab[i] == lab[j]) & (tab[i] == tab[j]) & (key[i] == key[j])
                i, j = i[ok], j[ok]
                ok = _meet_here(code[i], code[j], tab[i], key[i], radius)
                i, j = i[ok], j[ok]
                for d, (where, unit) in vectors.items():
                    same = size[i] == d
                    a, b = i[same], j[same]
                    if not len(a):
                        continue
                    near = np.einsum("ij,ij->i", unit[where[a]], unit[where[b]]) >= cosine
                    a, b = a[near], b[near]
                    np.add.at(links, a, copies[b])
                    np.add.at(links, b, copies[a])
                    # a spanning set: only links that join two trees of this batch
                    for p, q in zip(a[root[a] != root[b]].tolist(), b[root[a] != root[b]].tolist()):
                        while root[p] != p:
                            root[p] = root[root[p]]
                            p = root[p]
                        while root[q] != q:
                            root[q] = root[root[q]]
                            q = root[q]
                        if p != q:
                            root[max(p, q)] = min(p, q)
                            edges.append((p, q))
            hit = np.flatnonzero(links)
            p = np.array([e[0] for e in edges], np.int64)
            q = np.array([e[1] for e in edges], np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([ids[hit], ids[p]])),
                 pa.array(np.concatenate([links[hit], np.zeros(len(p), np.int64)])),
                 pa.array([None] * len(hit) + ids[q].tolist(), pa.int64())], ["id", "links", "other"])
    return run


def _link_all(cosine: float):
    """The same from all pairs of a block, for tables whose codes don't tell near vectors from others."""
    def run(batches):
        for t in whole_groups(batches):
            ids, copies, lab, own, chunk = (t.column(c).to_numpy() for c in ("id", "copies", "lab", "own", "chunk"))
            links, edges, trees = np.zeros(len(ids), np.int64), [], np.arange(len(ids))
            block = np.stack([t.column("g").to_numpy(), lab], axis=1)  # lab: a label and a dimension
            for one in np.unique(block, axis=0):
                rows = np.flatnonzero((block == one).all(axis=1))
                unit = _unit(_rows(t.column("embedding").take(pa.array(rows)).combine_chunks()))
                a, b = np.nonzero(np.triu(unit @ unit.T >= cosine - 1e-9, 1))
                near = np.einsum("ij,ij->i", unit[a], unit[b]) >= cosine if len(a) else np.zeros(0, bool)
                a, b = rows[a[near]], rows[b[near]]
                use = own[a] | (chunk[a] != chunk[b])
                a, b = a[use], b[use]
                np.add.at(links, a, copies[b])
                np.add.at(links, b, copies[a])
                if len(a):
                    low, high = contract(a, b)  # a spanning set: each row with the smallest one it reaches here
                    edges += zip(low.tolist(), high.tolist())
            hit = np.flatnonzero(links)
            p, q = np.array([e[0] for e in edges], np.int64), np.array([e[1] for e in edges], np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([ids[hit], ids[p]])), pa.array(np.concatenate([links[hit], np.zeros(len(p), np.int64)])),
                 pa.array([None] * len(hit) + ids[q].tolist(), pa.int64())], ["id", "links", "other"])
    return run


def near_vectors(vectors: DataFrame, cosine: float = COSINE, sample_rows: int = SAMPLE_ROWS, vec_id: str = "vec_id",
                 embedding: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    prepare_workers(spark)
    given = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"),
                           F.col(embedding).cast("array<double>").alias("embedding"))
    usable = F.expr("coalesce(label is not null and vec_id is not null and size(embedding) > 0 "
                    "and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) "
                    "and exists(embedding, x -> x <> 0), false)")
    given = given.withColumn("usable", usable)
    classes = stash(given.where("usable").groupBy("label", "embedding")
                    .agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies"))
                    .withColumn("lab", F.xxhash64("label", F.size("embedding"))), "vectors")
    # one bounded sample per dimension; the number of dimensions is that of the table's models
    dims = [r[0] for r in classes.select(F.size("embedding").alias("d")).distinct().collect()]
    models, words, radius, exact = {}, WORDS[0], RADIUS, False
    for d in dims:
        of = classes.where(F.size("embedding") == d)
        rows = of.sample(False, min(1.0, 1.5 * sample_rows / max(1, of.count())), 5).limit(sample_rows) \
            .select("embedding").collect()
        unit = _unit(np.array([r[0] for r in rows], float).reshape(-1, d)) if rows else np.zeros((0, d))
        models[d] = fit_rotation(unit)
        needed = choose_words(unit, models[d], cosine)
        exact = exact or needed is None
        words, radius = max(words, needed[0] if needed else 0), max(radius, needed[1] if needed else 0)
    if exact:
        linked = stash(
            chunk_pairs(classes, "lab", "id", EXACT_CHUNK).select("g", "id", "lab", "own", "chunk", "copies", "embedding")
            .repartition(shuffle_partitions(spark), "g").sortWithinPartitions("g")
            .mapInArrow(_link_all(cosine), "id long, links long, other long"), "linked")
        return _grouped(given, classes, linked)
    models = {d: with_words(model, words) for d, model in models.items()}

    def code(batches):
        for batch in batches:
            out = np.zeros((batch.num_rows, words), np.uint64)
            e = batch.column(1)
            size = pa.compute.list_value_length(e).to_numpy(zero_copy_only=False)
            for d in np.unique(size):
                rows = np.flatnonzero(size == d)
                out[rows] = codes_of(_unit(_rows(e.take(pa.array(rows)))), models[int(d)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(
                pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * words), pa.array(out.view(np.int64).reshape(-1))),
                batch.column(2)],
                                             ["id", "code", "lab"])

    coded = stash(classes.select("id", "embedding", "lab").mapInArrow(code, "id long, code array<long>, lab long"), "codes")
    part = f"shiftrightunsigned(code[int(tab div {TABLES})], {PART} * (tab % {TABLES})) & 65535"
    keyed = coded.select("id", "code", "lab", F.explode(F.sequence(F.lit(0), F.lit(words * TABLES - 1))).alias("tab")) \
        .withColumn("key", F.explode(F.expr(
            f"concat(array({part}), transform(sequence(0, {PART - 1}), b -> ({part}) ^ shiftleft(1L, b)))"))) \
        .withColumn("k", F.xxhash64("lab", "tab", "key"))
    keyed = stash(keyed, "keys")
    cut = chunk_pairs(keyed, "k", "id", CHUNK).select("g", "id", "code", "tab", "key", "own", "chunk", "lab")
    schema = "g long, id long, code array<long>, tab int, key long, own boolean, chunk int, lab long"
    p = shuffle_partitions(spark)
    found = stash(cut.repartition(p, "g").sortWithinPartitions("g").mapInArrow(_find_partners(radius), schema), "partners")
    linked = stash(
        found.join(classes.select("id", "copies", "embedding"), "id")
        .select("g", "id", "code", "tab", "key", "own", "chunk", "lab", "copies", "embedding")
        .repartition(p, "g").sortWithinPartitions("g")
        .mapInArrow(_link(cosine, radius), "id long, links long, other long"), "linked")
    return _grouped(given, classes, linked)


def _grouped(given: DataFrame, classes: DataFrame, linked: DataFrame) -> DataFrame:
    """Numbers of links and components of the rows, from the links of their classes (equal vectors)."""
    counts = linked.groupBy("id").agg(F.sum("links").alias("links"))
    groups = components(linked.where("other is not null").select(F.col("id").alias("a"), F.col("other").alias("b")))
    named = classes.select("label", "embedding", "id", "copies").join(counts, "id", "left") \
        .join(groups.withColumnRenamed("node", "id"), "id", "left") \
        .select("label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"),
                F.coalesce("component", "id").alias("c"))
    # rows that cannot link are kept apart, so that their null or zero vectors are no join key
    out = given.where("usable").drop("usable").join(named, ["label", "embedding"]) \
        .select("vec_id", F.col("n").alias("n_links"), F.col("c").alias("component_id")) \
        .unionByName(given.where("not usable").select(
            "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return out.withColumn("kept", F.col("vec_id").isNull() | (F.col("vec_id") == F.col("component_id")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read(spark, sf_dir, "embeddings"))
