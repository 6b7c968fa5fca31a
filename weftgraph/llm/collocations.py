"""Operator 13: phrase collocations by best-first branch and bound over prefix counts.

A phrase of 2 to ``MAX_WORDS`` words scores ``floor(SCALE * a / (l + r))`` at its lowest cut (a, l, r: occurrences of
the phrase, of the part before and of the part after the cut).  With counts of the first words only, no
phrase that begins with ``p`` can score more than ``SCALE * f(p) / (f(first word) + f(p))``, as its own count
is f(p) at most and both its parts come as often as itself at least; the same holds for its last words.

1. One pass counts all words of each language, a second one all pairs of words that come ``MIN_COUNT`` times.
2. A round sets each language's bound to the score of its ``GROWTH * TOP``-th pair and grows only the pairs, as prefix or
   suffix, that may still reach it, to three and four words in one pass.  Everything that
   scores the bound or more is then counted, with all its parts and with the longer phrases that may drop it.
3. A language is settled when ``TOP`` phrases at or above its bound survive; ties at the bound are among them.  The others
   get a lower bound (that of ``GROWTH`` times as many pairs) and another round; at bound 0 nothing is left out.

Words are 64-bit hashes of language and word while counting; that no two words share one is checked on all words
(else another seed is taken), so all counts are exact.  Which phrases to count is known to the tasks by Bloom
filters of fixed size (``FILTER_BITS``): a false positive counts a phrase in vain, nothing is missed.  Tasks sum
occurrences before they are shuffled, so a phrase with a third of all occurrences is a row a task.  Products are
decimals of 38 digits.

A null text is empty; a null lang is ``und``.  Repeated rows count again.  Texts are read whole, in slices of bounded
memory.  Extra columns, a null or repeated doc_id don't matter.  An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import prepare_workers, read, stash
from .hyperminhash import STEP, mix

MAX_WORDS, MIN_COUNT, TOP = 4, 30, 2000
SCALE, DROP_PCT = 2_000_000, 80
GROWTH = 4
FILTER_BITS = 26  # 8 MB a filter
BUFFER_WORDS, LEXICON_WORDS, SLICE_BYTES = 1 << 21, 1 << 19, 1 << 22
BREAK = b"\xff"  # in no UTF-8 text
#: Bytes as the words need them: A-Z lower-cased, separators of pieces as BREAK, a tab as a space.
LETTERS = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t" + b".,;:!?\n\v\f\r", b"abcdefghijklmnopqrstuvwxyz " + BREAK * 10)
RESULT = "lang string, rank long, phrase string, a long, l long, r long, n long, score long"


class Lexicon:
    """A task's own numbers of words; 0 is a break between pieces."""

    def __init__(self, seed: int):
        self.seed, self.by_lang = seed, {}
        self.langs, self.words, self.ids = [""], [BREAK], [0]

    def numbers(self, lang: str, words: list[bytes]) -> np.ndarray:
        known = self.by_lang.get(lang)
        if known is None:
            known = self.by_lang[lang] = _Numbers(self, lang)
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))


class _Numbers(dict):
    def __init__(self, lexicon: Lexicon, lang: str):
        super().__init__({BREAK: 0})
        self.lexicon, self.lang = lexicon, lang
        self.seed = xxhash.xxh3_64_intdigest(lang.encode(), lexicon.seed)

    def __missing__(self, word: bytes) -> int:
        x = self.lexicon
        n = self[word] = len(x.words)
        x.langs.append(self.lang)
        x.words.append(word)
        x.ids.append(xxhash.xxh3_64_intdigest(word, self.seed) or 1)
        return n


def word_slices(text: bytes):
    """The words of a whole text with BREAK between pieces, in slices of bounded size, cut between words."""
    data = text.translate(LETTERS)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + SLICE_BYTES) if len(data) - at > SLICE_BYTES else -1
        end = len(data) if end < 0 else end
        yield data[at:end].replace(BREAK, b" \xff ").split()
        at = end


def counted(batches, seed: int, tally):
    """Feed a task's texts (lang, text as bytes) as buffers of numbers to ``tally(lexicon, numbers)``, which yields batches."""
    lexicon, held, size = Lexicon(seed), [], 0
    stop = np.zeros(1, np.int64)
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            for words in word_slices(text.as_py() or b""):
                if words:
                    held.append(lexicon.numbers(lang, words))
                    size += len(words)
            held.append(stop)
            if size >= BUFFER_WORDS or len(lexicon.words) >= LEXICON_WORDS:
                yield from tally(lexicon, np.concatenate(held))
                held, size = [], 0
                if len(lexicon.words) >= LEXICON_WORDS:
                    lexicon = Lexicon(seed)
    if held:
        yield from tally(lexicon, np.concatenate(held))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                       F.col("text").cast("binary").alias("text"))


def word_counts(docs: DataFrame) -> tuple[DataFrame, int]:
    """lang, word, id, n of every word, and the seed under which all ids differ."""
    for seed in range(16):
        def tally(lexicon, numbers):
            n = np.bincount(numbers, minlength=len(lexicon.words))
            n[0] = 0
            used = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lexicon.langs[i] for i in used], pa.string()), pa.array([lexicon.words[i] for i in used], pa.binary()),
                 pa.array(np.array(lexicon.ids, np.uint64)[used].view(np.int64)), pa.array(n[used])],
                ["lang", "word", "id", "n"])

        def run(batches, seed=seed, tally=tally):
            yield from counted(batches, seed, tally)

        words = stash(_texts(docs).mapInArrow(run, "lang string, word binary, id long, n long")
                      .groupBy("lang", "word", "id").agg(F.sum("n").alias("n")), "words")
        if words.groupBy("id").count().where("count > 1").isEmpty():
            return words, seed
    raise RuntimeError("words share hashes under every seed")


def key_hash(columns: list[np.ndarray]) -> np.ndarray:
    h = mix(columns[0] + STEP)
    for c in columns[1:]:
        h = mix(h * STEP + c)
    return h


class BitFilter:
    """A Bloom filter of 2^FILTER_BITS bits with two places a key, as bytes."""

    def __init__(self, bits: bytes):
        self.bits = np.frombuffer(bits, np.uint8)

    def _at(self, place: np.ndarray) -> np.ndarray:
        return (self.bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1

    def has(self, h: np.ndarray) -> np.ndarray:
        out = self._at(_places(h, 0))
        maybe = np.flatnonzero(out)
        out[maybe] = self._at(_places(h[maybe], 1))
        return out


def _places(h: np.ndarray, which: int) -> np.ndarray:
    return ((h >> np.uint64(32 * which)) & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)


def bit_filter(keys: DataFrame):
    """The filter of all rows of ``keys`` (long columns), as a broadcast; Spark unites the bits, 4 kB a row."""
    spark = keys.sparkSession

    def places(batches):
        for batch in batches:
            h = key_hash([c.to_numpy().view(np.uint64) for c in batch.columns])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([_places(h, 0), _places(h, 1)]) + 1)], ["p"])

    parts = keys.mapInArrow(places, "p long").groupBy(F.bitmap_bucket_number("p").alias("b")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")).collect()
    bits = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for r in parts:  # at most 2^FILTER_BITS bits
        at = (r["b"] - 1) * 4096
        bits[at:at + 4096] = np.frombuffer(r["bits"], np.uint8)
    return spark.sparkContext.broadcast(bits.tobytes())


def phrase_counts(docs: DataFrame, seed: int, longest: int, places) -> DataFrame:
    """w1 … (null beyond a phrase's end), a: phrases with at least MIN_COUNT occurrences, among those that ``places(ids)`` names.

    ``places`` gets the word ids of a buffer (0 at breaks) and returns pairs of a length and the places where phrases of it start.
    """
    names = [f"w{i + 1}" for i in range(longest)]

    def tally(lexicon, numbers):
        ids = np.array(lexicon.ids, np.uint64)
        for k, at in places(ids[numbers]):
            if not len(at):
                continue
            code = numbers[at]
            for j in range(1, k):
                pair = code << 32 | numbers[at + j]
                if j < k - 1:
                    code = np.unique(pair, return_inverse=True)[1]
            order = np.argsort(pair)
            pair = pair[order]
            starts = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
            first = at[order[starts]]
            words = [pa.array(ids[numbers[first + j]].view(np.int64)) for j in range(k)]
            rest = [pa.nulls(len(first), pa.int64())] * (longest - k)
            yield pa.RecordBatch.from_arrays([*words, *rest, pa.array(np.diff(np.append(starts, len(pair))))], [*names, "a"])

    def run(batches):
        yield from counted(batches, seed, tally)

    return _texts(docs).mapInArrow(run, ", ".join(f"{n} long" for n in names) + ", a long") \
        .groupBy(*names).agg(F.sum("a").alias("a")).where(F.col("a") >= MIN_COUNT)


def pair_places(frequent):
    """Pairs of frequent words."""
    def places(ids):
        ok = (ids != 0) & BitFilter(frequent.value).has(key_hash([ids]))
        return [(2, np.flatnonzero(ok[:-1] & ok[1:]))]
    return places


def open_places(frequent, before, after):
    """Phrases of three and four words whose pairs are frequent and whose first pair is in ``before`` or last in ``after``."""
    def places(ids):
        if len(ids) < 3:
            return []
        h = key_hash([ids[:-1], ids[1:]])
        known = np.flatnonzero((ids[:-1] != 0) & (ids[1:] != 0))
        ok, first, last = (np.zeros(len(h), bool) for _ in range(3))
        ok[known] = BitFilter(frequent.value).has(h[known])
        known = np.flatnonzero(ok)
        first[known], last[known] = BitFilter(before.value).has(h[known]), BitFilter(after.value).has(h[known])
        return [(3, np.flatnonzero(ok[:-1] & ok[1:] & (first[:-1] | last[1:]))),
                (4, np.flatnonzero(ok[:-2] & ok[1:-1] & ok[2:] & (first[:-2] | last[2:])))]
    return places


def _big(column):
    return F.col(column).cast("decimal(20,0)") if isinstance(column, str) else column.cast("decimal(20,0)")


def _score(a, l, r):
    return F.call_function("div", _big(a) * F.lit(SCALE).cast("decimal(8,0)"), _big(F.col(l) + F.col(r)))


def _may_reach(end: str):
    """No phrase with this prefix (suffix) and its first (last) word's count ``end`` scores theta when this is false."""
    return _big("a") * F.lit(SCALE).cast("decimal(8,0)") >= _big(F.col("theta")) * _big(F.col(end) + F.col("a"))


def _scored(phrases: DataFrame, cuts: list[tuple[str, str]]) -> DataFrame:
    """Add score, l, r of the lowest cut, the first one of equal ones."""
    best = F.array_min(F.array(*[F.struct(_score("a", l, r).alias("score"), F.lit(k).alias("k"), F.col(l).alias("l"),
                                          F.col(r).alias("r")) for k, (l, r) in enumerate(cuts)]))
    return phrases.withColumn("_cut", best).withColumn("score", F.col("_cut.score")) \
        .withColumn("l", F.col("_cut.l")).withColumn("r", F.col("_cut.r")).drop("_cut")


def scored_pairs(pairs: DataFrame, words: DataFrame) -> DataFrame:
    w = words.where(F.col("n") >= MIN_COUNT)
    first = w.select(F.col("id").alias("w1"), F.col("n").alias("f1"), "lang")
    last = w.select(F.col("id").alias("w2"), F.col("n").alias("f2"))
    return _scored(pairs.join(first, "w1").join(last, "w2"), [("f1", "f2")])


def scored_triples(triples: DataFrame, pairs: DataFrame) -> DataFrame:
    before = pairs.select("lang", "w1", "w2", "f1", F.col("a").alias("f12"))
    after = pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("f2").alias("f3"), F.col("a").alias("f23"))
    return _scored(triples.join(before, ["w1", "w2"]).join(after, ["w2", "w3"]), [("f1", "f23"), ("f12", "f3")])


def scored_quadruples(quadruples: DataFrame, triples: DataFrame) -> DataFrame:
    before = triples.select("lang", "w1", "w2", "w3", "f1", "f12", F.col("a").alias("f123"))
    after = triples.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("w3").alias("w4"),
                           F.col("f23").alias("f34"), F.col("f3").alias("f4"), F.col("a").alias("f234"))
    return _scored(quadruples.join(before, ["w1", "w2", "w3"]).join(after, ["w2", "w3", "w4"]),
                   [("f1", "f234"), ("f12", "f34"), ("f123", "f4")])


def _unless_inside(phrases: DataFrame, longer: DataFrame, k: int) -> DataFrame:
    """Without the phrases of k words that a longer one takes along: one word more is enough, as it comes as often at least."""
    names = [f"w{i + 1}" for i in range(k)]
    tail = [F.col(f"w{i + 2}").alias(n) for i, n in enumerate(names)]
    most = longer.select(*names, "a").unionByName(longer.select(*tail, "a")).groupBy(*names).agg(F.max("a").alias("_most"))
    return phrases.join(most, names, "left") \
        .where(F.col("_most").isNull() | (100 * _big("_most") < DROP_PCT * _big("a"))).drop("_most")


def _at_rank(scores: DataFrame, order: list[str], rank: int) -> DataFrame:
    """lang and ``order`` columns of the value at which each language has ``rank`` rows, best first; none where it has fewer."""
    n = scores.groupBy("lang", *order).agg(F.count(F.lit(1)).alias("_n"))
    best_first = Window.partitionBy("lang").orderBy(*[F.desc(c) for c in order])
    upto = n.withColumn("_upto", F.sum("_n").over(best_first))
    return upto.where((F.col("_upto") >= rank) & (F.col("_upto") - F.col("_n") < rank)).select("lang", *order)


def _open_keys(phrases: DataFrame, end: str, names: list[str]):
    return bit_filter(phrases.where(_may_reach(end)).select(*names))


def grow(docs: DataFrame, seed: int, pairs: DataFrame, theta: DataFrame) -> DataFrame:
    """All phrases of the languages of ``theta`` that survive with a score of theta or more.

    One pass over the texts expands every open prefix and suffix to three and four words.

    lang, w1 … w4, a, l, r, score
    """
    two = stash(pairs.join(theta, "lang"), "pairs")
    keys = ["w1", "w2"]
    longer = stash(phrase_counts(docs, seed, 4, open_places(
        bit_filter(two.select(keys)), _open_keys(two, "f1", keys), _open_keys(two, "f2", keys))), "longer")
    three = stash(scored_triples(longer.where("w4 is null").drop("w4"), two).join(theta, "lang"), "triples")
    four = longer.where("w4 is not null")
    no = F.lit(None).cast("long")
    found = [_unless_inside(two.where("score >= theta"), three, 2).withColumn("w3", no).withColumn("w4", no),
             _unless_inside(three.where("score >= theta"), four, 3).withColumn("w4", no),
             scored_quadruples(four, three).join(theta, "lang").where("score >= theta")]
    columns = ["lang", "w1", "w2", "w3", "w4", "a", "l", "r", "score"]
    return found[0].select(columns).unionByName(found[1].select(columns)).unionByName(found[2].select(columns))


def survivors(docs: DataFrame, words: DataFrame, seed: int) -> DataFrame | None:
    """For each language its survivors down to a score that TOP of them reach (or all)."""
    frequent = bit_filter(words.where(F.col("n") >= MIN_COUNT).select("id"))
    pairs = stash(scored_pairs(phrase_counts(docs, seed, 2, pair_places(frequent)), words), "pairs")
    unsettled = stash(pairs.select("lang").distinct(), "langs")
    done, rank = None, GROWTH * TOP  # reading the texts costs more than a wide frontier
    while not unsettled.isEmpty():
        theta = stash(unsettled.join(_at_rank(pairs.join(unsettled, "lang"), ["score"], rank), "lang", "left")
                      .select("lang", F.coalesce("score", F.lit(0)).cast("long").alias("theta")), "theta")
        found = stash(grow(docs, seed, pairs, theta), "survivors")
        enough = theta.join(found.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "lang", "left") \
            .select("lang", ((F.col("theta") == 0) | (F.coalesce("n", F.lit(0)) >= TOP)).alias("enough"))
        settled = found.join(enough.where("enough").select("lang"), "lang")
        done = settled if done is None else done.unionByName(settled)
        unsettled = stash(enough.where("not enough").select("lang"), "langs")
        rank *= GROWTH
    return done


def mine(docs: DataFrame) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first TOP phrases of ``docs`` (lang, text)."""
    spark = docs.sparkSession
    prepare_workers(spark)
    words, seed = word_counts(docs)
    found = survivors(docs, words, seed)
    if found is None:
        return spark.createDataFrame([], RESULT)
    last = _at_rank(found, ["score", "a"], TOP).select("lang", F.col("score").alias("_s"), F.col("a").alias("_a"))
    best = found.join(last, "lang", "left").where(
        F.col("_s").isNull() | (F.col("score") > F.col("_s")) | ((F.col("score") == F.col("_s")) & (F.col("a") >= F.col("_a"))))
    text = words.select("id", F.col("word").cast("string").alias("word"))
    for i in range(1, MAX_WORDS + 1):
        best = best.join(text.select(F.col("id").alias(f"w{i}"), F.col("word").alias(f"t{i}")), f"w{i}", "left")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    # the limit on the plain row number lets every task keep its own first TOP rows before the shuffle
    return best.withColumn("phrase", F.concat_ws(" ", "t1", "t2", "t3", "t4")) \
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP) \
        .join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(read(spark, sf_dir, "documents"))


ORACLE = r"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents)),
spots AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces WHERE len(w) > 0),
lengths AS (SELECT unnest([1, 2, 3, 4]) AS k),
f AS (SELECT lang, k, w[i:i + k - 1] AS p, count(*) AS n FROM spots, lengths WHERE i + k - 1 <= len(w) GROUP BY ALL),
totals AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, p, n AS a FROM f WHERE k > 1 AND n >= 30),
cuts AS (SELECT lang, k, p, a, unnest(range(1, k)) AS c FROM cand),
scores AS (
  SELECT cuts.lang, cuts.k, cuts.p, a, c, l.n AS l, r.n AS r, (2000000::HUGEINT * a) // (l.n + r.n) AS score
  FROM cuts JOIN f l ON l.lang = cuts.lang AND l.p = cuts.p[1:c] JOIN f r ON r.lang = cuts.lang AND r.p = cuts.p[c + 1:cuts.k]),
best AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, c) = 1),
inside AS (
  SELECT DISTINCT s.lang, s.p
  FROM cand b JOIN (SELECT 2 AS k UNION ALL SELECT 3) t ON t.k < b.k JOIN (SELECT unnest([1, 2, 3]) AS i) o ON o.i + t.k - 1 <= b.k
  JOIN cand s ON s.lang = b.lang AND s.p = b.p[o.i:o.i + t.k - 1] WHERE 100::HUGEINT * b.a >= 80::HUGEINT * s.a),
ranked AS (
  SELECT best.lang, array_to_string(best.p, ' ') AS phrase, a, l, r, score::BIGINT AS score,
         row_number() OVER (PARTITION BY best.lang ORDER BY score DESC, a DESC, array_to_string(best.p, ' ')) AS rank
  FROM best LEFT JOIN inside ON inside.lang = best.lang AND inside.p = best.p WHERE inside.p IS NULL)
SELECT ranked.lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, totals.n AS n, score
FROM ranked JOIN totals ON totals.lang = ranked.lang WHERE rank <= 2000
"""
