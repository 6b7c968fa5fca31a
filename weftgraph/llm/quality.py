"""Operator 3: quality rules as a short-circuit cascade.

Base counts of every whole text come first; then the method's own rules form a
cascade: on a bounded random sample each rule's cost (seconds to evaluate it
alone) and selectivity (share rejected) are measured, and the rules are ordered
by rejection per cost.  The cascade is one ``CASE``: a document that an early
rule rejects never evaluates the later ones.  The order changes the work, never
the verdict.

* A null text has no words (all counts 0, ``base_failed`` true); an empty text
  likewise.  Every input row gives one row, repeated rows included; a null
  ``doc_id`` is returned as it is.  Extra columns are ignored.
* The 8-word windows are compared by a 64-bit hash of eight 64-bit word hashes
  within one text.  All of it is array work inside the row: nothing is shuffled
  and a long text is sorted once (n log n).
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read

WINDOW_WORDS = 8
SAMPLE_ROWS, REPEATS = 1000, 8
#: Fixed values of the base contract.
MIN_WORDS, MAX_REPEAT_PCT = 20, 30
WORD, SYMBOL = r"[^\\x20\\x09-\\x0D]+", r"[#*$%&|<>]"

#: name -> SQL condition that rejects a document; ``tx`` is the text, the base counts are columns.
RULES = {
    "symbols_per_word": "10 * n_symbols > n_words",
    "mean_word_length": "word_chars < 2 * n_words or word_chars > 20 * n_words",
    "repeated_lines": "10 * n_dup_lines > 3 * n_lines",
    "bullet_lines": r"10 * regexp_count(tx, '(?m)^[ \\t]*[-*\u2022]') > 9 * n_lines",
    "ellipsis_lines": r"10 * regexp_count(tx, '(?m)(\\.\\.\\.|\u2026)[ \\t]*$') > 3 * n_lines",
    "few_letters": r"2 * length(regexp_replace(tx, '[^\\p{L}]+', '')) < word_chars",
    "mostly_capitals": r"2 * length(regexp_replace(tx, '[^\\p{Lu}]+', '')) > word_chars",
    "mostly_digits": "10 * length(regexp_replace(tx, '[^0-9]+', '')) > 3 * word_chars",
    "placeholder": "tx ilike '%lorem ipsum%'",
    "code_braces": "20 * regexp_count(tx, '[{}]') > n_words",
}


def with_base(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, tx, the base counts (long), n_lines, base_failed and ``row`` (all columns of the input)."""
    k = WINDOW_WORDS
    eight = ", ".join(f"wh[i + {j}]" if j else "wh[i]" for j in range(k))
    d = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.col(doc_id).alias("doc_id"),
                    F.coalesce(F.col(text).cast("string"), F.lit("")).alias("tx"))
    d = d.withColumn("w", F.expr(f"regexp_extract_all(tx, '{WORD}', 0)")) \
        .withColumn("lines", F.expr(f"filter(split(tx, '\\n', -1), l -> l rlike '{WORD}')"))
    d = d.withColumn("wh", F.expr("transform(w, x -> xxhash64(x))")) \
        .select("row", "doc_id", "tx", "wh", F.expr("bigint(size(w))").alias("n_words"),
                F.expr("bigint(length(array_join(w, '')))").alias("word_chars"),
                F.expr(f"bigint(regexp_count(tx, '{SYMBOL}'))").alias("n_symbols"),
                F.expr("bigint(size(lines))").alias("n_lines"),
                F.expr("bigint(size(lines) - size(array_distinct(lines)))").alias("n_dup_lines"))
    d = d.withColumn("g", F.expr(
        f"if(size(wh) < {k}, array(), transform(sequence(0, size(wh) - {k}), i -> xxhash64({eight})))")).drop("wh")
    # repeated windows: neighbours with the same hash after sorting (hash, place); only where a hash repeats
    d = d.withColumn("s", F.expr(
        "if(size(array_distinct(g)) = size(g), null, sort_array(transform(g, (h, i) -> struct(h, i))))")).drop("g")
    d = d.withColumn("p", F.expr(
        "sort_array(transform(filter(s, (e, j) -> get(s, j - 1).h <=> e.h or get(s, j + 1).h <=> e.h), e -> e.i))")) \
        .drop("s")
    d = d.withColumn("n_repeat_words", F.expr(
        f"bigint(coalesce(aggregate(transform(p, (a, j) -> least({k}, coalesce(get(p, j + 1) - a, {k}))), 0, "
        "(t, x) -> t + x), 0))")).drop("p")
    # the counts leave through a generator, so that a filter on them is never moved down into the array expressions,
    # which would evaluate whole arrays once per element
    names = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
    return d.select("row", "doc_id", "tx", F.inline(F.array(F.struct(*names)))).withColumn("base_failed", F.expr(
        f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words"))


def cascade_order(docs: DataFrame, rules: dict[str, str] = RULES, sample_rows: int = SAMPLE_ROWS,
                  seed: int = 7) -> list[dict]:
    """Rules with their cost and selectivity on a random sample of about ``sample_rows`` rows, best first.

    rejection per cost = (share rejected) / (seconds); rules that reject
    nothing in the sample come last, cheapest first.  A rule's seconds are those of a job that
    applies it ``REPEATS`` times to each row, less those of the same job with an empty rule, each the
    better of two runs; so what a job costs by itself doesn't count.
    """
    total = docs.count()
    if not total:
        return [{"rule": r, "seconds": 0.0, "rejects": 0.0} for r in rules]
    sample = with_base(docs.sample(False, min(1.0, sample_rows / total), seed).limit(2 * sample_rows)).persist()
    try:
        shares = sample.agg(F.count(F.lit(1)).alias("_n"),
                            *[F.count_if(F.expr(c)).alias(r) for r, c in rules.items()]).first()
        n = max(1, shares["_n"])
        again = sample.withColumn("_again", F.explode(F.sequence(F.lit(1), F.lit(REPEATS))))

        def seconds(condition):
            job, times = again.agg(F.count_if(F.expr(condition))), []
            for _ in range(2):
                began = time.perf_counter()
                job.first()
                times.append(time.perf_counter() - began)
            return min(times)

        seconds("_again < 0")
        empty = seconds("_again < 0")
        found = [{"rule": rule, "seconds": max(seconds(condition) - empty, 1e-3), "rejects": shares[rule] / n}
                 for rule, condition in rules.items()]
    finally:
        sample.unpersist()
    return sorted(found, key=lambda x: (-x["rejects"] / x["seconds"], x["seconds"]))


def judge(docs: DataFrame, rules: dict[str, str] = RULES, sample_rows: int = SAMPLE_ROWS, doc_id: str = "doc_id",
          text: str = "text") -> DataFrame:
    """One row per document: doc_id, base counts, base_failed, kept, ``tx`` (the text) and ``row`` (the input row)."""
    order = [x["rule"] for x in cascade_order(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")),
                                              rules, sample_rows)]
    branches = " ".join(f"when {rules[r]} then false" for r in order)
    return with_base(docs, doc_id, text).withColumn("kept", F.expr(f"case when base_failed then false {branches} else true end"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () k, doc_id, coalesce(text, '') tx,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w FROM documents),
l AS (SELECT k, unnest(string_split(tx, chr(10))) line FROM d),
lc AS (SELECT k, count(*) n_lines, count(*) - count(DISTINCT line) n_dup
       FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY k),
i AS (SELECT k, w, unnest(range(1, len(w) - 6)) i FROM d WHERE len(w) >= 8),
g AS (SELECT k, i, w[i:i+7] g FROM i),
r AS (SELECT k, i, lead(i) OVER (PARTITION BY k ORDER BY i) nx
      FROM (SELECT k, i, count(*) OVER (PARTITION BY k, g) c FROM g) WHERE c > 1),
rc AS (SELECT k, sum(least(8, coalesce(nx - i, 8))) n FROM r GROUP BY k),
b AS (SELECT d.doc_id, d.tx, CAST(len(w) AS BIGINT) n_words,
             CAST(length(list_aggregate(list_append(w, ''), 'string_agg', '')) AS BIGINT) word_chars,
             CAST(length(tx) - length(regexp_replace(tx, '[#*$%&|<>]', '', 'g')) AS BIGINT) n_symbols,
             CAST(coalesce(lc.n_dup, 0) AS BIGINT) n_dup_lines, coalesce(lc.n_lines, 0) n_lines,
             CAST(coalesce(rc.n, 0) AS BIGINT) n_repeat_words
      FROM d LEFT JOIN lc USING (k) LEFT JOIN rc USING (k)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 20 * n_words
    OR 10 * n_dup_lines > 3 * n_lines
    OR 10 * len(regexp_extract_all(tx, '(?m)^[ \t]*[-*•]')) > 9 * n_lines
    OR 10 * len(regexp_extract_all(tx, '(?m)(\.\.\.|…)[ \t]*$')) > 3 * n_lines
    OR 2 * length(regexp_replace(tx, '[^\p{L}]+', '', 'g')) < word_chars
    OR 2 * length(regexp_replace(tx, '[^\p{Lu}]+', '', 'g')) > word_chars
    OR 10 * length(regexp_replace(tx, '[^0-9]+', '', 'g')) > 3 * word_chars
    OR tx ILIKE '%lorem ipsum%'
    OR 20 * len(regexp_extract_all(tx, '[{}]')) > n_words) AS kept
FROM f
"""
