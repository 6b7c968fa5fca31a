"""Operator 6: token counts by a map-side two-tier lookup.

Tier 1 is a compact table of frequent chunks (pre-tokens) and their lengths in
tokens, counted on a bounded random sample and broadcast: at most
``FREQUENT`` chunks of at most ``CHUNK_BYTES`` bytes, one string and one byte
array.  Chunks it lacks go to tier 2, the worker's own bounded cache, and only
there to the tokenizers library.  No pre-token is ever shuffled.  The sample only
decides what is fast; every count is that of the library on the whole text.

A null text counts as empty (0 bytes, 0 tokens).  Every input row gives one row;
a null ``doc_id`` is returned as it is.  Extra columns are ignored.
"""

from __future__ import annotations

import os
from collections import Counter
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chunks import LONG_TEXT, ONE_PRETOKEN, STEP, encoder, tokenizer_path
from .common import prepare_workers, read

TOKENIZER, LIMIT = "byte_bpe_50k.json", 512
SAMPLE_ROWS, SAMPLE_CHARS = 2000, 20_000
FREQUENT, CHUNK_BYTES = 65_536, 64
CACHE_ENTRIES = 600_000


def frequent_lengths(docs: DataFrame, tokenizer: str, sample_rows: int = SAMPLE_ROWS, seed: int = 11) -> tuple[str, bytes]:
    """The broadcast table: chunks joined by a zero character, and their lengths in tokens (one byte each).

    ``docs`` has a column text.  The sample has about ``sample_rows`` rows of at
    most ``SAMPLE_CHARS`` characters each.
    """
    total = docs.count()
    if not total:
        return "", b""
    rows = docs.sample(False, min(1.0, sample_rows / total), seed).limit(2 * sample_rows) \
        .select(F.substring("text", 1, SAMPLE_CHARS).alias("t")).collect()
    enc, seen = encoder(tokenizer), Counter()
    for r in rows:
        seen.update(enc.pattern.findall(r["t"] or ""))
    chunks = [c for c, _ in seen.most_common(FREQUENT)
              if "\0" not in c and len(c.encode()) <= CHUNK_BYTES and not any(m in c for m in enc.marks)]
    lengths = [len(e.ids) for e in enc.tokenizer.encode_batch(chunks, add_special_tokens=False)]
    return "\0".join(chunks), bytes(min(n, 255) for n in lengths)  # a chunk of 64 bytes has at most 64 tokens


class LengthLookup:
    def __init__(self, tokenizer: str, table: tuple[str, bytes]):
        self.enc = encoder(tokenizer)
        self.first = dict(zip(table[0].split("\0"), table[1])) if table[1] else {}
        self.second: dict[str, int] = {}

    def _learn(self, chunks: list[str]) -> None:
        missing = list({c for c in chunks if c not in self.second})  # chunks: those that tier 1 lacks
        if len(self.second) + len(missing) > CACHE_ENTRIES:
            self.second.clear()
            missing = list(set(chunks))
        self.second.update((c, len(self.enc.one(c))) for c in missing if ONE_PRETOKEN.fullmatch(c))
        missing = [c for c in missing if c not in self.second]
        for i in range(0, len(missing), 4096):
            part = missing[i:i + 4096]
            self.second.update(zip(part, (len(e.ids) for e in
                                          self.enc.tokenizer.encode_batch(part, add_special_tokens=False))))

    def _sum(self, chunks: list[str]) -> int:
        known = list(map(self.first.get, chunks))
        rest = [c for c, n in zip(chunks, known) if n is None]
        total = sum(filter(None, known))
        if rest:
            try:
                total += sum(map(self.second.__getitem__, rest))
            except KeyError:
                self._learn(rest)
                total += sum(map(self.second.__getitem__, rest))
        return total

    def _plain(self, text: str) -> int:
        if len(text) <= LONG_TEXT:
            return self._sum(self.enc.pattern.findall(text))
        runs, total = (m.group() for m in self.enc.pattern.finditer(text)), 0
        while part := list(islice(runs, STEP)):
            total += self._sum(part)
        return total

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if any(mark in text for mark in self.enc.marks):
            return sum(1 if p in self.enc.marks else self._plain(p) for p in self.enc.special.split(text) if p)
        return self._plain(text)


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = LIMIT, doc_id: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit.  ``tokenizer``: a .json file, or a sentencepiece .model."""
    spark = docs.sparkSession
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    whole = tokenizer.endswith(".model") or encoder(tokenizer).pattern is None  # no safe cuts: the library on whole texts
    table = spark.sparkContext.broadcast(("", b"") if whole else frequent_lengths(plain, tokenizer))

    def count(batches):
        if tokenizer.endswith(".model"):
            import sentencepiece
            model = sentencepiece.SentencePieceProcessor(model_file=tokenizer)
            of = lambda t: len(model.encode(t, num_threads=1)) if t else 0
        elif whole:
            enc = encoder(tokenizer)
            of = lambda t: len(enc.encode(t)) // enc.width
        else:
            of = lookup(tokenizer, table).count
        for batch in batches:
            texts = [t.as_py() for t in batch.column(1)]
            tokens = pa.array([of(t) for t in texts], pa.int64())
            sizes = pa.array([len(t.encode()) if t else 0 for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, tokens], ["doc_id", "n_bytes", "n_tokens"])

    prepare_workers(spark)
    kind = plain.schema["doc_id"].dataType.simpleString()
    return plain.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long") \
        .withColumn("over_limit", F.col("n_tokens") > limit)


_lookups: dict[tuple, LengthLookup] = {}


def lookup(tokenizer: str, table) -> LengthLookup:
    """The worker process's lookup of one broadcast table; tier 2 lives as long as the worker."""
    key = (tokenizer, table.id if hasattr(table, "id") else id(table), os.getpid())
    if key not in _lookups:
        _lookups.clear()
        _lookups[key] = LengthLookup(tokenizer, table.value)
    return _lookups[key]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read(spark, sf_dir, "documents"), tokenizer_path(TOKENIZER))
