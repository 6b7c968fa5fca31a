"""The training-data operators against brute force on small fixtures: nulls, empty texts, ties, repeats, clashing names."""

import random
import sys
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from weftgraph.llm import chat, chunks, counts, hyperminhash, itq, licenses, mixing, packing, quality, rangecoder, tokenfile, urls

DOCS = "doc_id long, text string, lang string, source string, n_chars long, rank long, slot long"


def words(rng, n):
    return " ".join(rng.choice(["the", "of", "and", "tion", "éau", "über", "x1", "MIT", "license,"]) + str(rng.randint(0, 60))
                    for _ in range(n))


def texts():
    rng = random.Random(4)
    base = words(rng, 120)
    near = base.split()
    near[5] = "changed"
    return [None, "", "   \n\t", base, base, " ".join(near), words(rng, 3), words(rng, 30) + "\n" + words(rng, 30),
            "a b c d e f g h " * 12, "line one\nline one\nother", "x <|endoftext|>  y\x00z ", words(rng, 9000),
            "Licensed under the Apache License, Version 2.0. MIT license mit License", "GNU General Public License v3",
            "&&& ### $$$ " * 20, words(rng, 40).upper()]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", None if i % 7 == 3 else f"s{i % 3}", 1, 5, 6) for i, t in enumerate(texts())]
    return spark.createDataFrame(rows + [rows[6], (None, "no id here at all", "en", "s1", 0, 1, 1)], DOCS)


def duck(sql, **tables):
    con = duckdb.connect()
    for name, frame in tables.items():
        con.register(name, frame)
    return con.execute(sql).fetchdf()


def same(a, b):
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)

    def key(d):
        rows = d[cols].astype(object).where(d[cols].notna(), None).values.tolist()
        return sorted(str([int(v) if isinstance(v, float) and v.is_integer() else v for v in r]) for r in rows)
    assert key(a) == key(b)


def test_chat(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "bot", "yo"), (2, 0, "user", "hi"), (3, 0, "user", "hi"), (3, 1, "bot", "yo"),
            (4, None, None, None), (4, 0, "user", "a"), (4, 0, "user", "b"), (4, 0, "user", "b"), (None, 0, "user", "x"),
            (5, 7, "user", "<|im_end|>")] + [(6, i, "user", f"t{i}") for i in range(150)] + \
           [(7, i, "user", f"t{i}") for i in range(149)]
    t = spark.createDataFrame([(*r, 0) for r in rows], "conv_id long, turn long, role string, text string, pos long")
    got = chat.collapse(t).toPandas()
    assert set(got.conv_id) == {1, 4, 5, 6} and got[got.conv_id == 6].part.tolist().__len__() == 3
    assert got[got.conv_id == 1].n_copies.tolist() == [2]
    same(got, duck(chat.ORACLE, conversations=t.toPandas().astype({"conv_id": "Int64", "turn": "Int64"})))
    assert chat.collapse(t.limit(0)).count() == 0


def test_packing(spark, docs):
    path = chunks.tokenizer_path(packing.TOKENIZER)
    got = packing.pack(packing.pieces(docs, path).persist()).toPandas()
    tk = Tokenizer.from_file(path)
    want = Counter()
    for d, t in docs.select("doc_id", "text").collect():
        ids = np.array(tk.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        at, k = 0, 0
        while at < len(ids):
            n = (len(ids) - 1) % 2048 + 1 if k == 0 else 2048
            want[(d, k, at, n, zlib.crc32(ids[at:at + n].tobytes()))] += 1
            at, k = at + n, k + 1
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert Counter((None if pd.isna(r[0]) else int(r[0]), *map(int, r[1:])) for r in got[cols].values.tolist()) == want
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert g.offset.tolist() == (g.length.cumsum() - g.length).tolist() and g.length.sum() <= 2048
    assert packing.pack(packing.pieces(docs.limit(0), path)).count() == 0


def test_packing_plan():
    rng = random.Random(1)
    for _ in range(20):
        counts_ = {rng.randint(1, 64): rng.randint(1, 500) for _ in range(rng.randint(1, 30))}
        fill, seen = Counter(), Counter()
        for length, r0, r1, first, many, off in packing.plan_runs(counts_, 64):
            seen[length] += r1 - r0
            for k in range(r1 - r0):
                assert off + k // many * length + length <= 64
                fill[first + k % many] += length
        assert seen == counts_ and max(fill.values()) <= 64


def test_quality(spark, docs):
    got = quality.judge(docs, sample_rows=50)
    same(got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
         .toPandas(), duck(quality.ORACLE, documents=docs.toPandas().astype({"doc_id": "Int64"})))
    assert got.where("kept").select("row.*").columns == docs.columns
    assert quality.judge(docs.limit(0)).count() == 0


def test_quality_rules_are_ordered_by_their_own_cost(spark):
    t = spark.createDataFrame([(i, f"word{i} and more text " * (10 + 40 * (i % 2))) for i in range(400)], "doc_id long, text string")
    rules = {"slow": "n_words < 100 and length(regexp_replace(regexp_replace(tx, '[a-m]+', ''), '(.)(.)', '$2$1')) >= 0",
             "never": "n_words < 0", "fast": "n_words < 100"}
    for _ in range(3):
        found = quality.cascade_order(t, rules, sample_rows=400)
        assert [x["rule"] for x in found] == ["fast", "slow", "never"]
        assert found[0]["rejects"] == found[1]["rejects"] == 0.5


@pytest.mark.parametrize("n", [0, 1, 1023, 1024, 1025, 30_000])
def test_range_coder(n):
    ids = (np.random.default_rng(n).zipf(1.3, n) % 65_536).astype("<u4")
    payload = b"".join(rangecoder.encode_blocks(ids))
    assert np.array_equal(rangecoder.decode_blocks(payload), ids)
    if n:
        broken = bytearray(payload)
        broken[-1] ^= 1
        broken[rangecoder.HEAD.size - 1] ^= 1
        with pytest.raises(ValueError):
            rangecoder.decode_blocks(bytes(broken))


def test_range_coder_takes_any_ids():
    rng = np.random.default_rng(5)
    ids = np.concatenate([rng.integers(0, 1 << 32, 3000), np.repeat([0, (1 << 32) - 1, 70_000], 2000)]).astype("<u4")
    rng.shuffle(ids)
    assert np.array_equal(rangecoder.decode_blocks(b"".join(rangecoder.encode_blocks(ids, 700))), ids)


@pytest.mark.parametrize("factor, crc", [(1, 3672731760), (70_001, 1383295566)])
def test_range_coder_keeps_its_format(factor, crc):
    """Blocks are the bytes that the coder of WTK2 wrote from the start; ids below and above the direct table of ranks."""
    i = np.arange(20_000)
    ids = np.where(i % 7 < 3, i % 50, i * i * 31 % 60_007 % (1 + i % 997)).astype("<u4") * np.uint32(factor)
    payload = b"".join(rangecoder.encode_blocks(ids))
    blocks = payload[rangecoder.Table.unpack(payload)[1]:]
    assert (len(blocks), zlib.crc32(blocks)) == (19_150, crc)
    assert np.array_equal(rangecoder.decode_blocks(payload), ids)


def test_range_coder_beats_order_zero_and_zlib():
    import duckdb
    texts = duckdb.sql("SELECT text FROM '/root/testdata/sf0.01/documents.parquet' ORDER BY doc_id").fetchall()
    enc = chunks.encoder(chunks.tokenizer_path(tokenfile.TOKENIZER))
    ids = np.frombuffer(b"".join(enc.encode(t or "") + b"\1\0\0\0" for t, in texts), "<u4")
    coded = b"".join(rangecoder.encode_blocks(ids))
    p = np.unique(ids, return_counts=True)[1] / len(ids)
    assert 8 * len(coded) < -(p * np.log2(p)).sum() * len(ids)
    assert len(coded) < 0.9 * len(zlib.compress(ids.astype("<u2").tobytes(), 6))
    assert np.array_equal(rangecoder.decode_blocks(coded), ids)


def test_range_coder_takes_few_steps():
    """Most of the coder's work is done for many steps of all blocks at a time; it was 68 calls a step, now 18."""
    ids = (np.random.default_rng(3).zipf(1.3, 3 * rangecoder.BLOCK) % 65_536).astype("<u4")
    calls = Counter()
    sys.setprofile(lambda frame, event, arg: calls.update([event]))
    try:
        rangecoder.encode_blocks(ids)
    finally:
        sys.setprofile(None)
    assert calls["call"] + calls["c_call"] < 40 * rangecoder.BLOCK


@pytest.mark.parametrize("distinct", [1, 2, 40_000, 70_000, 300_000])
def test_range_coder_finds_ids_of_all_classes(distinct):
    ids = np.random.default_rng(distinct).permutation(np.arange(300_000) % distinct).astype("<u4")
    assert np.array_equal(rangecoder.decode_blocks(b"".join(rangecoder.encode_blocks(ids))), ids)


ODD_RUNS = ["\ta\x1cb\x0bc \x1d", "x <|endoftext|>  y\x00z<|startoftext|>q", "don't  it's 's 12ab,b. é e\u0301 \u0301x a\xa0b\u2003c\x85d",
            "A,B.C  (x) --- ...", "\n", "İstanbul ŁÓDŹ ǅ １２ ﬁ x\u200by", "word word, word. (word) Word wörd WÖRD"]


@pytest.mark.parametrize("limit, marked", [(100_000, True), (100_000, False), (6, False)])
def test_token_ids_of_a_column(limit, marked, monkeypatch):
    path = chunks.tokenizer_path(tokenfile.TOKENIZER)
    enc = chunks.ChunkEncoder(path, cache_entries=limit)
    tk = Tokenizer.from_file(path)
    column = [t for t in texts() + ODD_RUNS * 3 if marked or t is None or "<|" not in t]
    asked = Counter()
    one = enc.one
    monkeypatch.setattr(enc, "one", lambda chunk: asked.update([chunk]) or one(chunk))
    for part in (column, column, [], [None], [column[-1]]):
        ids, lengths = enc.encode_column(pa.array(part, pa.string()), 1)
        want = [tk.encode(t or "", add_special_tokens=False).ids + [1] for t in part]
        assert ids.tolist() == [i for w in want for i in w]
        assert lengths.tolist() == [len(w) for w in want]
    if limit > 6:
        assert max(asked.values()) == 1  # a word goes to the library once


def test_token_file_of_documents_over_segments(spark, scratch, monkeypatch):
    monkeypatch.setattr(tokenfile, "LANES", 1)
    monkeypatch.setattr(tokenfile, "BLOCK", 64)
    rng = random.Random(8)
    column = [words(rng, n) for n in (500, 0, 3, 12, 12, 400, 1, 30)] + [None, ""]
    docs = spark.createDataFrame(list(enumerate(column)), "doc_id long, text string")
    path = chunks.tokenizer_path(tokenfile.TOKENIZER)
    tokenfile.write_tokens(docs, f"{scratch}/over", path, parts=2)
    assert spark.read.parquet(f"{scratch}/over").agg(F.max("n_ids")).first()[0] == 64
    got = tokenfile.read_tokens(spark, f"{scratch}/over", with_ids=True).toPandas().sort_values("doc_id")
    tk = Tokenizer.from_file(path)
    want = [tk.encode(t or "", add_special_tokens=False).ids + [1] for t in column]
    assert [np.frombuffer(b, "<u4").tolist() for b in got.ids] == want
    assert got.start.tolist() == np.cumsum([0, *map(len, want)])[:-1].tolist()


def test_token_file(spark, docs, scratch):
    path = chunks.tokenizer_path(tokenfile.TOKENIZER)
    tokenfile.write_tokens(docs, f"{scratch}/t", path, parts=3)
    got = tokenfile.read_tokens(spark, f"{scratch}/t", with_ids=True).toPandas().sort_values("start")
    assert got.start.tolist() == (got.n_tokens.cumsum() - got.n_tokens).tolist()
    assert got.doc_id.tolist()[1:] == sorted(got.doc_id.tolist()[1:])  # the null id comes first
    tk = Tokenizer.from_file(path)
    want = Counter(np.array(tk.encode(t or "", add_special_tokens=False).ids + [1], "<u4").tobytes()
                   for t, in docs.select("text").collect())
    assert Counter(got.ids) == want and all(zlib.crc32(i) == c for i, c in zip(got.ids, got.ids_crc32))


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_chunks_are_exact(name):
    path = chunks.tokenizer_path(name)
    enc, tk, rng = chunks.ChunkEncoder(path, cache_entries=500), Tokenizer.from_file(path), random.Random(2)
    parts = ["a", "B", "é", " ", "  ", "\n", "\t", "'s", "'", "<|endoftext|>", "12", "!", "...", "(", "\u00a0", "ß", "Σ", "İ", "漢",
             "e\u0301", "\x00", "\x1c", "😀", "\u2003", "_", "ÿ", "ı", "'LL", "\r\n"]
    for _ in range(1500):
        s = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        assert np.frombuffer(enc.encode(s), "<u4").tolist() == tk.encode(s, add_special_tokens=False).ids


def test_counts(spark, docs):
    path = chunks.tokenizer_path(counts.TOKENIZER)
    tk = Tokenizer.from_file(path)
    got = counts.count_tokens(docs, path).toPandas()
    want = Counter((d if d is not None else -1, len((t or "").encode()), len(tk.encode(t or "", add_special_tokens=False).ids))
                   for d, t in docs.select("doc_id", "text").collect())
    assert Counter(zip(got.doc_id.fillna(-1).astype(int), got.n_bytes, got.n_tokens)) == want
    assert (got.over_limit == (got.n_tokens > 512)).all()
    assert counts.count_tokens(docs, chunks.tokenizer_path("piece_bpe_32k.model")).where("n_tokens > 0").count() > 5
    assert counts.count_tokens(docs.limit(0), path).count() == 0


def test_mixing_schedule(spark):
    from fractions import Fraction
    weights = {"a": 5, "b": Fraction(33, 10), "c": Fraction(1, 100), "d": 1, "e": Fraction(1, 3)}
    names, total = list(weights), sum(weights.values())
    done, want = Counter(), []
    for slot in range(3000):  # the released block with the earliest deadline, by trying all sources
        ready = [(-(-(done[s] + 1) * total // w), s) for s, w in weights.items() if done[s] * total // w <= slot]
        s = min(ready)[1]
        want.append((s, done[s], slot))
        done[s] += 1
    whole = mixing.whole_weights(list(weights.values()))
    starts, end, _ = mixing.ranges(whole, names, [done[s] for s in names], 100)
    assert len(starts) > 20 and end <= 3000 + 1000
    table = mixing.schedule(spark, whole, names, starts, end).toPandas().sort_values("slot")
    assert list(zip(table._s, table._n, table.slot))[:3000] == want


def test_mixing_keeps_columns_of_any_name(spark, monkeypatch):
    names = ["_s", "_row", "_key", "_place", "_n", "_rank", "_b", "_bucket", "_before", "_done", "_o0", "place", "slot", "a.b"]
    t = spark.createDataFrame([(i, f"t{i}", f"s{i % 2}", *[i] * len(names)) for i in range(50)],
                              "doc_id long, text string, source string, " + ", ".join(f"`{n}` long" for n in names))
    monkeypatch.setattr(mixing, "MAX_SLOTS", 5)  # blocks grow
    got = mixing.mix(t).toPandas()
    assert list(got.columns) == ["doc_id", "text", "source", *names[:-3], "a.b", "block", "epoch", "slot", "place"]
    assert all((got[n] == got.doc_id).all() for n in [*names[:-3], "a.b"]) and got.block.max() == 2
    assert set(got[got.epoch == 0].doc_id) == set(range(50))


def test_mixing(spark, docs):
    got = mixing.mix(docs, {"s0": 4, "s1": 1, "s2": 1, None: 2}, block_docs=2, period=8).toPandas()
    assert Counter(got[got.epoch == 0].text.fillna("~")) == Counter(t if t is not None else "~" for t, in docs.select("text").collect())
    assert sorted(got.slot.unique()) == list(range(got.slot.max() + 1))
    assert (got.fillna({"source": "~"}).groupby("slot").source.nunique() == 1).all() and "rank" in got.columns
    assert mixing.mix(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(docs, {"s0": 1})


def test_mixing_keeps_to_the_target_weights(spark):
    weights = {"a": 524.37, "b": 499.6, "c": 0.005, "d": 0.1}
    names, total = list(weights), sum(weights.values())
    whole = mixing.whole_weights(list(weights.values()))
    starts, end, done = mixing.ranges(whole, names, [12_000, 9_000, 1, 1], 1000)
    assert len(starts) > 20 and done[0] >= 12_000 and done[2] == 1
    table = mixing.schedule(spark, whole, names, starts[:30], starts[30][0]).toPandas().sort_values("slot")
    assert table.slot.tolist() == list(range(starts[30][0]))
    for s, w in weights.items():
        mine = (table._s == s).to_numpy().cumsum()
        assert np.abs(mine - (table.slot.to_numpy() + 1) * w / total).max() < 1
        assert table._n[table._s == s].tolist() == list(range(mine[-1]))
    # a source of one document is no more frequent than its weight
    docs = spark.createDataFrame([(i, "big") for i in range(40_000)] + [(-1, "one")], "doc_id long, source string")
    got = mixing.mix(docs, {"big": 4000.0, "one": 0.5}, order=["doc_id"]).toPandas()
    assert (got.source == "one").sum() == 1 and set(got.doc_id) == set(range(-1, 40_000))
    with pytest.raises(ValueError):
        mixing.mix(docs, {"big": 1, "one": 0})


def test_licence_names_get_their_labels(spark):
    named = {"GPL-2.0-only": "gpl-2", "released under GPLv3 terms": "gpl-3", "Licensed under the LGPL": "lgpl", "MPL-2.0": "mpl-2.0",
             "AGPL-3.0": "agpl-3", "EPL-2.0": "epl-2.0", "CDDL-1.0": "cddl-1.0", "GNU GPL version 3 or later": "gpl-3",
             "License: MIT": "mit", "LGPL 2.1 or any later version": "lgpl-2.1", "SPDX-License-Identifier: Apache-2.0": "apache-2.0",
             "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted": "isc",
             "GNU General Public License, either version 3": "gpl-3", "BSD-3-Clause": "bsd-3", "the new BSD license": "bsd-3",
             "http://www.apache.org/licenses/LICENSE-2.0": "apache-2.0", "CC0-1.0": "cc0", "plain words of no licence": ""}
    t = spark.createDataFrame(list(named), "string").toDF("text").withColumn("doc_id", F.monotonically_increasing_id())
    rows = licenses.scan(t).join(t, "doc_id").collect()
    assert {r.text: named[r.text] in r.labels.split(",") for r in rows} == dict.fromkeys(named, True)
    gpl = next(r for r in rows if r.text.startswith("GNU GPL"))
    assert gpl.labels == "gpl-3" and [tuple(d) for d in gpl.detections] == [("gpl-3", 4, 0, 6)]


def test_many_licence_detections_in_one_text(spark):
    import time
    t = spark.createDataFrame([(1, "Copyright 2020 X.\n" * 100_000)], "doc_id int, text string")
    start = time.time()
    r = licenses.scan(t).collect()[0]
    assert time.time() - start < 120 and len(r.detections) == 100_000 and tuple(r.detections[-1]) == ("copyright", 1, 299_997, 2)


def test_urls(spark):
    rows = [(1, "http://a.org/x", '<a href="http://B.net/q">'), (2, "http://b.net/", '<a href=//c.net/ > <a href="https://bad.com/z">'),
            (3, "http://bad.com/de/1", ""), (4, "http://farm.net/x", "<a href='http://bad.com/'>"), (5, None, None),
            (6, "nourl", ""), (7, "http://c.net/?x", None), (8, "x://EXAMPLE.org/es/a#b", ""), (9, "http://www.example.org/en/12", ""),
            (9, "http://www.example.org/en/12", ""), (10, "://com/fr/", "")]
    t = spark.createDataFrame([(*r, "h") for r in rows], "page_id long, url string, html string, host string")
    got = urls.judge(t).toPandas()
    same(got, duck(urls.ORACLE, pages=t.toPandas()))
    assert got.set_index("page_id").verdict[4] == "block" and got.set_index("page_id").verdict[7] == "allow"
    assert urls.judge(t.limit(0)).count() == 0


def test_urls_far_from_a_seed(spark):
    far = 14
    rows = [(i, f"http://h{i}.net/", f"<a href='http://h{i + 1}.net/'>") for i in range(far)]
    rows += [(far, f"http://h{far}.net/", "<a href='http://bad.com/'>"), (far + 1, "http://bad.com/de/1", "")]
    # a ring, a trusted and a blocked host: the scores have walks of any length
    ring = {"a": ["b"], "b": ["c", "good"], "c": ["a", "worse"], "good": ["a", "c"], "worse": []}
    for i, (h, to) in enumerate(ring.items()):
        path = {"good": "fr/", "worse": "de/"}.get(h, "")
        rows.append((100 + i, f"http://{h}.com/{path}", " ".join(f"<a href='http://{o}.com/'>" for o in to)))
    t = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = urls.judge(t).toPandas().set_index("page_id").verdict
    assert all(got[i] == "block" for i in range(far + 2))
    names = list(ring)
    links = np.array([[float(b in ring[a]) for b in names] for a in names])
    pairs = [(a, b, 1) for a in names for b in ring[a]]
    scores = urls.propagate(spark.createDataFrame([("trust", "good", 1.0), ("distrust", "worse", 1.0)], "kind string, host string, score double"),
                            spark.createDataFrame(pairs, "src string, dst string, n long")).toPandas()
    for kind, flow, seed in (("trust", links, "good"), ("distrust", links.T, "worse")):
        share = flow / np.maximum(flow.sum(axis=1, keepdims=True), 1)
        want = np.linalg.solve(np.eye(5) - 0.85 * share.T, 0.15 * (np.array(names) == seed))
        have = scores[scores.kind == kind].set_index("host").score.reindex(names).fillna(0)
        assert np.abs(have.to_numpy() - want).sum() < 1e-9


def test_licenses(spark, docs):
    import re
    rules = licenses.signature_rules()
    assert len(rules) > 200
    lower = str.maketrans(dict(zip("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))

    def brute(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(lower))
        s = " " + " ".join(w) + " "
        starts, base = [], set()
        for phrase, label in licenses.PHRASES:
            k = phrase.split()
            hits = [i for i in range(len(w)) if w[i:i + len(k)] == k]
            starts += hits
            base |= {label} if hits else set()
        found = {(m.start(), m.end(), p, la) for kw, la, p, pt in rules if kw in s for m in re.finditer(pt, s)}
        held = {d for d in found if not any(
            e != d and e[0] <= d[0] and e[1] >= d[1] and e[2] >= d[2]
            and ((e[0], e[1]) != (d[0], d[1]) or e[2] > d[2] or e[3] < d[3]) for e in found)}
        return (len(w), len(starts), min(starts, default=-1), max(starts, default=-1), ",".join(sorted(base)),
                ",".join(sorted(base | {d[3] for d in held})))

    got = licenses.scan(docs).drop("detections").toPandas().fillna({"doc_id": -1, "first_word": -1, "last_word": -1})
    want = Counter((d if d is not None else -1, *brute(t)) for d, t in docs.select("doc_id", "text").collect())
    assert Counter((int(r.doc_id), r.n_words, r.n_base, int(r.first_word), int(r.last_word), r.base_labels, r.labels)
                   for r in got.itertuples()) == want
    assert got.score.between(0, 1).all() and licenses.scan(docs.limit(0)).count() == 0


def test_license_prefilter_loses_nothing(spark):
    import re

    from weftgraph.llm.licenses import signature_rules
    rules = signature_rules()
    texts = ["Distributed under BSD 3-Clause.", "This file is under Apache 2.0.", "Mozilla Public v2.0 applies",
             "dedicated to the public\ndomain", "All rights\nreserved.", "CC BY 4.0", "(CC-BY-SA/3.0)", "Expat License", "x11\tlicence",
             "GNU Library General\n Public License v2", "mit", "limit license", "accept by", "SPDX-License-Identifier: ISC", "bsd"]
    for _, _, _, pattern in rules:  # a text for every rule, by each choice of its first groups
        for last in (False, True):
            one = pattern[len("(?<= )(?:"):-len(")(?= )")]
            while m := re.search(r"\((?:\?:)?([^()]*)\)(\??)", one):
                one = one[:m.start()] + ("" if last and m[2] else m[1].split("|")[-1 if last else 0]) + one[m.end():]
            one = re.sub(r"\[cs\]", "c" if last else "s", one).replace("[0-9]{4}", "1999").replace("[^ ]+", "Me")
            texts.append(re.sub(" +", ",\n", one.replace("[a-z]*", "" if last else "s").replace(" ?", "" if last else " ")).upper())
    s = [" " + " ".join(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.lower())) + " " for t in texts]
    hits = [{(la, p) for _, la, p, pt in rules if re.search(pt, x)} for x in s]
    assert all(hits[15:]) and all(kw in x for x in s for kw, _, _, pt in rules if re.search(pt, x))
    got = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).toPandas().set_index("doc_id")
    for i, want in enumerate(hits):
        found = {(d.label, d.priority) for d in got.detections[i]} if got.detections[i] is not None else set()
        assert found <= want and max((p for _, p in found), default=0) == max((p for _, p in want), default=0), texts[i]
    assert [got.labels[i] for i in range(8)] == ["bsd-3", "apache-2.0", "mpl-2.0", "public-domain", "copyright", "cc-by-4.0",
                                                 "cc-by-sa-3.0", "mit"]


def components(n, links):
    up = {i: i for i in n}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {i: root(i) for i in n}


@pytest.mark.parametrize("held", [1 << 20, 40])
def test_components(spark, held, monkeypatch):
    from weftgraph.llm import components as module
    from weftgraph.llm.common import prepare_workers
    prepare_workers(spark)
    monkeypatch.setattr(module, "CONTRACT_EDGES", held)
    rng = random.Random(5)
    path = rng.sample(range(-200, 200), 300)
    edges = [*zip(path, path[1:]), *((1000 + rng.randrange(300), 1000 + rng.randrange(300)) for _ in range(200)),
             *((5000, 4000 + i) for i in range(400)), (7, 7), (9001, 9000), (9000, 9001)]
    frame = spark.createDataFrame(edges, "a long, b long")
    real = [e for e in edges if e[0] != e[1]]
    got = [tuple(r) for r in module.components(frame.repartition(5)).select("node", "component").collect()]
    assert sorted(got) == sorted(components({n for e in real for n in e}, real).items())
    assert module.components(frame.limit(0)).count() == 0


def test_vectors(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(60, 16))
    x = np.concatenate([base, base[:20] + 0.05 * rng.normal(size=(20, 16)), base[:5] * 3, base[:3]])
    rows = [(i, v.astype(float).tolist(), i % 2 if i < 60 else (i - 60) % 20 % 2) for i, v in enumerate(x)]
    odd = [(200, None, 0), (201, [], 0), (202, [0.0] * 16, 0), (203, [float("nan")] * 16, 0), (204, [None] * 16, 0),
           (205, rows[0][1], None), (206, [1.0, 2.0], 0), (207, [1.0, 2.0], 0)]
    t = spark.createDataFrame([(*r, 1) for r in rows + odd], "vec_id long, embedding array<double>, label int, id int")
    got = itq.near_vectors(t).toPandas().set_index("vec_id")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = [(i, j) for i in range(len(x)) for j in range(i) if rows[i][2] == rows[j][2] and unit[i] @ unit[j] >= 0.93]
    degree, comp = Counter(i for pair in near for i in pair), components(range(len(x)), near)
    assert all(got.n_links[i] == degree[i] and got.component_id[i] == comp[i] for i in range(len(x)))
    assert got.n_links[[200, 201, 202, 203, 204, 205]].sum() == 0 and got.component_id[207] == 206
    assert (got.kept == (got.index == got.component_id)).all() and itq.near_vectors(t.limit(0)).count() == 0


def test_vectors_with_a_common_direction(spark):
    rng = np.random.default_rng(2)
    common = rng.normal(size=32)
    common *= np.sqrt(0.8) / np.linalg.norm(common)
    rest = rng.normal(size=(500, 32)) * np.sqrt(0.2 / 32)
    x = common + np.concatenate([rest, 0.7 * rest[:200] + np.sqrt(1 - 0.7 ** 2) * rng.normal(size=(200, 32)) * np.sqrt(0.2 / 32)])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = np.triu(unit @ unit.T >= 0.93, 1)
    t = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = itq.near_vectors(t).toPandas().set_index("vec_id").n_links
    degree = near.sum(axis=0) + near.sum(axis=1)
    assert (got.reindex(range(len(x))).to_numpy() <= degree).all() and got.sum() >= 0.95 * degree.sum() > 200


def test_vectors_whose_codes_tell_nothing(spark, monkeypatch):
    rng = np.random.default_rng(4)
    common = rng.normal(size=32)
    common *= np.sqrt(0.92) / np.linalg.norm(common)
    x = common + rng.normal(size=(400, 32)) * np.sqrt(0.08 / 32)
    x = np.concatenate([x, x[:5]])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = np.triu(unit @ unit.T >= 0.93, 1)
    assert itq.choose_words(unit, itq.fit_rotation(unit), 0.93) is None
    t = spark.createDataFrame([(i, v.tolist(), i % 3) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    label = np.arange(len(x)) % 3
    near &= label[:, None] == label[None, :]
    degree, comp = near.sum(axis=0) + near.sum(axis=1), components(range(len(x)), list(zip(*np.nonzero(near))))
    for chunk in (1024, 16):
        monkeypatch.setattr(itq, "EXACT_CHUNK", chunk)
        got = itq.near_vectors(t).toPandas().set_index("vec_id")
        assert all(got.n_links[i] == degree[i] and got.component_id[i] == comp[i] for i in range(len(x)))


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates(spark, docs, k):
    rng = random.Random(9)
    rows = [(100 + i, t, "", "", 0, 0, 0) for i, t in enumerate(texts())]
    for family in range(12):
        base = words(rng, rng.randint(4, 150)).split()
        for c in range(8):
            w = list(base)
            for _ in range(rng.randint(0, 1 + len(w) // 12)):
                w[rng.randrange(len(w))] = f"new{rng.randint(0, 9)}"
            rows.append((200 + family * 8 + c, " ".join(w), "", "", 0, 0, 0))
    t = spark.createDataFrame(rows, DOCS)
    sets = {}
    for d, text, *_ in rows:
        w = (text or "").encode().lower().split()
        sets[d] = {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()
    links = [(a, b) for a in sets for b in sets if b < a and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    comp = components(sets, links)
    got = hyperminhash.near_duplicates(t, k).toPandas()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got.itertuples()} == \
        {d: (len(s), comp[d], comp[d] == d) for d, s in sets.items()}
    assert hyperminhash.near_duplicates(docs.limit(0), k).count() == 0
    assert hyperminhash.near_duplicates(docs, k).count() == docs.count()


def test_pipeline_stages(spark, docs):
    import corpus_pipeline as pipeline
    assert pipeline.quality_rules(spark, docs, "").columns == docs.columns
    kept = pipeline.minhash_dedup(spark, docs, "").toPandas()
    assert list(kept.columns) == docs.columns and not kept.doc_id.dropna().duplicated().any()
    assert kept.doc_id.isin([3]).any() and not kept.doc_id.isin([4, 5]).any()


def test_pipeline_keeps_the_order_of_the_mix(spark, scratch):
    import corpus_pipeline as pipeline
    docs = spark.createDataFrame([(i, f"text {i}", "en", f"s{i % 7 % 3}", 1) for i in range(600)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    want = mixing.mix(docs, temper=pipeline.MIX_TEMPER).toPandas().sort_values(["slot", "place"]).doc_id.tolist()
    got = pipeline.mix_sources(spark, docs, "")
    assert got.columns == docs.columns and got.toPandas().doc_id.tolist() == want
