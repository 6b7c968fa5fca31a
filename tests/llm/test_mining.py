"""Exact duplicates, collocations and hard negatives against plain Python on small fixtures."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np

from weftgraph.llm import collocations, exactdedup, negatives, quotient

A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, fp string, t int, row int, n int, sha int, a int, score int, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "x", 1, 2, 3, 4, 5, 6, 7) for i, t, lang in rows], DOCS)


def test_filters_give_back_what_went_in():
    rng = np.random.default_rng(3)
    for bits in (1, 9, 40, 56, 64):
        parts, total = [], Counter()
        for n in (0, 1, 7, 500):
            values = rng.integers(0, 1 << min(bits, 12), n, dtype=np.uint64)  # many repeats
            if bits > 12:
                values = np.concatenate([values, rng.integers(0, (1 << bits) - 1, n, dtype=np.uint64)])
            total.update(values.tolist())
            values = np.sort(values)
            parts.append(quotient.build(*quotient.summed(values, np.ones(len(values), np.int64)), bits))
        merged = quotient.Filter(quotient.merge([quotient.merge(parts[:2], bits), *parts[2:]], bits))
        assert dict(zip(merged.values().tolist(), merged.counts.tolist())) == dict(total)
        assert all(merged.count(v) == n for v, n in list(total.items())[:50])
        assert all(merged.count(v) == total[v] for v in rng.integers(0, 1 << min(bits, 20), 50).tolist())


def test_filters_hold_large_counts():
    data = quotient.build(np.array([3, 9], np.uint64), np.array([1, 5_000_000_000]), 20)
    twice = quotient.Filter(quotient.merge([data, data], 20))
    assert twice.counts.tolist() == [2, 10_000_000_000] and twice.values().tolist() == [3, 9]


def plain_duplicates(rows):
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[(t or "").translate(A_Z)].append(i)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        kept = ids.index(keep)
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(ids), j == kept, sha) for j, i in enumerate(ids)]
    return sorted(map(str, out))


def test_exact_duplicates(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(0, None, None), (1, "", "en"), (2, "A b", "en"), (3, "a B", "en"), (3, "a B", "en"), (4, "ÀB", "en"), (5, "àb", "en"),
            (None, "a b", "en"), (None, "no id", "en"), (None, "no id", "en"), (6, "x " * 400_000, "en"), (9, "X " * 400_000, "en"),
            (-7, "a  b", None)]
    rows += [(100 + i, f"copy {rng.randint(0, 40)}", "en") for i in range(300)] + [(1000 + i, "hot", "en") for i in range(200)]
    want = plain_duplicates(rows)
    for shard, limit in ((1 << 21, 1 << 20), (16, 0)):  # many ranges, no broadcast
        monkeypatch.setattr(exactdedup, "SHARD_FINGERPRINTS", shard)
        monkeypatch.setattr(exactdedup, "MAX_BROADCAST_ROWS", limit)
        got = exactdedup.exact_duplicates(frame(spark, rows).repartition(5)).collect()
        assert sorted(str(tuple(r)) for r in got) == want
    assert exactdedup.exact_duplicates(frame(spark, rows).limit(0)).count() == 0


def plain_collocations(rows, min_count, top):
    out = []
    by_lang = defaultdict(list)
    for _, t, lang in rows:
        by_lang[lang or "und"].append((t or "").translate(A_Z))
    for lang, texts in by_lang.items():
        f = Counter()
        for t in texts:
            for piece in re.split("[.,;:!?\x0a-\x0d]", t):
                w = re.findall("[^\x20\x09]+", piece)
                f.update(tuple(w[i:i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
        n = sum(v for p, v in f.items() if len(p) == 1)
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        gone = {p[i:j] for p, b in cand.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                if j - i < len(p) and 100 * b >= 80 * cand[p[i:j]]}
        found = []
        for p, a in cand.items():
            if p not in gone:
                score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(sorted(found)[:top])]
    return sorted(out)


def test_collocations(spark, monkeypatch):
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(40)] + ["Éa", "éa", "A", "a", "x\x00y", "ñ b", "~"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    rows = [(0, None, "en"), (1, "", None), (2, " \t\n.,", "en"), (None, "of the of the of the of the", None), (3, "lone", "fr")]
    for i in range(400):
        words = rng.choices(vocabulary, weights, k=rng.randint(1, 30))
        if i % 3 == 0:
            words[:0] = ["new", "york", "city", "hall"][:rng.choice([2, 4, 4, 4])]
        text = "".join(w + rng.choice([" ", " ", " ", "\t", " \t ", ", ", ".", "\n", "\r\n"]) for w in words)
        rows.append((i, text, rng.choice(["en", "en", "en", "de", None, "und"])))
    rows += [(7, "same words here again and again", "de")] * 50
    for min_count, top in ((4, 2000), (4, 6), (30, 3)):
        monkeypatch.setattr(collocations, "MIN_COUNT", min_count)
        monkeypatch.setattr(collocations, "TOP", top)
        got = sorted(tuple(r) for r in collocations.mine(frame(spark, rows)).collect())
        assert got == plain_collocations(rows, min_count, top)
    assert collocations.mine(frame(spark, rows).limit(0)).count() == 0
    assert collocations.mine(frame(spark, rows[:3])).count() == 0


def test_words_of_long_texts_come_whole():
    text = ("Ab, c\td.  " * 700_000 + "last").encode()  # beyond one slice
    parts = list(collocations.word_slices(text))
    assert len(parts) > 1 and sum(parts, []) == [b"ab", b"\xff", b"c", b"d", b"\xff"] * 700_000 + [b"last"]
    assert sum(collocations.word_slices(b"x" * 9_000_000), []) == [b"x" * 9_000_000]


def plain_negatives(rows):
    best = {}
    for i, label, x, *_ in rows:
        if i is None or label is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        key = (label, [float(np.float32(v)) for v in x])
        if i not in best or key < best[i]:
            best[i] = key
    e = {i: ((label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * v) for v in x]) for i, (label, x) in best.items()}
    out = []
    for a, (la, qa) in e.items():
        if a % 100:
            continue
        s = {i: sum(x * y for x, y in zip(qa, q)) for i, (_, q) in e.items() if i != a}
        for p in sorted((i for i in s if e[i][0] == la), key=lambda i: (-s[i], i))[:5]:
            fits = [i for i in s if e[i][0] != la and 30 * s[p] <= 100 * s[i] <= 90 * s[p]]
            out += [(a, p, k + 1, i, s[p], s[i]) for k, i in enumerate(sorted(fits, key=lambda i: (-s[i], i))[:10])]
    return sorted(out)


def test_hard_negatives(spark, monkeypatch):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(6, 8))
    rows = [(i, int(rng.integers(0, 10)), (centres[rng.integers(0, 6)] + 0.3 * rng.normal(size=8)).round(2).tolist()) for i in range(1500)]
    rows += [(5000 + i, 3, rows[0][2]) for i in range(400)]  # a common vector
    rows += [(None, 1, [1.0] * 8), (7001, None, [1.0] * 8), (7002, 1, None), (7003, 1, [1.0, None] + [0.0] * 6), (7004, 1, [float("nan")] * 8),
             (7005, 1, [float("inf")] * 8), (7100, 2, [0.0] * 8), (7200, 2, [1.5, 2.0]), (7007, 2, []), (7300, 4, [3e4] * 8),
             (7301, 4, [2e4] * 8), (7302, 5, [1e4, 1.0] * 4), (40, 1, [9.0] * 8), (40, 0, [9.0] * 8), (-100, 4, [1.0] * 8), rows[5]]
    table = spark.createDataFrame([(i, label, x, 1, 2, 3.0) for i, label, x in rows],
                                  "vec_id long, label int, embedding array<float>, block int, rank int, norm double")
    want = plain_negatives(rows)
    assert len(want) > 500
    for block, anchors in ((16_384, 65_536), (16, 5)):  # many blocks, buckets of labels and slices
        monkeypatch.setattr(negatives, "BLOCK_ROWS", block)
        monkeypatch.setattr(negatives, "SLICE_ANCHORS", anchors)
        got = sorted(tuple(r) for r in negatives.hard_negatives(table.repartition(4)).collect())
        assert got == want
    assert negatives.hard_negatives(table.limit(0)).count() == 0
    assert negatives.hard_negatives(table.where("vec_id = 7007")).count() == 0


def test_score_bounds_hold_and_prune():
    rng = np.random.default_rng(9)
    centres = 100 * rng.normal(size=(5, 16))
    q = np.floor(np.concatenate([c + 8 * rng.normal(size=(60, 16)) for c in centres] + [np.zeros((1, 16)), 1e6 * centres]))
    refs = negatives.fit_references([r.tobytes() for r in q])
    norms = np.linalg.norm(q, axis=1)
    theta = negatives.angles_to(q, norms, refs)
    low, high = negatives.bounds(theta, norms, theta, theta, norms, norms)
    scores = q @ q.T
    assert (low <= scores).all() and (scores <= high).all()
    again = negatives.pair_bounds(theta, norms, theta, norms)
    assert np.allclose(low, again[0]) and np.allclose(high, again[1]) and (again[0] <= scores).all() and (scores <= again[1]).all()
    ours, theirs = slice(0, 60), slice(60, 300)
    assert (high[ours, theirs] < low[ours, ours].min()).mean() > 0.5  # other clusters are ruled out unscored
    lo, hi, least, most = theta[60:120].min(0)[None], theta[60:120].max(0)[None], norms[60:120].min()[None], norms[60:120].max()[None]
    block_low, block_high = negatives.bounds(theta, norms, lo, hi, least, most)
    assert (block_low[:, 0] <= scores[:, 60:120].min(1)).all() and (scores[:, 60:120].max(1) <= block_high[:, 0]).all()


def test_scores_beyond_exact_doubles():
    q = np.array([[2.0 ** 40, 1.0], [3.0, -1.0]])
    assert negatives.inner(q, np.array([2.0 ** 20, 1.0])).tolist() == [2 ** 60 + 1, 3 * 2 ** 20 - 1]
