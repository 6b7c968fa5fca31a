"""Near-duplicates where doc_ids repeat, and the whole pipeline against a chain in plain Python."""

import random
from collections import Counter, defaultdict

import duckdb
from tokenizers import Tokenizer

from .test_llm import components, words
from weftgraph.llm import hyperminhash, mixing, quality
from weftgraph.llm.chunks import tokenizer_path

TEXTS = "doc_id long, text string, lang string, source string, n_chars long"


def sets_of(texts, k):
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        out.append({tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    return out


def links_of(sets):
    return [(a, b) for a in range(len(sets)) for b in range(a) if sets[a] and sets[b]
            and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]


def shared_rows(rng):
    """Pairs of near copies whose first texts share doc_ids with unrelated texts."""
    rows = []
    for i in range(40):
        base = words(rng, 90)
        rows += [(1000 + i, base), (i, base + " more"), (i, words(rng, 60)), (i, base + " more")]
    return rows + [(3, ""), (3, None), (None, words(rng, 20)), (2000, words(rng, 50)), (2000, words(rng, 50))]


def test_links_of_shared_ids_are_all_found(spark):
    rows = shared_rows(random.Random(12))
    sets = sets_of([t for _, t in rows], 2)
    links = links_of(sets)
    t = spark.createDataFrame([(i, x, "en", "s", 1) for i, x in rows], TEXTS)
    # ids are nodes: a row belongs where any row of its doc_id does
    ids = {i for i, _ in rows if i is not None}
    comp = components(ids, [(rows[a][0], rows[b][0]) for a, b in links])
    got = hyperminhash.near_duplicates(t).collect()
    assert all(comp[1000 + i] == i for i in range(40))
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == Counter(
        (i, len(s), comp[i] if s and i is not None else i, i is None or not s or comp[i] == i) for (i, _), s in zip(rows, sets))


def test_texts_of_shared_ids_are_judged_alone(spark):
    import corpus_pipeline as pipeline
    rows = shared_rows(random.Random(13))
    t = spark.createDataFrame([(i, x, "en", "s", 1) for i, x in rows], TEXTS)
    got = Counter((r.doc_id, r.text) for r in pipeline.minhash_dedup(spark, t, "").collect())
    want = Counter((i, x) for i, x in rows if i is None or i < 1000 or i == 2000)
    assert got == Counter({k: n if not k[0] or not k[1] else 1 for k, n in want.items()} | {(0, rows[1][1]): 1, (0, rows[2][1]): 1})


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n))


def test_the_whole_pipeline(spark, scratch):
    import corpus_pipeline as pipeline
    rng = random.Random(14)
    rows = []
    for i in range(160):
        text = prose(rng, rng.choice([5, 40, 120, 300]))
        rows.append((i, text, "en", f"s{i % 5 % 3}", len(text)))
        if i % 4 == 0:
            rows.append((500 + i, text + " tail", "en", "s1", 1))
    rows += [(0, prose(rng, 80), "en", "s0", 1), (900, "of of of " * 40, "en", "s2", 1), (901, None, "en", None, 1),
             (902, prose(rng, 4000), "en", "s2", 1)]
    table = spark.createDataFrame(rows, TEXTS)
    table.write.parquet(f"{scratch}/documents.parquet")
    con = duckdb.connect()
    con.register("documents", table.toPandas().astype({"doc_id": "Int64"}))
    verdicts = defaultdict(list)
    for i, kept, n in con.execute(f"SELECT doc_id, kept, n_words FROM ({quality.ORACLE})").fetchall():
        verdicts[i, n].append(kept)
    good = [r for r in rows if all(verdicts[r[0], len((r[1] or "").split())])]
    sets = sets_of([r[1] for r in good], pipeline.SHINGLE_WORDS)
    links = links_of(sets)
    comp = components(range(len(good)), links)
    first = {}
    for j, r in enumerate(good):
        first[comp[j]] = min(first.get(comp[j], (r[0], j)), (r[0], j))
    single = [good[j] for j in sorted(j for _, j in first.values())]
    assert 100 < len(single) < len(good) < len(rows)
    mixed = mixing.mix(spark.createDataFrame(single, TEXTS), temper=pipeline.MIX_TEMPER).collect()
    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    lengths = {r[:2]: len(library.encode(r[1], add_special_tokens=False).ids) + 1 for r in single}
    want = Counter()
    for r in mixed:
        n = lengths[r.doc_id, r.text]
        want[r.doc_id, n] += 1
    got = pipeline.run(spark, scratch).collect()
    assert sum(r.length for r in got) == sum(n * c for (_, n), c in want.items())
    assert Counter(r.doc_id for r in got if r.piece == 0) == Counter(i for i, n in want.elements())
    taken = defaultdict(list)
    for r in got:
        taken[r.sequence_id].append((r.offset, r.length))
    assert all(sum(n for _, n in parts) <= 2048 and [o for o, _ in sorted(parts)] ==
               [sum(n for _, n in sorted(parts)[:i]) for i in range(len(parts))] for parts in taken.values())
    assert len(taken) <= -(-sum(r.length for r in got) // 2048) + 1
