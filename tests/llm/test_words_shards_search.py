"""Collocations, sharding and ranked search against plain Python: odd rows, ties, hot groups, long texts, empty tables."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlane.llm import collocations, ranked_search, sharding


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# --- Collocations -------------------------------------------------------------------------------------------------


def brute_collocations(rows, least, longest, top):
    n, f = Counter(), defaultdict(Counter)
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) >= 2 and a >= least}
        found = []
        for p, a in candidates.items():
            inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))  # noqa: E731, B023
            if any(len(q) > len(p) and 100 * b >= 100 * a and inside(q) for q, b in candidates.items()):
                continue
            score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def spoken(seed, sentences, words=12):
    r = random.Random(seed)
    stock = ["Das", "new", "york", "zoo", "é", "ß:", "a", "b\tc", "New York", "of the", "x.", "\x0b", "ab c"]
    return " ".join(" ".join(r.choice(stock) for _ in range(words)) + r.choice(".,;:!?\n\r\x0c ") for _ in range(sentences))


TALK = [("en", None), ("en", ""), (None, spoken(1, 200)), ("und", spoken(2, 90)), ("de", spoken(3, 300)), ("de", spoken(3, 300)), ("fr", "a b " * 3000), ("es", " \t\n.;"), ("it", "one two")]


@pytest.mark.parametrize("shard", [16 << 20, 700])
@pytest.mark.parametrize(("least", "longest", "top"), [(20, 5, 2000), (3, 5, 7), (2, 2, 50)])
def test_collocations(spark, monkeypatch, shard, least, longest, top):
    monkeypatch.setattr(collocations, "SHARD_BYTES", shard)
    docs = spark.createDataFrame([(lang, t, "clash", 1) for lang, t in TALK], "lang string, text string, phrase string, n int").repartition(3)
    got = collocations.collocations(docs, min_count=least, max_words=longest, top=top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute_collocations(TALK, least, longest, top)


def test_collocations_with_a_full_bitmap_are_the_same(spark, monkeypatch):
    """Where more is frequent than the bitmap holds, false hits cost rows and change no count."""
    monkeypatch.setattr(collocations, "MAX_BITS", 1 << 16)
    monkeypatch.setattr(collocations.Bitmap, "hits", lambda self, phrases: np.ones(len(phrases), bool))
    docs = spark.createDataFrame(TALK, "lang string, text string")
    got = collocations.collocations(docs, min_count=20)
    assert sorted(tuple(r) for r in got.collect()) == brute_collocations(TALK, 20, 5, 2000)


def test_collocations_of_no_rows_and_of_a_text_above_a_slice(spark):
    assert collocations.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0
    r = random.Random(7)
    long = [("en", " ".join(r.choice(["alpha", "beta", "gamma", "delta,", "omega"]) for _ in range(500_000)))]
    assert len(long[0][1]) > 2 << 20
    got = collocations.collocations(spark.createDataFrame(long, "lang string, text string"), min_count=9000)
    assert sorted(tuple(r) for r in got.collect()) == brute_collocations(long, 9000, 5, 2000)


def test_scores_beyond_64_bits(spark):
    a, n = 3 * 10**9, 9 * 10**13
    counts = spark.createDataFrame([("en", 0, "", n), ("en", 1, "x", a + 1), ("en", 1, "y", a + 7), ("en", 2, "x y", a)], "lang string, length int, phrase string, c long")
    assert collocations.scored(counts).first().score == 1000 * a * n // ((a + 1) * (a + 7))


def test_suffix_array_sorts_by_depth():
    r = np.random.default_rng(3)
    symbols = r.integers(0, 4, 400)
    order = collocations.suffix_array(symbols, 5)
    heads = [symbols[i : i + 5].tolist() for i in order]
    assert heads == sorted(heads) and sorted(order) == list(range(400))
    shared = collocations.common_prefixes(symbols, order, 5)
    for k in range(1, 400):
        a, b = heads[k - 1], heads[k]
        same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y or x == 0), min(len(a), len(b)))
        assert shared[k] == same


# --- Sharding -----------------------------------------------------------------------------------------------------


def check_shards(found, sources, shards):
    """found: (source, shard, slot) of each row."""
    n = len(found)
    sizes = Counter(s for _, s, _ in found)
    assert all(n // shards <= sizes[s] <= -(-n // shards) for s in range(shards))
    slots = defaultdict(set)
    for _, s, slot in found:
        slots[s].add(slot)
    assert all(x == set(range(sizes[s])) for s, x in slots.items())
    per = Counter((src, s) for src, s, _ in found)
    for src, total in sources.items():
        assert all(abs(per[src, s] - total * sizes[s] / n) <= 2 for s in range(shards))


@pytest.mark.parametrize("bucket", [2048, 16])
def test_shards_match_the_mixture_and_repeat_themselves(spark, monkeypatch, bucket):
    monkeypatch.setattr(sharding, "ROWS_PER_BUCKET", bucket)
    rows = [(i if i % 9 else None, f"text {i}", "hot" if i % 3 else [None, "", "b"][i % 9 // 3], "clash", 5) for i in range(1500)]
    rows += [(7, "same row", "hot", "clash", 5)] * 700 + [(8, None, "b", None, None), (9, "", "b", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, shard string, bucket int")
    out = sharding.interleaved(docs, shards=7)
    assert out.columns == ["doc_id", "text", "source", "bucket", "law", "shard", "slot", "grown_shard"]
    got = out.collect()
    check_shards([(r.source, r.shard, r.slot) for r in got], Counter(r[2] for r in rows), 7)
    assert Counter((r.doc_id, r.text, r.source) for r in got) == Counter(r[:3] for r in rows)
    again = sharding.interleaved(docs.repartition(5), shards=7).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    other = sharding.interleaved(docs, shards=7, seed=1).collect()
    assert sorted(map(repr, got)) != sorted(map(repr, other))


def test_many_small_sources_spread(spark):
    rows = [(i, "hot" if i % 2 else f"own{i}") for i in range(4000)]
    got = sharding.interleaved(spark.createDataFrame(rows, "doc_id long, source string"), shards=5).collect()
    hot = Counter(r.shard for r in got if r.source == "hot")
    assert all(abs(hot[s] - 400) < 100 for s in range(5)) and Counter(r.shard for r in got) == dict.fromkeys(range(5), 800)


def test_shards_digest_and_few_rows(spark):
    docs = spark.createDataFrame([(1, "é", "a"), (2, None, None), (2, None, None), (None, "", "a")], "doc_id long, text string, source string")
    got = sharding.digest(docs, shards=40).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter([(1, 18, zlib.crc32("é".encode())), (2, 16, 0), (2, 16, 0), (None, 16, 0)])
    assert all(r.law == "rows" and r.slot == 0 and r.grown_shard is None for r in got) and len({r.shard for r in got}) == 4
    assert sharding.digest(docs.limit(0)).count() == 0


def test_shards_have_no_python_in_their_plans(spark, tmp_path):
    docs = spark.createDataFrame([(i, "t" * i, "a" if i % 2 else "b", [i]) for i in range(300)], "doc_id long, text string, source string, more array<int>")
    assert "Python" not in sharding.digest(docs)._jdf.queryExecution().toString()
    sharding.write_shards(docs, str(tmp_path / "out"), shards=4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 300 and back.filter(F.size("more") == 1).count() == 300
    check_shards([(r.source, r.shard, r.slot) for r in back.collect()], {"a": 150, "b": 150}, 4)


# --- Ranked search ------------------------------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_search(docs, items, top=10):
    held = [(key, Counter(TERM.findall(lower(t)))) for key, t in docs]
    held = [(key, c, c.total()) for key, c in held if c]
    n_docs, n_terms = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        asked = Counter(TERM.findall(lower(text)))
        weight = {t: q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t, q in asked.items()}
        hits = []
        for key, c, n in held:
            m = 100 - 75 + 75 * n * n_docs // n_terms
            score = sum(w * (1000000000 * c[t] // (1000 * c[t] + 8 * m)) for t, w in weight.items() if t in c)
            if score > 0:
                hits.append((-score, key is not None, key))
        out += [(item, rank, key, -s) for rank, (s, _, key) in enumerate(sorted(hits, key=lambda h: (h[0], h[1], h[2] or 0))[:top], 1)]
    return sorted(out, key=repr)


def library(seed, n):
    r = random.Random(seed)
    stock = [f"w{int(r.paretovariate(0.7))}" for _ in range(3000)]
    return [(i, " ".join(r.choice(stock) for _ in range(r.randint(1, 80)))) for i in range(n)]


@pytest.mark.parametrize(("block_docs", "held"), [(256, 32 << 20), (3, 2000)])
def test_ranked_search(spark, monkeypatch, block_docs, held):
    monkeypatch.setattr(ranked_search, "BLOCK_DOCS", block_docs)
    monkeypatch.setattr(ranked_search, "HELD_BYTES", held)
    docs = library(1, 300) + [(500, None), (501, ""), (502, " -- "), (None, "W1 w2 rare"), (503, "w1 w2 rare"), (503, "w1 w2 rare"), (504, "w1, W2; RARE"), (505, "é ñ É 5 _x_")] + [(600 + i, "same same text") for i in range(40)]
    items = [(1, "rare w1 w1 é"), (None, None), (2, ""), (3, "Same"), (3, "unknown"), (4, docs[5][1]), (5, " ".join(t for _, t in docs[:9])), (4, "x 5")]
    frame = spark.createDataFrame([(i, t, "clash") for i, t in docs], "doc_id long, text string, score string").repartition(4)
    got = ranked_search.ranked_search(frame, spark.createDataFrame(items, "item_id long, text string"))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_search(docs, items)


def test_items_in_several_blocks_long_texts_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "ITEM_BYTES", 100)
    docs = library(2, 60) + [(99, "w1 w5 long " * 300_000)]
    items = [(i, t) for i, t in library(3, 12)]
    frame, asked = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = ranked_search.ranked_search(frame, asked, top=4)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_search(docs, items, 4)
    assert ranked_search.ranked_search(frame.limit(0), asked).count() == 0
    assert ranked_search.ranked_search(frame, asked.limit(0)).count() == 0


def test_blocks_below_the_threshold_are_not_scored(spark):
    """One document has the rare words; no block with a bound below its score is turned and scored."""
    texts = [(i, "common words only") for i in range(2000)] + [(9999, "rare words")] * 10
    index = ranked_search.build_index(spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)).collect()
    items = ranked_search.Items([b"rare common"])
    df = np.array([sum(b"rare" in r.terms.split() and 10 for r in index), 2000])
    items.weigh(df, 2010, 6020)
    bounds = [items.bounds(items.known(bytes(r.terms)), bytes(r.max_tf), bytes(r.min_length))[0] for r in index]
    best = max(range(len(index)), key=lambda k: bounds[k])
    scores = ranked_search.Block(items, index[best].asDict() | {c: bytes(index[best][c]) for c in ("terms", "sizes", "posts", "lengths", "tfs")}).scores(0)
    tenth = np.sort(scores)[-10]
    assert tenth > 0 and sum(b >= tenth for b in bounds) == 1 and all(b >= 0 for b in bounds)
