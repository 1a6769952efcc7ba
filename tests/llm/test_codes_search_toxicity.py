"""Vector codes, ranked search and toxicity against plain versions that share no code with them."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from leadtime.llm import dual_tree, toxicity, vector_codes

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_codes(rows, parts=4, entries=256, rounds=4):
    """{key: ([codes], error)} and the entries, in Python's whole numbers."""
    kept = [(k, [math.floor(1024 * x) for x in v]) for k, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    kept = [r for r in kept if len(r[1]) == len(min(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1])
    cut = [[v[p * width // parts:(p + 1) * width // parts] for _, v in kept] for p in range(parts)]
    books, codes = [[list(x) for x in c[:entries]] for c in cut], None
    for turn in range(rounds + 1):
        found = [[min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(books[p])) for x in cut[p]] for p in range(parts)]
        if turn < rounds:
            for p in range(parts):
                members = defaultdict(list)
                for x, (_, i) in zip(cut[p], found[p]):
                    members[i].append(x)
                for i, xs in members.items():
                    books[p][i] = [sum(c) // len(xs) for c in zip(*xs)]
    return [(k, [found[p][j][1] for p in range(parts)], sum(found[p][j][0] for p in range(parts))) for j, (k, _) in enumerate(kept)], books


def vectors(rng, n=300, width=8):
    x = rng.normal(size=(n, width)).round(2) * rng.choice([0.05, 1.0], size=(n, 1))
    x[20:40] = x[20]  # equal vectors and equal entries
    return [(i, v.tolist()) for i, v in enumerate(x)]


@pytest.mark.parametrize("width,entries", [(8, 20), (10, 7), (4, 1)])
def test_codes_equal_brute_force(spark, width, entries):
    rows = vectors(np.random.default_rng(width), width=width)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("label", F.when(F.col("vec_id") % 3 > 0, F.col("vec_id") % 3)).repartition(5)
    coded, books = vector_codes.fit_and_encode(df, entries=entries)
    want, entries_want = brute_codes(rows, entries=entries)
    assert [b.tolist() for b in books] == entries_want
    assert sorted((r._key, r._code, r._error) for r in coded.collect()) == want
    got = vector_codes.compress(df, entries=entries).collect()
    by = Counter()
    for k, _, e in want:
        by[k % 3] += e
    assert sorted((r.vec_id, r.code, r.error, r.label_error) for r in got) == [(k, "".join(f"{c:02x}" for c in code), e, by[k % 3]) for k, code, e in want]


def test_balls_find_what_a_search_over_all_finds_with_less_work():
    rng = np.random.default_rng(1)
    for x in (rng.integers(-60, 60, (3000, 3)), np.repeat(rng.integers(-4000, 4000, (40, 3)), 75, axis=0) + rng.integers(-9, 9, (3000, 3)), rng.integers(0, 3, (3000, 3))):
        entries = x[rng.permutation(3000)[:64]]
        old, _ = vector_codes.nearest(x, entries)
        moved = entries + rng.integers(-2, 3, entries.shape)
        work = np.zeros(3, np.int64)
        at, best = vector_codes.ball_nearest(x, old, moved, vector_codes.squared(moved, moved), work)
        want, least = vector_codes.nearest(x, moved)
        assert (at == want).all() and (best == least).all()
        assert work[0] == 3000 and work[2] <= 3000 * 63
    assert work[2] > 0


def test_codes_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(5, [0.5, -0.25], "a"), (5, [0.5, -0.25], "a"), (None, [9.0, 9.0], None), (1, None, "a"), (2, [], "a"), (3, [None, 1.0], "a"), (4, [nan, 1.0], "a"),
            (6, [inf, 1.0], None), (7, [1.0, 2.0, 3.0], "b"), (8, [1e30, 0.0], "b"), (9, [-0.0001, 0.0], None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string").selectExpr("*", "1 as _v", "2 as code", "3 as _of", "4 as error")
    got = sorted(map(tuple, vector_codes.compress(df).select("vec_id", "code", "error", "label_error").collect()), key=str)
    want, books = brute_codes([(r[0], r[1]) for r in rows if r[0] != 8])
    assert got == sorted([(k, "".join(f"{c:02x}" for c in code), e, 0) for k, code, e in want], key=str) and len(got) == 4
    assert vector_codes.compress(df.limit(0)).collect() == []
    decoded = vector_codes.decode(*vector_codes.fit_and_encode(df)).collect()
    assert all(abs(x - y) < 1 / 1024 for r in decoded if r._key == 5 for x, y in zip(r._near, [0.5, -0.25]))


def test_large_components_stay_exact(spark):
    rows = [(i, [float(x) for x in np.random.default_rng(i).integers(-9000, 9000, 4)]) for i in range(40)]
    coded, _ = vector_codes.fit_and_encode(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), label=None, entries=5)
    assert sorted((r._key, r._code, r._error) for r in coded.collect()) == brute_codes(rows, entries=5)[0]


def brute_search(items, docs, k=20):
    held = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    big_n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c in held:
            m = 75 + (25 * sum(c.values()) * big_n) // total
            score = 0
            for t, times in Counter(TERM.findall((text or "").translate(LOWER))).items():
                if t in c:
                    w = math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1)))
                    score += times * w * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m))
            if score > 0:
                found.append((-score, i is None, i))
        found.sort(key=lambda x: x[:2] + (x[2] if x[2] is not None else 0,))
        out += [(item, rank + 1, f[2], -f[0]) for rank, f in enumerate(found[:k])]
    return sorted(out, key=str)


def corpus(rng, n=400):
    words = [f"Wört{i}" if i % 5 == 0 else f"w{i}" for i in range(200)]
    chance = 1 / np.arange(1, 201)
    texts = ["; ".join(rng.choice(words, rng.integers(0, 40), p=chance / chance.sum())) for _ in range(n)]
    texts[50:80] = [texts[50]] * 30  # ties beyond k
    return texts


@pytest.mark.parametrize("block,cells,leaf,k", [(dual_tree.BLOCK, dual_tree.CELLS, dual_tree.LEAF, 20), (400, 3000, 4, 5), (1, 1, 1, 1)])
def test_search_equals_brute_force(spark, monkeypatch, block, cells, leaf, k):
    monkeypatch.setattr(dual_tree, "BLOCK", block)
    rng = np.random.default_rng(leaf)
    texts = corpus(rng)
    docs = list(enumerate(texts)) + [(None, texts[50]), (7, texts[7]), (900, None), (901, " -- "), (902, "w3 " * 30_000)]
    items = [(i, texts[int(rng.integers(400))][:60] + " w1 w1") for i in range(12 if block > 1 else 3)] + [(3, None), (None, "w2 wört0"), (4, "absent"), (4, "w5 W5")]
    found = dual_tree.top_documents(spark.createDataFrame(items, "item_id long, text string"),
                                    spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as _n", "2 as rank").repartition(4), k=k)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=str) == brute_search(items, docs, k)


def test_search_leaves_out_batches_of_pairs():
    rng = np.random.default_rng(3)
    n, n_terms = 2000, 300
    topics = rng.permutation(n_terms).reshape(20, 15)
    owner = np.repeat(np.arange(n), 12)
    term = topics[owner % 20, rng.integers(0, 15, n * 12)]
    owner, term = np.divmod(np.unique(owner * n_terms + term), n_terms)
    value = rng.integers(1, 1000, len(owner))
    counts = [{int(t): 1 for t in rng.choice(topics[i % 20], 6, replace=False)} for i in range(40)]
    items = dual_tree.Items(list(range(40)), counts, {t: t for t in range(n_terms)}, np.full(n_terms, 3))
    best = dual_tree.Best(40, 5, np.ones(40))
    scored = dual_tree.search(items, best, list(range(n)), owner, term, value)
    dense = np.zeros((n, n_terms))
    dense[owner, term] = value
    scores = dense @ items.tree.levels[0].T
    for i, found in enumerate(best.found):
        order = np.lexsort((np.arange(n), -scores[:, i]))[:5]
        assert [(-s, x) for s, _, x in found] == [(scores[j, i], j) for j in order if scores[j, i] > 0]
    assert 0 < scored < 0.2 * 40 * n  # a twentieth share a topic


def test_search_without_items_or_documents(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    assert dual_tree.top_documents(items, no_docs).collect() == []
    assert dual_tree.top_documents(items.limit(0), odd_docs).collect() == []
    assert {r.doc_id for r in dual_tree.top_documents(items, odd_docs).collect()} == {7, 8}


def symbols(word: str) -> list:
    out = []
    for b in word.encode():
        out.append(b)
    return out


def brute_odds(ordinary, toxic, text):
    """Per-word odds of a text from trigram counts in dictionaries, the formulas written out once more."""
    def trigrams(t):
        for w in TERM.findall(t.translate(LOWER)):
            x = [0, 0, *symbols(w), 0]
            for a, b, c in zip(x, x[1:], x[2:]):
                yield (a, b) if b else (0, 0), c

    counts = [Counter(g for t in texts for g in trigrams(t)) for texts in (toxic, ordinary)]
    both = counts[0] + counts[1]

    def cuts(values):
        n = [max(1, sum(v == i for v in values)) for i in range(1, 5)]
        y = n[0] / (n[0] + 2 * n[1])
        return [0, *(min(i, max(0.5, i - (i + 1) * y * n[i] / n[i - 1])) for i in (1, 2, 3))]

    def model(c, below):
        d, total, off = cuts(c.values()), Counter(), Counter()
        for (h, _), n in c.items():
            total[h] += n
            off[h] += d[min(n, 3)]
        return lambda h, x: below(h, x) if h not in total else ((c[h, x] - d[min(c[h, x], 3)] if (h, x) in c else 0) + off[h] * below(h, x)) / total[h]

    pairs = Counter((h[1], x) for h, x in both)
    single = Counter(((), x) for _, x in pairs)
    uniform = lambda h, x: 1 / toxicity.SYMBOLS
    one = model(single, uniform)
    two = model(pairs, lambda h, x: one((), x))
    shared = model(both, lambda h, x: two(h[1], x))
    sides = [model(c, shared) for c in counts]
    found = list(trigrams(text))
    n_words = len(TERM.findall(text.translate(LOWER)))
    return sum(math.log(sides[0](h, x)) - math.log(sides[1](h, x)) for h, x in found) / max(1, n_words)


def test_odds_equal_the_formulas(spark):
    ordinary = ["The quick brown fox, the lazy dog.", "A lazy afternoon; the fox sleeps", "über den Fluss 12", "the the the fox"]
    toxic = ["you idiot, the fox is an idiot", "IDIOT! worthless idiot", "the dog"]
    taught = spark.createDataFrame([(t, 0) for t in ordinary] + [(t, 1) for t in toxic], "text string, toxic int").repartition(3)
    table = toxicity.odds_table(*toxicity.trigram_counts(taught))
    texts = [*ordinary, *toxic, "an unseen idiotic fox", "ÜBER zzz 9", "", " - ", "x" * 5000]
    for r in toxicity.log_odds(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), table).collect():
        assert abs(r.per_word - brute_odds(ordinary, toxic, texts[r.doc_id])) < 1e-9


def test_long_texts_span_pieces(monkeypatch):
    import pyarrow as pa

    texts = pa.array(["ab, Cd " * 50, None, "", "é" * 31, "z"])
    whole = [np.concatenate(x) for x in zip(*toxicity.events(texts))]
    monkeypatch.setattr(toxicity, "PIECE", 7)
    assert all((a == np.concatenate(b)).all() for a, b in zip(whole, zip(*toxicity.events(texts))))


def test_toxic_texts_are_told_from_held_out_ordinary_ones(spark):
    rng = np.random.default_rng(5)
    parts = ["an", "er", "the", "on", "ti", "ble", "re", "st"]
    plain = lambda n: [" ".join("".join(rng.choice(parts, 3)) for _ in range(60)) for _ in range(n)]
    docs = {i: t for i, t in enumerate(plain(500))}
    for i in range(0, 500, 4):
        w = docs[i].split()
        for at in rng.choice(60, 3, replace=False):
            w[at] = str(rng.choice(["scum", "moron", "clown"]))
        docs[i] = " ".join(w)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(500)], "doc_id long, toxic int")
    got = toxicity.classify(spark.createDataFrame(list(docs.items()), "doc_id long, text string"), labels).collect()
    assert all(r.held_out == (brute.crc(str(r.doc_id)) % 5 == 0) and r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert len(held) > 60 and sum(r.predicted == int(r.doc_id % 4 == 0) for r in held) >= 0.97 * len(held)
    changed = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.classify(spark.createDataFrame(list(docs.items()), "doc_id long, text string"), changed).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))  # held-out labels teach nothing


def test_toxicity_of_odd_tables(spark, odd_docs, no_docs):
    marks = odd_docs.selectExpr("doc_id", "doc_id % 2 as toxic", "'x' as text")
    for labels in (marks, marks.limit(0), marks.where("toxic = 1"), marks.selectExpr("doc_id", "7 as toxic"), marks.selectExpr("doc_id", "cast(null as int) as toxic")):
        rows = toxicity.classify(odd_docs.withColumn("held_out", F.lit("own")).withColumn("_h", F.lit(1)), labels).collect()
        assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
        assert toxicity.classify(no_docs, labels).collect() == []


def test_equal_texts_teach_once(spark):
    docs = spark.createDataFrame([(i, "same text") for i in range(1, 60)] + [(100, None), (101, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 102)], "doc_id long, toxic int")
    rows = toxicity.teaching_rows(docs, labels, "doc_id", "text", "toxic").collect()
    assert sorted((r.text or "", r.toxic) for r in rows) == [("", 0), ("", 1), ("same text", 0), ("same text", 1)]


def test_lower_words_are_words(spark):
    from leadtime.llm.common import lower_words

    texts = [None, "", " ", "A", " a  B\t\tc\n\r\nD\x0be\x0cf ", "É\u00a0x\u2003Y \x1c z", "\n" * 9, "one"]
    for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", lower_words(F.col("t")).alias("w")).collect():
        assert r.w == brute.WORD.findall((r.t or "").translate(LOWER))
