from __future__ import annotations

import base64
import hashlib
import os
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from leadtime.llm import bpe, common, line_dedup, mixing, ngram_join, quality_classifier, quality_rules, sharding, suffix_dedup, vptree, warc
from leadtime.llm.catalog import tokenizer
from leadtime.llm.components import components


def numbered(rows):
    return {i: t for i, t in enumerate(rows)}


def near_texts():
    rng = np.random.default_rng(3)
    vocabulary = [f"v{i}" for i in range(900)]
    texts = []
    for size in (6, 9, 14, 30, 80, 300):
        for _ in range(4):
            base = list(rng.choice(vocabulary, size))
            texts.append(" ".join(base))
            for edits in (1, 2, 3, 6):
                w = list(base)
                for at in rng.choice(size, min(edits, size), replace=False):
                    w[at] = f"e{rng.integers(1e6)}"
                texts.append(" ".join(w))
    return texts + ["", None, " \n", "one two", "One TWO", texts[0]]


def frame(spark, docs):
    return spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)


@pytest.mark.parametrize("width,percent", [(4, 85), (5, 80), (2, 60)])
def test_jaccard_components_equal_brute_force(spark, width, percent):
    docs = numbered(near_texts())
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(frame(spark, docs), width=width, percent=percent).collect()}
    assert got == brute.jaccard_components(docs, width, percent)


def test_signatures_of_similar_sets_meet():
    rng = np.random.default_rng(1)
    for size in [*range(1, 40), 77, 200, 1000]:
        for percent in (60, 85, 95):
            whole = np.unique(rng.integers(0, 2 ** 63, size + size, dtype=np.uint64))
            a = np.sort(rng.permutation(whole)[:size])
            drop = int(size * (100 - percent) / 100)
            b = a[np.sort(rng.permutation(size)[drop:])]
            if len(b) and len(b) < size and len(b) * 100 >= percent * size:
                with np.errstate(over="ignore"):
                    assert np.intersect1d(ngram_join.signature(a, percent), ngram_join.signature(b, percent)).size


def test_links_bridge_groups_that_overtake_each_other():
    window = lambda at: np.arange(1000 + at, 1100 + at, dtype=np.uint64)
    # a links b and c, then d links e, f and g; only b and e are near across, and each is put off while its group is the largest
    for places in ([-25, 0, 50, 25, -50, 75, 74], *np.random.default_rng(6).permuted(np.tile(np.arange(30) * 13, (40, 1)), axis=1)):
        sets = [window(int(at)) for at in places]
        near = [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 60 * len(np.union1d(sets[i], sets[j]))]
        assert brute.roots(ngram_join.linked(sets, 60), range(len(sets))) == brute.roots(near, range(len(sets)))


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, i) for i in range(101, 130)] + [(7, 7)]
    got = {(r.node, r.root) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(i, 0) for i in range(21)} | {(i, 100) for i in range(100, 130)}


def test_bpe_equals_the_library_and_comes_back(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer())
    texts = ["", None, "a<|endoftext|> b", "I'll  don't\r\n\t x y", "日本語 é \U0001F600", "x" * 5000, "the the the of"] + near_texts()[:20]
    docs = numbered(texts)
    for r in bpe.encode(frame(spark, docs), tokenizer()).collect():
        ids = t.encode(docs[r.doc_id] or "", add_special_tokens=False).ids
        assert (r.ids, r.n_tokens, r.decoded) == (ids, len(ids), docs[r.doc_id] or "")
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_words_merged_together_have_the_ids_of_words_merged_alone(monkeypatch):
    with open(tokenizer(), encoding="utf-8") as f:
        rules = bpe.Rules(f.read())
    rng = np.random.default_rng(7)
    words = [bytes(rng.choice(list(b" aeinrst\xc3\xa9"), n).tolist()) for n in rng.integers(1, 40, 3000)]
    words += [b"", b"a" * 7, b"a" * 8, b" " * 90, b"abab" * 20, b"e" * 100, b"e" * 101, b"x" * 500, "日本語".encode(), bytes(range(90))]
    alone = [rules.merge(w) for w in words]
    monkeypatch.setattr(rules, "merge", lambda w: rules.merge_long(w) if len(w) > bpe.LONG else pytest.fail("a short word was merged alone"))
    assert [np.frombuffer(ids, "<u4").tolist() for ids in rules.merge_many(words)] == alone
    assert rules.merge_many([]) == []


def test_ascii_texts_are_cut_as_any_other():
    with open(tokenizer(), encoding="utf-8") as f:
        encoder = bpe.Encoder(bpe.Rules(f.read()), None)
    rng = np.random.default_rng(9)
    letters = [*map(chr, range(128)), *" \n\t'" * 12, "'s", "'ll", "'re", "  \n"]
    for n in rng.integers(0, 60, 3000):
        text = "".join(letters[i] for i in rng.integers(0, len(letters), n))
        assert encoder.cut_ascii(text) == encoder.cut_any(text)


def test_a_worker_holds_the_words_of_few_texts_at_a_time(monkeypatch):
    with open(tokenizer(), encoding="utf-8") as f:
        encoder = bpe.Encoder(bpe.Rules(f.read()), None)
    texts = [f"text {i} of some <|endoftext|> words\n" for i in range(50)] + ["", "end"]
    want, held = list(encoder.encode(texts)), []
    some = encoder.encode_some
    monkeypatch.setattr(bpe, "TOGETHER", 100)
    monkeypatch.setattr(encoder, "encode_some", lambda t: held.append(len(t)) or some(t))
    assert list(encoder.encode(texts)) == want and max(held) <= 4 and sum(held) == len(texts)
    assert [encoder.decode(ids) for ids in want] == texts


def test_automaton_numbers_its_words_and_shares_endings(tmp_path):
    words = sorted({f"{a}{b}".encode() for a in ("walk", "talk", "stalk") for b in ("", "s", "ed", "ing")})
    arrays = bpe.compile_words(words, [[i, i + 1] for i in range(len(words))])
    (tmp_path / "lexicon").write_bytes(bpe.pack(arrays))
    lexicon = bpe.Lexicon(str(tmp_path / "lexicon"))
    assert lexicon.find([*words, b"", b"wal", b"walks!"]).tolist() == [*range(len(words)), -1, -1, -1]
    assert lexicon.output(3).tolist() == [3, 4]
    assert len(arrays["finals"]) < 20


@pytest.mark.parametrize("factor", [1.0, 3.0])
def test_neighbours_equal_brute_force(spark, factor):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 8)).round(3)
    x[50:60] = x[50]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000, None), (1001, [0.0] * 8), (1002, [float("nan")] * 8), (1003, [1.0] * 7 + [None]), (None, [1.0] * 8)]
    got = vptree.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=20, k=5, factor=factor, tree=64, block=7).collect()
    for q in range(0, 400, 20):
        s = vptree.exact_scores(x[[q]], x)[0]
        s[q] = -np.inf
        want = np.lexsort((np.arange(400), -s))[:5]
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [m[0] for m in mine] == [1, 2, 3, 4, 5]
        if factor == 1.0:
            assert [(m[1], m[2]) for m in mine] == [(int(w), s[w]) for w in want]


def test_rules_count_as_brute_force_and_part_good_from_bad(spark):
    good = [" ".join(f"the word{i}x{j}" for j in range(60)) + "." for i in range(60)]
    bad = [" ".join(f"###$$$ w{i}|{j}" for j in range(60)) for i in range(15)] + ["same line again\n" * 40] * 5
    docs = numbered(good + bad + ["", None, "a a a a a"])
    rows = {r.doc_id: r for r in quality_rules.judge(frame(spark, docs)).collect()}
    for i, t in docs.items():
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute.base_counts(t)
    assert all(rows[i].kept for i in range(60)) and not any(rows[i].kept for i in range(60, len(docs)))


def test_classifier_learns_and_keeps_out_the_held_out(spark):
    docs = numbered([f"fine plain words number {i}" if i % 2 else f"$$$ junk ### {i}" for i in range(300)] + [None, ""])
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, quality int")
    got = quality_classifier.classify(frame(spark, docs), labels).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (brute.crc(str(r.doc_id)) % 3 == 1) for r in got)
    assert all(r.predicted == r.doc_id % 2 for r in got if r.doc_id < 300)


def test_slots_are_even_gapless_and_move_only_to_a_new_shard(spark, tmp_path):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), (F.col("id") % 90 + 1).alias("size")).withColumn("virtual_slot", sharding.virtual_slot(F.col("doc_id"), 256))
    sizes = sharding.slot_bytes(docs)
    sharding.save_map(sharding.first_map(sizes, 7, 256), f"{tmp_path}/map")
    first = sharding.load_map(spark, f"{tmp_path}/map")
    placed = sharding.assign(docs, first).collect()
    loads = Counter()
    for r in placed:
        loads[r.shard] += r.size
    assert max(loads.values()) < 1.02 * min(loads.values())
    for s in range(7):
        assert sorted(r.position for r in placed if r.shard == s) == list(range(sum(r.shard == s for r in placed)))
    grown = {r.virtual_slot: r.shard for r in sharding.grow(first, sizes).collect()}
    before = {r.virtual_slot: r.shard for r in first.collect()}
    moved = [s for s in before if before[s] != grown[s]]
    assert moved and all(grown[s] == 7 for s in moved)


def test_archives_come_back_whole_and_the_same(spark, tmp_path):
    pages = [(i, f"http://x/{i} y", f"<html>{i % 40}</html>" * (i % 40)) for i in range(200)] + [(500, None, None), (501, "u", ""), (None, "v", "alone")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    rows, files = [], []
    for n in range(2):
        manifest = warc.write(df.repartition(3 + n), f"{tmp_path}/{n}", range_bytes=4000, roll_bytes=300)
        rows.append(sorted(map(tuple, warc.read_back(spark, f"{tmp_path}/{n}", manifest, payloads=True).collect()), key=str))
        files.append(sorted(map(tuple, manifest.collect())))
    assert rows[0] == rows[1] and files[0] == files[1] and len(files[0]) > 3
    last = {}
    for i, _, html in pages:
        last[html or ""] = max(i if i is not None else -1, last.get(html or "", -1))
    for page, _, size, digest, kind, other, body in rows[0]:
        html = next(h or "" for i, _, h in pages if i == page)
        assert size == len(html) and digest == base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()
        assert (kind, other) == (("response", None) if page is None or last[html] == page else ("revisit", last[html]))
        assert kind == "revisit" or body == html.encode()


def test_mix_reaches_targets_below_the_limit(spark):
    docs = spark.createDataFrame([(i, "w " * (i % 13), f"s{i % 5}" if i % 7 else None) for i in range(4000)], "doc_id long, text string, source string")
    rows = mixing.mix(docs).collect()
    by = {}
    for r in rows:
        s = by.setdefault(r.source, [0, r.source_size, r.target])
        s[0] += r.size * r.passes
        assert r.passes <= 3
    for taken, size, target in by.values():
        assert target <= 3 * size and abs(taken - target) <= 13
    assert abs(sum(s[2] for s in by.values()) - sum(r.size for r in rows)) < 1e-6


def test_lines_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    lines = [" ".join(f"t{x}" for x in rng.integers(0, 500, n)) for n in (5, 12, 30, 60, 60)]
    texts = []
    for i in range(40):
        some = [lines[j] for j in rng.integers(0, 5, 3)]
        some = [" ".join(w if rng.random() > 0.02 else "Changed," for w in s.split()) for s in some]
        texts.append("\n".join(some + ["", "short", "!!!", f"own line of document number {i}"]))
    docs = numbered(texts + [None, ""])
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in line_dedup.clean(frame(spark, docs), counts=True).collect()}
    assert got == brute.clean_lines(docs)


def test_unlike_lines_are_compared_a_few_at_a_time(spark, monkeypatch):
    rng = np.random.default_rng(12)
    words = sorted({"".join(rng.choice(list("abcdefghijklmnopqrst"), 6)) for _ in range(60)})
    texts = []
    for _ in range(8):  # one SimHash for all orders of the words
        line = " ".join(rng.permutation(words))
        texts += [line, line.replace(" ", ", ", 1) + "\nshort", line.replace(words[31], words[31] + "s")]
    docs, begun, sizes, keep = numbered(texts), len(common.MADE), [], line_dedup.stored

    def stored(df, name):
        table, path = keep(df, name)
        if name == "line-links":
            sizes.append(table.count())
        return table, path

    monkeypatch.setattr(line_dedup, "stored", stored)
    monkeypatch.setattr(line_dedup, "SHARE", 0)
    monkeypatch.setattr(line_dedup, "LEAST_CHARS", 12_000)
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in line_dedup.clean(frame(spark, docs), counts=True).collect()}
    assert got == brute.clean_lines(docs)
    assert sum(sizes) > 40 and max(sizes) < 24 and len(sizes) > line_dedup.ROUNDS + 1  # a pair has about 840 characters
    left = {os.path.basename(path).rpartition("-")[0] for path in common.MADE[begun:] if os.path.exists(path.removeprefix("file:"))}
    assert "line-places" in left and left <= {"line-places", "line-groups", "edges"}


def test_counters_of_either_width_give_one_simhash(spark):
    rows = [(i, " ".join("w" + "abcdefghij"[j * j % (i + 7) % 10] * (i % 3 + 1) for j in range(i * 9 + 1)) + " \n... ---\n") for i in range(60)]
    lines = line_dedup.split_lines(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text")
    narrow, wide = ({tuple(r) for r in line_dedup.hashed(lines, n).collect()} for n in (line_dedup.NARROW, line_dedup.WIDE))
    assert narrow == wide and len(narrow) == 120 and len({r[-1] for r in narrow if r[5] > 0}) > 30


def test_repeated_passages_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    own = lambda n: [f"o{x}" for x in rng.integers(0, 10 ** 9, n)]
    shared = [own(n) for n in (49, 50, 51, 120)]
    texts = [" ".join(own(int(rng.integers(0, 80))) + shared[i % 4] + own(int(rng.integers(0, 80)))) for i in range(24)] + [" ".join(shared[3] + own(5) + shared[3]), "", None]
    docs = numbered(texts)
    got = {i: set() for i in docs}
    for r in suffix_dedup.repeated_passages(frame(spark, docs)).collect():
        got[r.doc_id] |= set(range(r.first, r.end))
    assert got == brute.repeated_words(docs)


def common_gram(rng):
    """Twenty words whose hash is small, so that they stand for any window around them."""
    import xxhash

    own = lambda: [f"c{x}" for x in rng.integers(0, 10 ** 9, 20)]
    with np.errstate(over="ignore"):
        return min((own() for _ in range(5_000)), key=lambda w: int(suffix_dedup.grams(np.array([xxhash.xxh64_intdigest(x.encode(), seed=42) for x in w], np.uint64), 20)[0]))


def repeated_words(spark, docs):
    got = {i: set() for i in docs}
    for r in suffix_dedup.repeated_passages(frame(spark, docs)).collect():
        got[r.doc_id] |= set(range(r.first, r.end))
        assert r.copies > 1
    return got


def test_passages_are_found_around_a_very_common_gram(spark):
    rng = np.random.default_rng(8)
    own = lambda n: [f"o{x}" for x in rng.integers(0, 10 ** 9, n)]
    gram, pairs = common_gram(rng), [own(30) for _ in range(20)]
    docs = numbered(" ".join((pairs[i % 20] if i < 40 else own(30)) + gram + own(30)) for i in range(6000))
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    try:
        got = repeated_words(spark, docs)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    assert got == {i: set(range(50)) if i < 40 else set() for i in docs}


def test_passages_are_found_among_many_that_share_either_side(spark):
    rng = np.random.default_rng(9)
    own = lambda n: [f"o{x}" for x in rng.integers(0, 10 ** 9, n)]
    docs, whole = [], set()
    for _ in range(5):  # two texts share both sides of the gram, a hundred others one side each
        gram, left, right = common_gram(rng), own(15), own(15)
        whole |= {len(docs), len(docs) + 1}
        docs += [own(20) + left + gram + right + own(20) for _ in range(2)]
        docs += [own(35) + gram + right + own(20) for _ in range(50)] + [own(20) + left + gram + own(35) for _ in range(50)]
    docs = numbered(" ".join(w) for w in docs)
    assert repeated_words(spark, docs) == {i: set(range(20, 70)) if i in whole else set() for i in docs}


def test_stars_within_a_larger_star_go_and_no_pair_is_lost(spark):
    rng = np.random.default_rng(3)
    pairs = {tuple(sorted(p)) for p in rng.integers(0, 14, (60, 2)).tolist() if p[0] != p[1]} | {(20, 21), (20, 22), (20, 23), (21, 22), (21, 23), (22, 23)}
    left = {tuple(r) for r in ngram_join.outer_stars(spark.createDataFrame(sorted(pairs), "center long, c long")).collect()}

    def met(rows):
        stars = {}
        for a, b in rows:
            stars.setdefault(a, {a}).add(b)
        return {(x, y) for s in stars.values() for x in s for y in s}

    assert left <= pairs and met(left) == met(pairs)
    assert {p for p in left if p[0] >= 20} == {(20, 21), (20, 22), (20, 23)}


def test_lines_leave_columns_with_clashing_names(spark):
    line = "one line of more than five words that stands twice"
    rows = [(1, line, 10, 20, 30, 40), (2, line + "\nand another one", 11, 21, 31, 41)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, gone long, _doc long, _own_key long, row long")
    got = sorted(tuple(r) for r in line_dedup.clean(docs).collect())
    assert got == [rows[0], (2, "and another one", *rows[1][2:])]


EVERY = {
    "jaccard": lambda d: ngram_join.jaccard_components(d),
    "bpe": lambda d: bpe.encode(d, tokenizer()),
    "suffix": lambda d: suffix_dedup.repeated_passages(d),
    "rules": lambda d: quality_rules.judge(d),
    "classifier": lambda d: quality_classifier.classify(d, d.selectExpr("doc_id", "n as quality")),
    "mix": lambda d: mixing.mix(d),
    "lines": lambda d: line_dedup.clean(d),
    "vectors": lambda d: vptree.nearest(d.selectExpr("doc_id as vec_id", "array(cast(size as double)) as embedding", "text as id", "lang as dim")),
}


@pytest.mark.parametrize("name", EVERY)
def test_odd_and_empty_tables(odd_docs, no_docs, name):
    rows = EVERY[name](odd_docs).collect()
    assert len(rows) == odd_docs.count() if name not in ("suffix", "vectors") else True
    assert EVERY[name](no_docs).collect() == []


def test_components_of_stars_need_no_step(spark, monkeypatch):
    from leadtime.llm import components as module

    made = []
    cut = module.cut_lineage
    monkeypatch.setattr(module, "cut_lineage", lambda df, name: made.append(name) or cut(df, name))
    stars = [(1, 2), (5, 1), (1, 9), (3, 4)]
    got = {r.node: r.root for r in module.components(spark.createDataFrame(stars, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 5: 1, 9: 1, 3: 3, 4: 3} and len(made) == 1


def test_simhash_takes_few_operations_up_to_the_longest_lines(spark):
    rows = [(n, " ".join(f"W{i % 19}, x{i % (n + 1)}?" for i in range(n))) for n in (1, 4, 5, 60, 1000)] + [(7, "a\tb\x0bc\x0cd\re 12-3"), (8, "b " * 2047)]
    rows += rows[:4]  # equal rows add up
    split = line_dedup.split_lines(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text")
    for stride in (line_dedup.NARROW, line_dedup.WIDE):
        lines = line_dedup.hashed(split, stride)
        got = {r.doc: (r.n_words, r.sim % 2**64) for r in lines.collect()}
        assert got == {i: (len(w), brute.simhash(w)) for i, t in rows for w in [brute.line_words(t)]}
        assert lines._jdf.queryExecution().optimizedPlan().toString().count("CASE WHEN") < 8


def test_simhash_counts_many_words_in_a_row_of_the_aggregate(spark):
    rows = [(n, " ".join(f"w{i % 5}y{i * i % (n + 2)}" for i in range(n)) or "..") for n in (*range(0, 64), 150, 151, 165)]
    split = line_dedup.split_lines(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text")
    for stride in (line_dedup.NARROW, line_dedup.WIDE):
        lines = line_dedup.hashed(split, stride)
        got = {r.doc: (r.n_words, r.sim % 2**64) for r in lines.collect()}
        assert got == {i: (len(w), brute.simhash(w)) for i, t in rows for w in [brute.line_words(t)]}
        sets_out = [x for x in lines._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Generate explode" in x]
        assert all(f"sequence(0, greatest((n_words" in x and f"Some({line_dedup.CHUNK})" in x for x in sets_out if "[_at" in x) and any("[_at" in x for x in sets_out)


def test_long_lines_are_told_apart_as_by_their_edit_distance(spark):
    rng = np.random.default_rng(11)
    own = lambda n: [f"{x:x}" for x in rng.integers(0, 10 ** 6, n)]
    pairs = []
    for n in (8, 30, 60):
        for edits in (1, 2, n // 8, n // 6, n // 4):
            base = own(n)
            w = list(base)
            for at in sorted(rng.choice(n, edits, replace=False), reverse=True):
                w[at:at + 1] = [[], own(1), own(2)][rng.integers(0, 3)]
            pairs += [(base, w), (base, base[edits:] + base[:edits]), (base[:n // 2] + w[n // 2:], base), (own(n), base)]
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pairs)], "id long, x array<string>, y array<string>")
    told = df.select("id", line_dedup.alike("x", "y", 85).alias("linked"))
    spelt = [(" ".join(x) + " ", " ".join(y) + " ") for x, y in pairs]
    want = {i: brute.edit(x, y) * 100 <= max(len(x), len(y)) * 15 for i, (x, y) in enumerate(spelt)}
    assert {r.id: r.linked for r in told.collect()} == want and 10 < sum(want.values()) < len(want) - 10
    assert "left(" in told._jdf.queryExecution().analyzed().toString()  # ends go before whole lines


def test_lines_are_told_apart_by_missing_pieces_before_their_distance(spark):
    rng = np.random.default_rng(12)
    own = lambda n: ["".join(rng.choice(list("abcdeäöüß"), rng.integers(1, 9))) for _ in range(n)]
    pairs = [(own(n), own(m)) for n, m in ((1, 2), (5, 6), (40, 42), (90, 90), (90, 99))]
    for n in (6, 25, 70):
        for gone, more in ((1, 0), (0, 1), (n // 9, n // 9), (n // 7, 0), (0, n // 7), (n // 5, n // 12)):
            w = own(n)
            x, y = list(w), list(w)
            for at in rng.integers(0, n - gone, gone):
                del y[at]
            for at in rng.integers(0, len(y), more):
                y[at:at] = own(1)
            pairs += [(x, y), (y, x), (["start"] + x + ["end"], ["begin"] + y + ["close"])]
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pairs)], "id long, x array<string>, y array<string>")
    told = df.select("id", line_dedup.alike("x", "y", 85).alias("linked"))
    spelt = [(" ".join(x) + " ", " ".join(y) + " ") for x, y in pairs]
    want = {i: brute.edit(x, y) * 100 <= max(len(x), len(y)) * 15 for i, (x, y) in enumerate(spelt)}
    assert {r.id: r.linked for r in told.collect()} == want and 10 < sum(want.values()) < len(want) - 10
    plan = told._jdf.queryExecution().analyzed().toString()
    assert plan.count("concat_ws(") == 2 and "contains(" in plan.lower()  # the limit is worked out once for a pair


def test_words_of_a_line_lose_punctuation_by_one_pattern(spark):
    rows = ["It's a [test], isn't it? {x|y} #tag *_* a-b \"q\"; (c): end!", "Ä ΣΑΣ, été 1234567890 12-3", "a\tb\x0bc\x0cd\re \u00a0 f", "... --- !!!", "", " \\ $1 ^a ~&/ "]
    words = line_dedup.normal_words(F.col("line"))
    got = spark.createDataFrame([(x,) for x in rows], "line string").select("line", words.alias("w"))
    assert {r.line: tuple(r.w) for r in got.collect()} == {x: brute.line_words(x) for x in rows}
    assert "regexp_replace(" in got._jdf.queryExecution().analyzed().toString()


def test_texts_and_sets_reach_workers_a_few_megabytes_at_a_time(spark, tmp_path, monkeypatch):
    log, real = str(tmp_path / "shingles"), ngram_join.chunks

    def spy(sets, *args):
        with open(log, "a") as out:
            out.write(f"{sum(len(s) for s in sets)}\n")
        return real(sets, *args)

    monkeypatch.setattr(ngram_join, "chunks", spy)
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    docs = spark.range(0, 4000, 1, 2).selectExpr("id as doc_id", "array_join(transform(sequence(1, 500), i -> concat(i, 'x', id % 3000)), ' ') as text")
    found = ngram_join.jaccard_components(docs)
    assert found.where("component_id = doc_id").count() == 3000 and found.count() == 4000
    held = [int(x) for x in open(log)]
    assert sum(held) >= 4000 * 500 and max(held) * 8 <= 5 << 20
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before
