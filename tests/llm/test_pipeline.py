"""The stages of the corpus pipeline on odd and empty tables, and the near-duplicate stage against brute force."""

from __future__ import annotations

import brute
import corpus_pipeline
import pytest
from pyspark.sql import functions as F

STAGES = dict(corpus_pipeline.STAGES)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd_table(spark):
    base = " ".join(f"w{i % 97}x{i % 31}" for i in range(300))
    lines = "\n".join(f"line {i} of the text and so on with the rest {i * 7}" for i in range(60))
    rows = [(1, base, "a"), (2, base, "a"), (3, base.replace("w5x5", "other"), None), (4, None, "b"), (5, "", "b"), (6, " \n\t ", "c"), (7, "one two three", "c"),
            (7, "one two three", "c"), (7, "another text for the same id", "c"), (None, base + " more", "a"), (None, None, None), (10, "word " * 20_000, "d"), (11, lines, "d")]
    # columns of the operators' own names ride along
    return table(spark, rows).selectExpr("*", "1 as n", "2 as slot", "3 as key", "4 as target", "5 as component_id")


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_a_stage_takes_odd_and_empty_tables(spark, odd_table, name):
    stage, last = STAGES[name], corpus_pipeline.STAGES[-1][0]
    rows = stage(spark, odd_table, "").collect()
    if name != last:
        assert set(rows[0].asDict() if rows else corpus_pipeline.COLUMNS) == set(corpus_pipeline.COLUMNS)
    if name in ("line dedup", last):
        assert len(rows) == odd_table.count()
    assert stage(spark, odd_table.limit(0), "").collect() == []


def test_near_duplicates_keep_one_row_of_each_group_and_lose_no_text(spark):
    words = [f"v{i}" for i in range(400)]
    a, b = " ".join(words[:100]), " ".join(words[100:200])
    near_b, other = b.replace("v150", "changed"), " ".join(words[200:260])
    rows = [(1, a, "s"), (2, a, "s"), (2, b, "s"), (3, near_b, "s"), (None, a, "s"), (None, other, "s"), (4, a + "\n", "s"), (5, "", "s"), (5, "", "s"), (6, None, "s"), (7, "a b", "s"), (8, "A  b", "s")]
    got = sorted(((r.doc_id, r.text) for r in STAGES["n-gram Jaccard join"](spark, table(spark, rows), "").collect()), key=str)
    # b stays under id 2 although a under id 2 goes; a copy without an id goes, a text of its own without an id stays
    assert got == sorted([(1, a), (2, b), (None, other), (5, ""), (6, None), (7, "a b")], key=str)


def test_near_duplicates_equal_brute_force(spark):
    texts = {}
    for g in range(12):
        base = [f"g{g}w{i}" for i in range(150)]
        for e in range(4):
            w = list(base)
            w[e * 7] = f"edit{e}"
            texts[g * 10 + e] = " ".join(w[: 150 - 9 * e])
    found = brute.jaccard_components(texts, 5, 80)
    want = sorted(i for i, (_, component) in found.items() if component == i)
    got = STAGES["n-gram Jaccard join"](spark, table(spark, [(i, t, "s") for i, t in texts.items()]), "").collect()
    assert sorted(r.doc_id for r in got) == want and 0 < len(want) < len(texts)


def test_mixed_rows_repeat_as_often_as_the_mix_takes_them(spark):
    docs = table(spark, [(i, "w " * (1 + i % 5), "abc"[i % 3]) for i in range(300)])
    from leadtime.llm import mixing

    want = {r.doc_id: r.passes for r in mixing.mix(docs).collect() if r.passes}
    got = {r.doc_id: r.n for r in STAGES["mixing sources"](spark, docs, "").groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert got == want


def test_a_stage_lets_the_driver_drop_what_former_queries_left(spark):
    def collections():
        return sum(b.getCollectionCount() for b in spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans())

    class Held:
        pass

    import weakref

    held = Held()
    held.itself, seen, before = held, weakref.ref(held), collections()
    del held
    STAGES["quality rules"](spark, table(spark, [(1, "one text", "a")]), "")
    assert seen() is None and collections() > before


def test_a_scratch_table_lets_a_full_driver_drop_what_finished_queries_left(spark, monkeypatch):
    from leadtime.llm import common

    settled = []
    monkeypatch.setattr(common, "settle", settled.append)
    monkeypatch.setattr(common, "FULL", 1.0)
    assert common.cut_lineage(spark.range(3)).count() == 3 and settled == []
    monkeypatch.setattr(common, "FULL", 0.0)
    assert common.cut_lineage(spark.range(3)).count() == 3 and settled == [spark]
