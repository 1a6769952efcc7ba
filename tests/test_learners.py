from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from leadtime.operators import evaluation as ev
from leadtime.operators import learners as ml
from leadtime.session import cut_lineage


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(4)
    rows = []
    for i in range(600):
        y = int(rng.random() < 0.2)
        rows.append((f"k{i}", y, rng.gauss(2.0 * y, 1), rng.gauss(-y, 1), i % 4 == 0))
    return cut_lineage(spark.createDataFrame(rows, "key string, y int, a double, b double, val boolean"))


def models():
    return {"lr": ml.logistic_regression("y", 0.01, rounds=30), "gbt": ml.boosted_trees("y", rounds=2, depth=2)}


def probabilities(df, name):
    r = df.agg(F.min(name), F.max(name), F.count(name), F.count("*")).first()
    assert 0 <= r[0] <= r[1] <= 1 and r[2] == r[3]


def test_boosted_trees_stop_early_and_rank(data):
    model = ml.fit_boosted_trees(data, ["a", "b"], "y", "val", rounds=8, depth=2)
    df = ml.add_score(model, ml.assemble(data, ["a", "b"]), "p")
    probabilities(df, "p")
    assert ev.roc_auc(df, "y", "p").first()["auc_roc"] > 0.85
    assert "prediction" not in df.columns and "probability" not in df.columns


def test_balanced_logistic(data):
    df = ml.add_score(ml.fit_balanced_logistic(data, ["a", "b"], "y"), ml.assemble(data, ["a", "b"]), "p")
    r = ev.metrics_at(df, "y", "p").first()
    assert r["auc_roc"] > 0.9 and r["recall"] > 0.8  # a plain fit would miss most of the rare class


def test_out_of_fold_covers_all_rows_once(data):
    df = ml.out_of_fold(data, models(), ["a", "b"], "y", ["key"], folds=3)
    assert df.count() == 600 and df.select("key").distinct().count() == 600
    probabilities(df, "lr")
    probabilities(df, "gbt")


@pytest.mark.parametrize("meta", ["logistic", "ridge"])
def test_stacking(data, meta):
    stack = ml.Stacking(models(), ["a", "b"], "y", ["key"], meta, folds=2).fit(data)
    out = stack.transform(data)
    probabilities(out, "p_stack")
    assert ev.roc_auc(out, "y", "p_stack").first()["auc_roc"] > 0.9
    stack.fitted.pop("gbt")
    assert stack.transform(data).select("gbt").distinct().collect()[0][0] == 0.5
    with pytest.raises(ValueError):
        ml.Stacking({}, [], "y", [], "tree")


def test_candidates_stay_in_range_and_search_finds_best(data):
    c = ml.draw_candidates({"d": ("int", 2, 3), "s": ("log", 0.01, 1.0)}, 20)
    assert c == ml.draw_candidates({"d": ("int", 2, 3), "s": ("log", 0.01, 1.0)}, 20)
    assert all(x["d"] in (2, 3) and 0.01 <= x["s"] <= 1.0 for x in c)
    trials = ml.search_parameters(data.where("NOT val"), data.where("val"), ["a", "b"], "y",
                                  lambda penalty: ml.logistic_regression("y", penalty, rounds=20),
                                  [{"penalty": 50.0}, {"penalty": 0.001}], 0.3)
    assert trials.count() == 2 and ml.best_trial(trials).first()["trial"] == 1


def test_oversample_balances_with_points_between_neighbours(data):
    out = ml.oversample(data, "y", ["a", "b"], "key").cache()
    counts = {(r["y"], r["synthetic"]): r["count"] for r in out.groupBy("y", "synthetic").count().collect()}
    assert counts[(0, False)] == counts[(1, False)] + counts[(1, True)]
    real = {r["key"]: (r["a"], r["b"]) for r in data.where("y = 1").collect()}
    for r in out.where("synthetic").collect()[::20]:
        x = real[r["key"].split("#")[0]]
        # on the segment from its own row to some other positive row
        def off(o):
            u, v = (o[0] - x[0], o[1] - x[1]), (r["a"] - x[0], r["b"] - x[1])
            return abs(u[0] * v[1] - u[1] * v[0]) < 1e-9 and -1e-9 <= u[0] * v[0] + u[1] * v[1] <= u[0] ** 2 + u[1] ** 2 + 1e-9
        assert any(off(o) for o in real.values())
    again = ml.oversample(data.repartition(7), "y", ["a", "b"], "key")
    assert again.count() == out.count()


def test_oversample_many_equal_rows_and_single_row(spark):
    same = spark.createDataFrame([(str(i), int(i < 300), 1.0, 2.0) for i in range(1000)], "key string, y int, a double, b double")
    assert ml.oversample(same, "y", ["a", "b"], "key").count() == 1400
    one = spark.createDataFrame([("p", 1, 3.0)] + [(f"n{i}", 0, float(i)) for i in range(5)], "key string, y int, a double")
    made = ml.oversample(one, "y", ["a"], "key").where("synthetic").collect()
    assert len(made) == 4 and {r["a"] for r in made} == {3.0}


def test_new_rows_do_not_depend_on_partitions(spark):
    rng = random.Random(8)
    rows = [(f"k{i}", int(i % 10 == 0), rng.gauss(0, 1), rng.gauss(0, 5)) for i in range(2000)]
    df = spark.createDataFrame(rows, "key string, y int, a double, b double")
    real = {(r[2], r[3]) for r in rows}
    before, made = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in (8, 200):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            made.append(sorted((r.key, r.a, r.b) for r in ml.oversample(df, "y", ["a", "b"], "key").where("synthetic").collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert made[0] == made[1] and len(made[0]) == 1600
    assert not any((a, b) in real for _, a, b in made[0])  # every row has near rows, none is copied


def test_near_rows_are_found_across_slices(spark, monkeypatch):
    rows = [(f"k{i:04}", 1, float(i)) for i in range(300)] + [(f"n{i}", 0, 0.0) for i in range(900)]
    df = spark.createDataFrame(rows, "key string, y int, a double")
    whole = None
    for size in (4096, 25, 1):  # one slice, and slices as short as the reach allows
        monkeypatch.setattr(ml, "SLICE", size)
        got = sorted((r.key, r.a) for r in ml.oversample(df, "y", ["a"], "key", neighbours=4, reach=3).where("synthetic").collect())
        whole = whole or got
        assert got == whole and len(got) == 600
    for key, a in whole:
        assert 0 < abs(a - int(key[1:5])) <= 4


def test_a_model_that_cannot_be_refitted_scores_one_half(data):
    class Fragile:
        """Fits folds, but not the whole table."""

        def __init__(self, inner, most):
            self.inner, self.most = inner, most

        def fit(self, df):
            if df.count() > self.most:
                raise RuntimeError("no memory")
            return self.inner.fit(df)

    both = {**models(), "gbt": Fragile(ml.boosted_trees("y", rounds=2, depth=2), 500)}
    stack = ml.Stacking(both, ["a", "b"], "y", ["key"], folds=2).fit(data)
    assert list(stack.fitted) == ["lr"] and isinstance(stack.failed["gbt"], RuntimeError)
    assert [r[0] for r in stack.transform(data).select("gbt").distinct().collect()] == [0.5]
    with pytest.raises(RuntimeError):
        ml.Stacking({"gbt": Fragile(models()["gbt"], 500)}, ["a", "b"], "y", ["key"], folds=2).fit(data)


def test_loss_curve_ends_at_its_smallest_loss(data):
    model = ml.fit_boosted_trees(data, ["a", "b"], "y", "val", rounds=40, depth=2, step=0.3)
    curve = ml.loss_curve(model, data.where("val"), ["a", "b"], "y").orderBy("round").collect()
    assert len(curve) == model.getNumTrees < 40 and [r.chosen for r in curve] == [False] * (len(curve) - 1) + [True]
    assert curve[-1].loss == min(r.loss for r in curve) < curve[0].loss
