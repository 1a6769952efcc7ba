from __future__ import annotations

import math
import random
import statistics
import struct

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from leadtime.operators import ensembles as en
from leadtime.operators import evaluation as ev
from leadtime.operators.prefix import exact_quantile, rank_values, with_order_key
from leadtime.operators.profile import column_profile

# Counts with their precision, recall and F1 (threshold, tn, fp, fn, tp, precision, recall, f1)
KNOWN = [
    (0.01, 1407, 25407, 0, 2696, 0.09593281856029605, 1.0, 0.17507061917594727),
    (0.25, 20100, 6714, 43, 2653, 0.2832283548628163, 0.9840504451038575, 0.43985741523667415),
    (0.95, 26709, 105, 2533, 163, 0.6082089552238806, 0.06045994065281899, 0.10998650472334683),
    (0.25, 23836, 3043, 104, 2092, 0.40740019474196687, 0.9526411657559198, 0.570727049515755),
]


def test_rates_match_known_counts(spark):
    df = spark.createDataFrame([r[:5] for r in KNOWN], "threshold double, tn long, fp long, fn long, tp long")
    for got, want in zip(ev.with_rates(df).collect(), KNOWN):
        assert (got["precision"], got["recall"], got["f1"]) == pytest.approx(want[5:], abs=1e-12)


def test_class_report_matches_known_counts(spark):
    rows = [(0, 0.0)] * 23836 + [(0, 1.0)] * 3043 + [(1, 0.0)] * 104 + [(1, 1.0)] * 2092
    got = {r["class"]: r for r in ev.class_report(spark.createDataFrame(rows, "y int, p double"), "y", "p").collect()}
    assert got["0"]["precision"] == pytest.approx(0.995655806182122)
    assert got["macro avg"]["f1"] == pytest.approx(0.7544006958946571)
    assert got["weighted avg"]["precision"] == pytest.approx(0.9512255629242516)
    assert got["weighted avg"]["recall"] == pytest.approx(0.8917626827171109)


def test_zero_division_is_zero(spark):
    df = ev.with_rates(spark.createDataFrame([(0, 0, 5, 0)], "tp long, fp long, tn long, fn long")).first()
    assert (df["precision"], df["recall"], df["f1"]) == (0.0, 0.0, 0.0)


@pytest.fixture(scope="module")
def scored(spark):
    """A third of all scores are the same, another third lie very close together."""
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        y = int(rng.random() < 0.3)
        p = 0.5 if i % 3 == 0 else 1e-9 * rng.random() + (1e-10 if y else 0) if i % 3 == 1 else min(1.0, rng.random() * 0.8 + 0.2 * y)
        rows.append((i, y, p, "a" if i % 2 else None))
    return spark.createDataFrame(rows, "id long, y int, p double, g string"), rows


def brute_auc(rows):
    pos, neg = [p for y, p in rows if y == 1], [p for y, p in rows if y == 0]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


def test_auc_brute_and_built_in(scored):
    df, rows = scored
    want = brute_auc([(r[1], r[2]) for r in rows])
    assert ev.roc_auc(df, "y", "p").first()["auc_roc"] == pytest.approx(want, abs=1e-12)
    built_in = BinaryClassificationEvaluator(rawPredictionCol="p", labelCol="y", numBins=0).evaluate(df)
    assert built_in == pytest.approx(want, abs=1e-9)
    for bounds in ([], [0.5], [1e-10, 0.2, 0.9]):
        assert ev.roc_auc(df, "y", "p", bounds=bounds).first()["auc_roc"] == pytest.approx(want, abs=1e-12)


def test_groups_keep_null(scored):
    df, rows = scored
    got = {r["g"]: r["auc_roc"] for r in ev.metrics_at(df, "y", "p", 0.5, ["g"]).collect()}
    for g in ("a", None):
        assert got[g] == pytest.approx(brute_auc([(r[1], r[2]) for r in rows if r[3] == g]), abs=1e-12)


def test_one_class_has_no_auc(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.7)], "y int, p double")
    assert ev.roc_auc(df, "y", "p").first()["auc_roc"] is None
    assert ev.trial_score(df, "y", "p", metric="auc").first()["trial_score"] == 0.0
    assert ev.performance_check(df.limit(0), "y", "p", 0.5).first()["model_available"] is False


def test_curve_and_sweep_agree_with_counting(scored):
    df, rows = scored
    curve = ev.pr_curve(df, "y", "p").collect()
    assert len(curve) == len({r[2] for r in rows})
    for c in curve[::200]:
        t = c["threshold"]
        assert (c["tp"], c["fp"]) == (sum(r[1] == 1 and r[2] >= t for r in rows), sum(r[1] == 0 and r[2] >= t for r in rows))
        assert c["tp"] + c["fp"] + c["tn"] + c["fn"] == len(rows)
    for s in ev.threshold_sweep(df, "y", "p", by=["g"]).collect():
        mine = [r for r in rows if r[3] == s["g"]]
        assert s["tp"] == sum(r[1] == 1 and r[2] >= s["threshold"] for r in mine)
        assert s["fn"] == sum(r[1] == 1 and r[2] < s["threshold"] for r in mine)


def ran(df):
    """The plan that ran, subqueries included, without the plans there were before it ran."""
    out, skip = [], None
    for line in df._jdf.queryExecution().executedPlan().toString().split("\n"):
        at = len(line) - len(line.lstrip(" :+-"))
        if skip is not None and at >= skip:
            continue
        skip = at if "== Initial Plan" in line else None
        if skip is None:
            out.append(line)
    return "\n".join(out)


def test_curve_aggregates_the_scores_once(spark, scored, tmp_path):
    scored[0].write.parquet(str(tmp_path / "p"))
    curve = ev.pr_curve(spark.read.parquet(str(tmp_path / "p")), "y", "p")
    curve.collect()
    final = ran(curve)
    assert final.count("FileScan") == 1 and "ReusedExchange" in final


def test_grouped_curve_keeps_the_null_group(scored):
    df, rows = scored
    curve = ev.pr_curve(df, "y", "p", ["g"]).collect()
    for g in ("a", None):
        mine = [r for r in rows if r[3] == g]
        assert sum(c["g"] == g for c in curve) == len({r[2] for r in mine})
        top = max((c for c in curve if c["g"] == g), key=lambda c: c["tp"] + c["fp"])
        assert (top["tp"], top["fp"], top["fn"]) == (sum(r[1] for r in mine), sum(1 - r[1] for r in mine), 0)


def test_chosen_thresholds(scored):
    df, rows = scored
    curve = ev.pr_curve(df, "y", "p")
    t = ev.threshold_for_recall(curve, 0.6).first()["threshold"]
    total = sum(r[1] for r in rows)
    reach = [p for p in {r[2] for r in rows} if sum(r[1] == 1 and r[2] >= p for r in rows) / total >= 0.6]
    assert t == max(reach)
    got = {r["target"]: r for r in ev.thresholds_for_precision(curve, [0.3, 1.01]).collect()}
    assert got[0.3]["achievable"] and got[0.3]["predicted_positive"] >= 50
    assert not got[1.01]["achievable"] and got[1.01]["threshold"] is None


def test_candidate_selection(spark):
    df = spark.createDataFrame([("a", 0.95, 0.9), ("b", 0.9, 0.96), ("c", 0.89, 0.99), ("d", 0.5, 1.0)],
                               "name string, auc_roc double, recall double")
    assert ev.select_candidate(df, "name").first()["name"] == "c"
    assert ev.select_candidate(df, "name", 0.99).count() == 0


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.99, 1.0])
def test_exact_quantile(spark, q):
    rng = random.Random(9)
    data = [rng.choice([7.0, rng.random(), rng.random() * 100]) for _ in range(1501)]
    df = spark.createDataFrame([(x,) for x in data] + [(None,), (float("nan"),)], "x double")
    spot = (len(data) - 1) * q
    low, high = sorted(data)[int(spot)], sorted(data)[min(int(spot) + 1, len(data) - 1)]
    got = exact_quantile(df, "x", q).first()["value"]
    assert got == pytest.approx(low + (high - low) * (spot - int(spot)))


def test_exact_quantile_of_nothing(spark):
    assert exact_quantile(spark.createDataFrame([], "x double"), "x").first()["value"] is None


def test_vote_weights(spark):
    df = spark.createDataFrame([(0.5, 0.5), (0.2, 0.9)], "a double, b double")
    got = en.soft_vote(df, ["a", "b"]).collect()
    assert [r["predicted"] for r in got] == [0, 1]
    for bad in ([1.0], [-1.0, 2.0], [0.0, 0.0]):
        with pytest.raises(ValueError):
            en.soft_vote(df, ["a", "b"], bad)
    assert en.fill_missing_models(df, ["a", "z"]).first()["z"] == 0.5


def test_grid_is_complete():
    grid = en.simplex_grid(3, 4)
    assert len(grid) == 15 and all(abs(sum(g) - 1) < 1e-12 for g in grid) and len(set(grid)) == 15


def test_weight_search_brute(scored):
    df, rows = scored
    both = df.withColumn("p2", 1 - F.col("p"))
    grid = en.simplex_grid(2, 5)
    best = en.search_weights(both, "y", ["p", "p2"], grid, "recall").first()
    total = sum(r[1] for r in rows)
    recall = [sum(r[1] == 1 and round(a * r[2] + b * (1 - r[2]), 12) >= 0.5 for r in rows) / total for a, b in grid]
    assert best["objective"] == pytest.approx(max(recall)) and best["weight_id"] == recall.index(max(recall))


def test_folds_are_even_and_repeatable(spark):
    df = spark.range(1003).select("id", F.when(F.col("id") < 900, 1).when(F.col("id") < 1000, 0).alias("y"))
    a = en.assign_folds(df, "y", ["id"], 4)
    assert a.count() == 1003  # rows without a label are kept too
    for y in (0, 1):
        sizes = [r["count"] for r in a.where(F.col("y") == y).groupBy("fold").count().collect()]
        assert len(sizes) == 4 and max(sizes) - min(sizes) <= 1
    b = en.assign_folds(df.repartition(7), "y", ["id"], 4)
    assert a.exceptAll(b).count() == 0


def doubles(rng, n):
    """Values of every size and sign, the edges of each binary exponent, and many equal ones."""
    out = [v for v in (struct.unpack("d", struct.pack("Q", rng.getrandbits(64)))[0] for _ in range(n)) if v == v]
    out += [x for e in range(-1074, 1024) for x in (2.0 ** e, -math.nextafter(2.0 ** e, 0), math.nextafter(2.0 ** e, math.inf))]
    return out + [0.0, -0.0, math.inf, -math.inf, 5e-324, 1.7976931348623157e308, -1.7976931348623157e308] + [1.5] * 500 + [-7.0] * 300


def test_order_key_is_the_order_of_doubles(spark):
    for r in with_order_key(spark.createDataFrame([(v,) for v in doubles(random.Random(3), 3000)], "v double"), "v", "k").collect():
        number = struct.unpack("q", struct.pack("d", abs(r.v)))[0]
        assert r.k == (-number if r.v < 0 else number)
    odd = with_order_key(spark.createDataFrame([(None,), (math.nan,)], "v double"), "v", "k").collect()
    assert [r.k for r in odd] == [None, None]


@pytest.mark.parametrize("partitions", [8, 200])
def test_ranks_are_exact_for_all_groups_at_once(spark, partitions):
    rng = random.Random(11)
    rows = [(g, v) for g, n in (("a", 2000), (None, 50), ("one", 0)) for v in (doubles(rng, n) if n else [3.5])] + [("a", None), ("none", None), ("a", math.nan)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        wanted = {"first": "0", "q1": "floor(_n * 0.25D)", "middle": "floor((_n - 1) / 2)", "last": "_n - 1"}
        got = {r.g: r for r in rank_values(df, "v", wanted, ["g"]).collect()}
        whole = rank_values(df, "v", wanted).first()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for r, values in [(got[g], [v for h, v in rows if h == g and v is not None and v == v]) for g in ("a", None, "one")] + [(whole, [v for _, v in rows if v is not None and v == v])]:
        values.sort()
        n = len(values)
        assert (r.n, r["first"], r.q1, r.middle, r["last"]) == (n, values[0], values[n // 4], values[(n - 1) // 2], values[-1])
    assert set(got) == {"a", None, "one"}
    assert exact_quantile(df, "v", 0.5, "m", ["g"]).count() == 3


def test_weights_count_a_row_several_times(spark):
    df = spark.createDataFrame([(1.0, 2), (5.0, 1), (9.0, 7)], "v double, w long")
    r = rank_values(df, "v", {f"r{i}": str(i) for i in range(10)}, weight="w").first()
    assert [r[f"r{i}"] for i in range(10)] == [1.0, 1.0, 5.0] + [9.0] * 7


@pytest.mark.parametrize("partitions", [8, 200])
def test_column_profile_is_exact(spark, partitions):
    rng = random.Random(2)
    rows = [(i % 3 == 0, rng.choice([None, 1e9 + rng.random(), 1e9 + 0.5]), rng.gauss(0, 1), None) for i in range(900)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = {(r.side, r.feature): r for r in column_profile(spark.createDataFrame(rows, "side boolean, a double, b double, c double"), ["a", "b", "c"], "side").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for (side, feature), r in got.items():
        mine = [x["abc".index(feature) + 1] for x in rows if x[0] == side]
        held = sorted(v for v in mine if v is not None)
        assert (r.n_rows, r.n_distinct) == (len(mine), len(set(held))) and r.null_share == pytest.approx(1 - len(held) / len(mine))
        if held:
            n = len(held)
            assert (r["min"], r["max"], r.q25, r.q50, r.q75) == (held[0], held[-1], *(held[math.ceil(n * q) - 1] for q in (0.25, 0.5, 0.75)))
            assert r["mean"] == pytest.approx(statistics.fmean(held)) and r["std"] == pytest.approx(statistics.pstdev(held), rel=1e-6)
        else:
            assert r.q50 is None and r["mean"] is None and r["std"] is None
    assert len(got) == 6


def test_building_a_curve_or_a_rank_starts_no_job(spark, scored):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "building")
    try:
        ev.roc_auc(scored[0], "y", "p")
        ev.pr_curve(scored[0], "y", "p", ["g"])
        exact_quantile(scored[0], "p")
        column_profile(scored[0], ["p"], "g")
        assert list(tracker.getJobIdsForGroup("building")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
