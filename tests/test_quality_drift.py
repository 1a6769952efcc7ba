from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadtime.operators import drift, quality
from leadtime.operators.scaling import apply_scaler, fit_scaler

RULES = {"flags": {"cols": ["f", "g"], "dtype": "int", "min": 0, "max": 1}, "numbers": {"cols": ["x"], "dtype": "float", "min": 0}}


def test_issues_of_a_bad_table(spark):
    rows = [(0.5, -1.0, None, "k")] * 3 + [(2.0, 4.0, float("nan"), "k")] * 4 + [(1.0, 4.0, 1.0, "k")] * 3
    df = spark.createDataFrame(rows, "f double, x double, n double, c string")
    got = {(r["check"], r["column"], r["severity"]) for r in quality.find_issues(df, RULES).collect()}
    assert got == {("dtype", "f", "warning"), ("range", "f", "error"), ("range", "x", "error"), ("missing_column", "g", "error"),
                   ("missing_values", "n", "error"), ("constant", "n", "warning"), ("constant", "c", "warning")}
    report = quality.quality_report(df, RULES, "t")
    r = report.first()
    assert (r["n_errors"], r["n_warnings"], r["passed"], r["quality_score"]) == (4, 3, False, 25)
    with pytest.raises(ValueError, match="quality gate"):
        quality.gate(report)


def test_clean_table_passes(spark):
    df = spark.createDataFrame([(0, 1, 2.5), (1, 0, 3.5)], "f int, g int, x double")
    report = quality.quality_report(df, RULES, "t")
    assert report.first()["quality_score"] == 100 and quality.gate(report) is report


def test_score_never_below_zero(spark):
    issues = spark.createDataFrame([("c", str(i), "error", "m") for i in range(9)], "check string, column string, severity string, message string")
    assert quality.quality_score(issues).first()["quality_score"] == 0


@pytest.mark.parametrize("ys, null, outside, unbalanced", [
    ([0, 1, 1, 0], 0, 0, False), ([0, 0, 1, None, 2], 1, 1, False), ([0] * 200 + [1], 0, 0, True)])
def test_target(spark, ys, null, outside, unbalanced):
    r = quality.check_target(spark.createDataFrame([(y,) for y in ys], "y int"), "y").first()
    assert (r["n_null"], r["n_outside"], r["unbalanced"]) == (null, outside, unbalanced)
    assert r["passed"] == (null == 0 and outside == 0)


def test_psi_of_hand_made_counts(spark):
    """Values 0..9 fall into ten bins of one value each, so shares are counts over totals and the index adds up by hand."""
    ref = [0] * 50 + [9] * 50                          # half in the first bin, half in the last
    cur = [0] * 25 + [9] * 75                          # a quarter and three quarters
    flat = [3] * 100                                   # one value on both sides
    df = spark.createDataFrame([("ref", float(x), 3.0, float(x)) for x in ref] + [("cur", float(x), 3.0, 4.5) for x in cur],
                               "side string, a double, flat double, moved double")
    got = {r["feature"]: r["psi"] for r in drift.population_stability(df, ["a", "flat", "moved"]).collect()}
    assert len(flat) == 100 and got["flat"] == 0.0
    assert got["a"] == pytest.approx((0.25 - 0.5) * math.log(0.5) + (0.75 - 0.5) * math.log(1.5), abs=1e-12)
    # all current rows lie in the sixth bin, where the reference has none: empty shares count as one in ten thousand
    assert got["moved"] == pytest.approx(2 * (1e-4 - 0.5) * math.log(1e-4 / 0.5) + (1 - 1e-4) * math.log(1 / 1e-4), abs=1e-12)


def test_drift_report_of_shifted_columns(spark):
    rng = np.random.default_rng(1)
    ref = {"a": rng.normal(0, 1, 4000), "b": rng.integers(0, 3, 4000).astype(float), "c": np.full(4000, 2.0), "d": rng.random(4000)}
    cur = {"a": rng.normal(0.7, 1.2, 2500), "b": rng.integers(0, 3, 2500).astype(float), "c": np.full(2500, 2.0), "d": rng.random(2500) + 3}
    rows = [("ref", *[float(ref[c][i]) for c in "abcd"]) for i in range(4000)] + [("cur", *[float(cur[c][i]) for c in "abcd"]) for i in range(2500)]
    df = spark.createDataFrame(rows, "side string, a double, b double, c double, d double")
    got = {r["feature"]: r["psi"] for r in drift.population_stability(df, list("abcd")).collect()}
    assert got["c"] == 0.0 and got["b"] < 0.01 < 0.2 < got["a"] < got["d"]
    report = drift.drift_summary(drift.population_stability(df, list("abcd"))).first()
    assert report["n_drifted"] == 2 and report["drift_pct"] == 50.0 and report["drift_severity"] == "CRITICAL"
    assert [x["feature"] for x in report["top5_psi"]] == [k for k, _ in sorted(got.items(), key=lambda kv: (-kv[1], kv[0]))][:2] + \
        [x["feature"] for x in report["top5_psi"]][2:]


@pytest.mark.parametrize("n, pct, name", [(0, 0.0, "NONE"), (1, 15.0, "MODERATE"), (2, 15.1, "HIGH"), (2, 30.0, "HIGH"), (9, 30.1, "CRITICAL")])
def test_severity(spark, n, pct, name):
    df = spark.createDataFrame([(n, pct)], "n long, p double")
    assert df.select(drift.severity(F.col("n"), F.col("p")).alias("s")).first()["s"] == name


def test_known_summary(spark):
    """10 of 28 drifted features are 35.7 percent and CRITICAL."""
    psi = spark.createDataFrame([(f"f{i}", 0.5 if i < 10 else 0.1) for i in range(28)], "feature string, psi double")
    r = drift.drift_summary(psi).first()
    assert (r["n_drifted"], r["drift_pct"], r["drift_severity"]) == (10, 35.7, "CRITICAL")


def test_retrain_decisions(spark):
    def report(hit, sev):
        return spark.createDataFrame([(hit, sev, 3, 0.5)], "drift_detected boolean, drift_severity string, n_drifted long, max_psi double")

    assert [drift.retrain_on_severity(report(*x)).first()["retrain"] for x in
            ((True, "HIGH"), (True, "MODERATE"), (True, "NONE"), (False, "CRITICAL"))] == [True, False, False, False]
    perf = "model_available boolean, recall double"
    good, weak, none = [spark.createDataFrame(rows, perf) for rows in ([(True, 0.9)], [(True, 0.5)], [])]
    assert drift.retrain_decision(report(False, "NONE"), good).first()["retrain"] is False
    assert drift.retrain_decision(report(False, "NONE"), weak).first()["reasons"] == ["recall 0.5000 < 0.85"]
    r = drift.retrain_decision(report(True, "HIGH").limit(0), none).first()
    assert (r["retrain"], r["reasons"]) == (True, ["no production model available"])
    assert len(drift.retrain_decision(report(True, "HIGH"), none).first()["reasons"]) == 2


def test_scaler_uses_population_moments(spark):
    rng = random.Random(2)
    xs = [rng.gauss(5, 3) for _ in range(50)]
    df = spark.createDataFrame([(x, 4.0, i) for i, x in enumerate(xs)], "x double, flat double, i int")
    out = apply_scaler(df, fit_scaler(df, ["x", "flat"])).orderBy("i").collect()
    mean = sum(xs) / 50
    std = math.sqrt(sum((x - mean) ** 2 for x in xs) / 50)
    assert [r["x"] for r in out] == pytest.approx([(x - mean) / std for x in xs])
    assert {r["flat"] for r in out} == {0.0}
    part = fit_scaler(df, ["x"], F.col("i") < 10).first()["x"]
    assert part["mean"] == pytest.approx(sum(xs[:10]) / 10)


def test_a_label_that_is_no_number_counts_as_null(spark):
    r = quality.check_target(spark.createDataFrame([(1.0,), (0.0,), (float("nan"),)], "y double"), "y").first()
    assert (r["n_null"], r["n_outside"], r["positive_rate"], r["passed"], r["unbalanced"]) == (1, 0, 0.5, False, False)
