from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from leadtime.fixed_values import RISK_LABELS
from leadtime.operators import registry as reg
from leadtime.operators import scoring

SCHEMA = "model string, version int, stage string, role string, tags map<string,string>"


@pytest.fixture(scope="module")
def versions(spark):
    rows = [("m", v, "Production" if v in (2, 5) else "Staging" if v == 1 else "None", "x", {"v": str(v)}) for v in range(1, 15)]
    return spark.createDataFrame(rows, SCHEMA)


def test_latest_by_stage(versions):
    got = {r["stage"]: (r["version"], r["tags"]) for r in reg.latest_by_stage(versions).collect()}
    assert got == {"Production": (5, {"v": "5"}), "Staging": (1, {"v": "1"})}


def test_clean_up_spares_live_versions(versions):
    got = {r["version"]: r["stage"] for r in reg.clean_up(versions).collect()}
    assert got[1] == "Staging" and got[2] == "Production"
    assert {v for v, s in got.items() if s == "Archived"} == {3, 4}
    assert len(got) == 14


def test_promote_archives_the_former_champion(spark, versions):
    change = spark.createDataFrame([("m", 14)], "model string, new_version int")
    got = {r["version"]: (r["stage"], r["role"]) for r in reg.promote(versions, change).collect()}
    assert got[14] == ("Production", "champion") and got[5] == got[2] == ("Archived", "archived") and got[1][0] == "Staging"


def test_previous_version(versions):
    got = {r["version"]: r["previous_version"] for r in reg.with_previous_version(versions).collect()}
    assert got[1] is None and got[14] == 13


METRICS = "model string, version int, auc_roc double, recall double"


@pytest.mark.parametrize("auc, recall, promoted, reason", [
    (0.84, 1.0, False, "auc_below_floor"), (0.95, 0.1, True, "better_performance"), (0.86, 0.8, True, "better_performance"),
    (0.86, 0.7, False, "champion_better"), (None, 0.9, False, "auc_below_floor")])
def test_promotion(spark, auc, recall, promoted, reason):
    champion = spark.createDataFrame([("m", 1, 0.9, 0.8)], METRICS)
    r = reg.promotion_decision(spark.createDataFrame([("m", 2, auc, recall)], METRICS), champion).first()
    assert (r["promoted"], r["reason"]) == (promoted, reason)


def test_first_model_is_promoted(spark):
    new = spark.createDataFrame([("m", 2, 0.9, 0.1)], METRICS)
    r = reg.promotion_decision(new, new.limit(0)).first()
    assert (r["promoted"], r["reason"]) == (True, "first_champion")


@pytest.mark.parametrize("version, auc, recall, back, reason", [
    (2, 0.9, 0.74, True, "low_recall"), (2, 0.84, 0.9, True, "auc_below_champion"), (2, 0.86, 0.9, False, "ok"),
    (1, 0.5, 0.9, False, "ok"), (2, None, None, True, "no_metrics")])
def test_rollback(spark, version, auc, recall, back, reason):
    champion = spark.createDataFrame([("m", 1, 0.9, 0.8)], METRICS)
    r = reg.rollback_check(spark.createDataFrame([("m", version, auc, recall)], METRICS), champion).first()
    assert (r["rollback"], r["reason"]) == (back, reason)


def test_bands_and_bounds(spark):
    high, moderate, low = RISK_LABELS
    df = spark.createDataFrame([(1.7,), (0.25,), (0.2499,), (0.125,), (0.1249,), (-3.0,)], "s double")
    got = scoring.score_rows(df, F.col("s"), "4").collect()
    assert [r["risk"] for r in got] == [high, high, moderate, moderate, low, low]
    assert got[0]["probability"] == 1.0 and got[-1]["probability"] == 0.0 and got[0]["model_version"] == "v4"


def test_routing_is_stable_and_near_its_share(spark):
    df = spark.range(20000).withColumn("role", scoring.route(["id"]))
    n = df.where(F.col("role") == "challenger").count()
    assert 1700 < n < 2300
    assert df.exceptAll(spark.range(20000).repartition(11).withColumn("role", scoring.route(["id"]))).count() == 0
    assert spark.range(50).where(scoring.route(["id"], enabled=False) == "challenger").count() == 0
