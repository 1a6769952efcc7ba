from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from leadtime.fixed_values import REQUEST_FIELDS
from leadtime.operators.profile import leaderboard
from leadtime.operators.scaling import fit_scaler
from leadtime.sources import reports
from leadtime.sources.feature_table import FeatureTable
from leadtime.sources.requests import parse_requests, split_requests
from leadtime.sources.run_store import append_run, read_runs
from leadtime.sources.tables import read_dirty_csv, read_entity_years, read_event_tables, read_split, read_tables, write_table


def test_yearly_csv_files(spark, tmp_path):
    for year in (2008, 2009):
        (tmp_path / f"summary_{year}_part.csv").write_text(f"id,x\na,{year - 2000}\nb,\n")
    got = read_entity_years(spark, str(tmp_path), "id string, x int", "year").orderBy("year", "id").collect()
    assert [(r["id"], r["x"], r["year"]) for r in got] == [("a", 8, 2008), ("b", None, 2008), ("a", 9, 2009), ("b", None, 2009)]


def test_event_shards(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,amt\n1,2.5\n")
    (tmp_path / "b.csv").write_text("id,amt\n2,3.5\n3,\n")
    shards = {"carrier": [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]}
    assert read_event_tables(spark, shards, {"carrier": "id int, amt double"})["carrier"].count() == 3


def test_missing_inputs_are_all_named(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "there"))
    with pytest.raises(FileNotFoundError, match="a .*b "):
        read_tables(spark, {"ok": str(tmp_path / "there"), "a": str(tmp_path / "x"), "b": str(tmp_path / "y")})


def test_only_the_wanted_split_is_read(spark, tmp_path):
    df = spark.range(100).withColumn("split", F.when(F.col("id") < 90, "train").otherwise("val"))
    write_table(df, str(tmp_path / "t"), ["split"])
    val = read_split(spark, str(tmp_path / "t"), "val")
    assert val.count() == 10
    assert "PartitionFilters: [isnotnull(split" in val._jdf.queryExecution().executedPlan().toString()


def test_feature_table_versions(spark, tmp_path):
    table = FeatureTable(spark, str(tmp_path / "f"))
    assert table.latest() == 0
    with pytest.raises(FileNotFoundError):
        table.load()
    one = spark.createDataFrame([(1, 2.0), (2, 4.0)], "id int, x double")
    assert table.save(one, fit_scaler(one, ["x"]), "d1") == 1
    assert table.save(one.limit(1)) == 2
    got = {r["version"]: r for r in table.versions().collect()}
    assert (got[1]["previous_version"], got[2]["previous_version"]) == (None, 1)
    assert (got[1]["n_rows"], got[2]["n_rows"], got[1]["columns"], got[1]["dataset_version"]) == (2, 1, ["id", "x"], "d1")
    assert got[1]["dataset_hash"] != got[2]["dataset_hash"]
    assert table.load().count() == 1 and table.load(version=1).count() == 2
    assert table.load(["x", "new"]).first()["new"] == 0.0
    assert table.scaler(1).first()["x"]["mean"] == 3.0


def test_half_written_version_is_not_seen(spark, tmp_path):
    table = FeatureTable(spark, str(tmp_path / "f"))
    table.save(spark.range(2).toDF("x"))
    spark.range(9).toDF("x").write.parquet(str(tmp_path / "f/rows/lost/data"))  # data without its record
    assert table.latest() == 1 and table.load().count() == 2
    assert table.save(spark.range(5).toDF("x")) == 2 and table.load().count() == 5


def test_saves_at_once_give_a_version_each(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(4) as pool:
        made = list(pool.map(lambda n: FeatureTable(spark, str(tmp_path / "f")).save(spark.range(n).toDF("x")), range(1, 9)))
    assert sorted(made) == list(range(1, 9))
    table = FeatureTable(spark, str(tmp_path / "f"))
    assert {v: table.load(version=v).count() for v in made} == dict(zip(made, range(1, 9)))
    assert [r["previous_version"] for r in table.versions().orderBy("version").collect()] == [None, *range(1, 8)]
    assert table.clean_up(3) == [1, 2, 3, 4, 5] and table.load().count() >= 1
    with pytest.raises(FileNotFoundError):
        table.load(version=99)


def test_dirty_lines_are_kept_apart(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1,20080101,2.5\nx,20080102,3.5\n3,junk,4.5\n4,20080104\n5,20080105,abc\n\n6,20080106,6.5,more\n")
    rows, bad = read_dirty_csv(spark, [str(tmp_path / "a.csv")], "id int, day string, amt double")
    assert sorted(tuple(r) for r in rows.collect()) == [(1, "20080101", 2.5), (3, "junk", 4.5)]
    assert sorted(r["line"] for r in bad.collect()) == ["4,20080104", "5,20080105,abc", "6,20080106,6.5,more", "x,20080102,3.5"]
    assert rows.select("id").count() == 2  # the verdict on a line does not depend on the columns read


def test_reports(spark, tmp_path):
    schema = "drift_detected boolean, n_drifted long, top array<struct<feature:string,psi:double>>"
    path = str(tmp_path / "r")
    assert reports.read_report(spark, path, schema, {"drift_detected": False}).first()["drift_detected"] is False
    assert reports.read_report(spark, path, schema).count() == 0
    report = spark.createDataFrame([(True, 2, [("a", 0.5)])], schema)
    reports.write_report(report, path)
    reports.write_report(report, path)
    assert reports.read_report(spark, path, schema).first() == report.first()
    for run in ("1", "2"):
        reports.append_history(reports.with_run(report, run), str(tmp_path / "h"))
        reports.archive_report(report, str(tmp_path / "arch"), run)
        reports.archive_report(report, str(tmp_path / "arch"), run)
    assert spark.read.json(str(tmp_path / "h")).count() == 2
    assert spark.read.json(str(tmp_path / "arch")).count() == 2


def test_run_store(spark, tmp_path):
    for run, auc in (("r1", ["100 0.5 0", "200 0.7 1"]), ("r2", ["100 0.9 0"])):
        for kind, name, text in (("metrics", "auc", "\n".join(auc)), ("params", "depth", "5"), ("tags", "model name", "a b")):
            place = tmp_path / "exp" / run / kind
            os.makedirs(place)
            (place / name.replace(" ", ".")).write_text(text)
    rows = read_runs(spark, str(tmp_path / "exp"))
    assert rows.count() == 7
    board = leaderboard(rows.where("kind = 'metrics'"), "run_id", "name", "value", "ts", ["auc"])
    assert {r["run_id"]: r["auc"] for r in board.collect()} == {"r1": "0.7", "r2": "0.9"}
    assert rows.where("kind = 'tags'").first()["value"] == "a b"
    log = str(tmp_path / "log")
    append_run(rows.select("run_id", "kind", "name", "value"), log)
    append_run(rows.select("run_id", "kind", "name", "value"), log)
    assert spark.read.parquet(log).count() == 14


def test_requests(spark):
    good = {"AGE": 70, "SEXE_ENC": 1, "RACE_ENC": 2, "GROUPE_AGE_ENC": 1}
    bodies = [good, {**good, "AGE": 121}, {k: v for k, v in good.items() if k != "AGE"}, {**good, "SP_CHF": 2, "COUT_TOTAL": -1}]
    df = spark.createDataFrame([(i, json.dumps(b)) for i, b in enumerate(bodies)], "i int, body string")
    ok, bad = split_requests(parse_requests(df, "body", keep=["i"]))
    row = ok.first()
    assert ok.count() == 1 and row["BENE_ESRD_IND"] == 0 and len(row) == len(REQUEST_FIELDS) + 1
    assert {r["i"]: r["faults"] for r in bad.collect()} == {
        1: ["AGE is above 120"], 2: ["AGE is required"], 3: ["SP_CHF is above 1", "COUT_TOTAL is below 0"]}
