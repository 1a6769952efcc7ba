"""Raw files, stored tables, versions and reports: written from the given tables and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadtime.operators import drift
from leadtime.operators.cleaning import union_all
from leadtime.operators.scaling import fit_scaler
from leadtime.plans.bindings import KEY, OBS_YEARS, Tables
from leadtime.plans.catalog import query
from leadtime.plans.catalog import sql as q
from leadtime.session import scratch_path
from leadtime.sources import reports
from leadtime.sources.feature_table import FeatureTable
from leadtime.operators.profile import leaderboard
from leadtime.sources.requests import split_requests
from leadtime.sources.run_store import read_runs, write_run
from leadtime.sources.tables import read_entity_years, read_event_tables, write_table


@query("s1_entity_csv_scan", f"WITH {q.COHORT} SELECT entity, year(obs_date)::INTEGER AS year, c_acctbal "
       "FROM cohort JOIN customer ON entity = c_custkey")
def s1(t: Tables):
    root = scratch_path(t.spark, "csv")
    rows = t.customer.select(F.col("c_custkey").alias(KEY), "c_acctbal")
    for year in OBS_YEARS:
        rows.write.option("header", True).csv(f"{root}/summary_{year}_sample")
    return read_entity_years(t.spark, f"{root}/*", "entity bigint, c_acctbal double", "year").select(KEY, "year", "c_acctbal")


@query("s2_event_csv_scan", "SELECT l_orderkey, l_partkey, l_returnflag FROM lineitem")
def s2(t: Tables):
    root = scratch_path(t.spark, "csv")
    for shard in ("A", "N", "R"):
        (t.lineitem.where(F.col("l_returnflag") == shard).select("l_orderkey", "l_partkey", "l_returnflag")
         .write.option("header", True).csv(f"{root}/carrier_{shard}"))
    schema = "l_orderkey bigint, l_partkey bigint, l_returnflag string"
    tables = read_event_tables(t.spark, {"carrier": [f"{root}/carrier_{x}" for x in ("A", "N", "R")]}, {"carrier": schema})
    return tables["carrier"]


@query("s8_parquet_sink", "SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1")
def s8(t: Tables):
    path = scratch_path(t.spark, "table")
    write_table(t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus"), path, ["o_orderstatus"])
    return t.spark.read.parquet(path).groupBy("o_orderstatus").agg(
        F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("s9_latest_version", "SELECT o_orderkey, o_totalprice, 0.0::DOUBLE AS not_there FROM orders")
def s9(t: Tables):
    table = FeatureTable(t.spark, scratch_path(t.spark, "features"))
    for states in (["F"], ["F", "O"], ["F", "O", "P"]):  # the table as it grows
        table.save(t.orders.where(F.col("o_orderstatus").isin(states)).select("o_orderkey", "o_totalprice"))
    return table.load(["o_orderkey", "o_totalprice", "not_there"])


@query("k4_version_records", """
SELECT 1 AS version, -1 AS previous_version, count(*) AS n_rows, 2 AS n_columns FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 2, 1, count(*), 2 FROM orders WHERE o_orderstatus IN ('F', 'O')
UNION ALL SELECT 3, 2, count(*), 2 FROM orders""")
def k4(t: Tables):
    table = FeatureTable(t.spark, scratch_path(t.spark, "features"))
    for states in (["F"], ["F", "O"], ["F", "O", "P"]):
        rows = t.orders.where(F.col("o_orderstatus").isin(states)).select("o_orderkey", "o_totalprice")
        table.save(rows, fit_scaler(rows, ["o_totalprice"]))
    return table.versions().select("version", "previous_version", "n_rows", "n_columns").fillna(-1)


_REPORT = "run string, n_features bigint, n_drifted bigint, max_psi double, drift_severity string"


def yearly_report(t: Tables, year: int):
    """Drift of the orders of a year against 1995."""
    day = F.col("o_orderdate")

    def of(y):
        return (day >= F.lit(f"{y}-01-01").cast("date")) & (day < F.lit(f"{y + 1}-01-01").cast("date"))

    sides = drift.drift_sides(t.orders, of(1995), of(year), ["o_totalprice"])
    report = drift.drift_summary(drift.population_stability(sides, ["o_totalprice"]))
    return reports.with_run(report, str(year))


_YEARS = (1996, 1997, 1998, 1999, 2000, 2001)


_HISTORY = "WITH y(run) AS (VALUES " + ", ".join(f"('{y}')" for y in _YEARS) + """),
b AS (SELECT run, min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM y JOIN orders
  ON year(o_orderdate) IN (1995, run::INTEGER) GROUP BY 1),
h AS (SELECT run, """ + " + ".join(f"(o_totalprice >= lo + {i}.0 * ((hi - lo) / 10.0))::INTEGER" for i in range(1, 10)) + """ AS bin,
  count(*) FILTER (WHERE year(o_orderdate) = 1995) AS n_ref, count(*) FILTER (WHERE year(o_orderdate) <> 1995) AS n_cur
  FROM b JOIN orders ON year(o_orderdate) IN (1995, run::INTEGER) GROUP BY 1, 2),
s AS (SELECT run, least(greatest(n_ref / sum(n_ref) OVER w, 0.0001), 1.0) AS e, least(greatest(n_cur / sum(n_cur) OVER w, 0.0001), 1.0) AS a
  FROM h WINDOW w AS (PARTITION BY run))
SELECT run, 1::BIGINT AS n_features, round(sum((a - e) * ln(a / e)), 4) AS max_psi FROM s GROUP BY 1"""


@query("s11_report_sink", f"SELECT * FROM ({_HISTORY}) WHERE run = '2001'")
def s11(t: Tables):
    path = scratch_path(t.spark, "report")
    for year in _YEARS:  # each report replaces the one before
        reports.write_report(yearly_report(t, year), path)
    return reports.read_report(t.spark, path, _REPORT).select("run", "n_features", "max_psi")


_MANY = "(SELECT quantile_disc(n, 0.5) FROM (SELECT count(*) AS n FROM orders GROUP BY year(o_orderdate)))"


@query("s13_absent_report", f"""
WITH y AS (SELECT year(o_orderdate)::INTEGER AS year, count(*) AS n_orders, sum((o_orderstatus = 'F')::INTEGER) / count(*) AS recall
  FROM orders GROUP BY 1), r AS (SELECT *, n_orders >= {_MANY} AS reported FROM y)
SELECT year, n_orders, reported, NOT reported OR recall < 0.85 AS retrain, CASE WHEN NOT reported THEN 'no production model available'
  WHEN recall < 0.85 THEN 'recall ' || printf('%.4f', recall) || ' < 0.85' ELSE '' END AS reasons FROM r""")
def s13(t: Tables):
    """Every year's decision from its stored report; years with few orders have none, and the default decides."""
    place, schema = scratch_path(t.spark, "performance"), "model_available boolean, recall double"
    years = t.orders.groupBy(F.year("o_orderdate").alias("year")).agg(
        F.count("*").alias("n_orders"), F.avg((F.col("o_orderstatus") == "F").cast("double")).alias("recall")).orderBy("year").collect()
    many = sorted(r["n_orders"] for r in years)[(len(years) + 1) // 2 - 1]
    none = reports.read_report(t.spark, f"{place}/drift", "drift_detected boolean, n_drifted bigint, max_psi double", {"drift_detected": False})
    out = []
    for r in years:  # a year each, as the monthly job would run
        path = f"{place}/run={r['year']}"
        if r["n_orders"] >= many:
            reports.write_report(t.spark.createDataFrame([(True, r["recall"])], schema), path)
        stored = reports.read_report(t.spark, path, schema, {"model_available": False})
        reported = stored.agg(F.bool_or("model_available").alias("b")).scalar()
        out.append(drift.retrain_decision(none, stored).select(
            F.lit(r["year"]).alias("year"), F.lit(r["n_orders"]).cast("bigint").alias("n_orders"), reported.alias("reported"), "retrain",
            F.concat_ws("|", "reasons").alias("reasons")))
    return union_all(out)


@query("s14_report_archive", _HISTORY)
def s14(t: Tables):
    path = scratch_path(t.spark, "archive")
    for year in _YEARS:
        reports.archive_report(yearly_report(t, year).drop("run"), path, str(year))
    stored = t.spark.read.schema(_REPORT).json(path)  # the run label is the directory
    return stored.select(F.col("run").cast("string").alias("run"), "n_features", "max_psi")


@query("s12_report_history", _HISTORY)
def s12(t: Tables):
    path = scratch_path(t.spark, "history")
    for year in _YEARS:
        reports.append_history(yearly_report(t, year), path)
    return reports.read_report(t.spark, path, _REPORT).select("run", "n_features", "max_psi")


@query("s16_request_checks", """
SELECT event_id, concat_ws('; ', CASE WHEN event_type = 'error' THEN 'age is required' WHEN value > 120 THEN 'age is above 120' END,
  CASE WHEN json_extract(props, '$.k')::INTEGER < 5 THEN 'k is below 5' END) AS faults FROM events
WHERE event_type = 'error' OR value > 120 OR json_extract(props, '$.k')::INTEGER < 5""")
def s16(t: Tables):
    fields = [("age", "double", None, 0, 120), ("k", "int", 0, 5, None)]
    rows = t.events.select("event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("age"),
                           F.from_json("props", "k int")["k"].alias("k"))
    _, bad = split_requests(rows, fields)
    return bad.select("event_id", F.concat_ws("; ", "faults").alias("faults"))


@query("s15_run_leaderboard", """
WITH m AS (SELECT year(o_orderdate)::INTEGER AS y, o_orderpriority AS p, count(*)::DOUBLE AS n, sum((o_orderstatus = 'F')::INTEGER) / count(*) AS share
  FROM orders GROUP BY 1, 2), steps AS (SELECT *, row_number() OVER (PARTITION BY p ORDER BY y) AS step FROM m),
last AS (SELECT p, arg_max(share, y) AS recall, arg_max(n, y) AS n_orders, count(*) AS n_steps FROM steps GROUP BY 1)
SELECT substr(p, 1, 1) AS run_id, p AS name, round(recall, 6) AS recall, n_orders, n_steps FROM last""")
def s15(t: Tables):
    """A run per order priority, a step per year, written as run files and read back to one row a run."""
    root = scratch_path(t.spark, "runs")
    rows = t.orders.groupBy(F.col("o_orderpriority").alias("p"), F.year("o_orderdate").alias("y")).agg(
        F.count("*").alias("n"), F.avg((F.col("o_orderstatus") == "F").cast("double")).alias("share")).orderBy("p", "y").collect()
    for p in sorted({r["p"] for r in rows}):
        mine = [r for r in rows if r["p"] == p]
        write_run(t.spark, root, p[0], {"recall": [(r["y"] * 1000, r["share"], i) for i, r in enumerate(mine)],
                                        "n_orders": [(r["y"] * 1000, float(r["n"]), i) for i, r in enumerate(mine)]}, {"folds": 5}, {"name": p})
    long = read_runs(t.spark, root)
    board = leaderboard(long.where("kind = 'metrics'").withColumn("value", F.col("value").cast("double")), "run_id", "name", "value", "ts", ["recall", "n_orders"])
    tags = long.where("kind = 'tags' AND name = 'name'").select("run_id", F.trim("value").alias("name"))
    steps = long.where("name = 'recall'").groupBy("run_id").agg(F.count("*").alias("n_steps"))
    return board.join(tags, "run_id").join(steps, "run_id").select("run_id", "name", F.round("recall", 6).alias("recall"), "n_orders", "n_steps")
