"""Data quality and drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadtime import fixed_values as fv
from leadtime.functions.numeric import flag
from leadtime.operators import drift, quality
from leadtime.plans.bindings import URGENT, Tables
from leadtime.plans.catalog import query
from leadtime.plans.catalog import sql as q
from leadtime.session import scratch_path
from leadtime.sources import reports

# rules for line items: one column is missing, one type, one range and one more range fail
RULES = {
    "whole": {"cols": ["l_linenumber", "l_quantity", "l_extendedprice", "l_linestatus"], "dtype": "int", "min": 0},
    "share": {"cols": ["l_discount", "l_tax", "l_margin"], "dtype": "float", "min": 0.01, "max": 0.09},
}


def dirty_lines(t: Tables):
    """Line items with gaps: most taxes of one flag missing, some quantities missing, one constant column."""
    return t.lineitem.select(
        "l_linenumber", F.when(F.col("l_linenumber") > 1, F.col("l_quantity")).alias("l_quantity"), "l_extendedprice",
        "l_linestatus", "l_discount", F.when(F.col("l_returnflag") == "R", F.col("l_tax")).alias("l_tax"),
        F.lit("x").alias("l_constant"))


DIRTY = """dirty AS (SELECT l_linenumber, CASE WHEN l_linenumber > 1 THEN l_quantity END AS l_quantity, l_extendedprice,
  l_linestatus, l_discount, CASE WHEN l_returnflag = 'R' THEN l_tax END AS l_tax, 'x' AS l_constant FROM lineitem)"""
_COLUMNS = ["l_linenumber", "l_quantity", "l_extendedprice", "l_linestatus", "l_discount", "l_tax", "l_constant"]


def _nulls(name: str) -> str:
    return f"(SELECT avg(({name} IS NULL)::INTEGER) FROM dirty)"


_ISSUES = "issues AS (" + " UNION ALL ".join(
    [f"SELECT 'dtype' AS \"check\", '{c}' AS \"column\", 'warning' AS severity WHERE "
     f"(SELECT count(*) FROM dirty WHERE {c} % 1 <> 0) > 0" for c in ("l_quantity", "l_extendedprice")]
    + ["SELECT 'dtype', 'l_linestatus', 'warning'"]
    + [f"SELECT 'range', '{c}', 'error' WHERE (SELECT min({c}) FROM dirty) < 0"
       for c in ("l_linenumber", "l_quantity", "l_extendedprice")]
    + [f"SELECT 'range', '{c}', 'error' WHERE (SELECT min({c}) FROM dirty) < 0.01" for c in ("l_discount", "l_tax")]
    + [f"SELECT 'range', '{c}', 'error' WHERE (SELECT max({c}) FROM dirty) > 0.09" for c in ("l_discount", "l_tax")]
    + [f"SELECT 'missing_values', '{c}', 'error' WHERE {_nulls(c)} > 0.5" for c in _COLUMNS]
    + [f"SELECT 'missing_values', '{c}', 'warning' WHERE {_nulls(c)} > 0.1 AND {_nulls(c)} <= 0.5" for c in _COLUMNS]
    + [f"SELECT 'constant', '{c}', 'warning' WHERE (SELECT count(DISTINCT {c}) FROM dirty) = 1" for c in _COLUMNS]
    + ["SELECT 'missing_column', 'l_margin', 'error'"]) + ")"


@query("q1_missing_columns", "SELECT 'missing_column' AS \"check\", 'l_margin' AS \"column\", 'error' AS severity, "
       "count(*) AS n_rows FROM lineitem")
def q1(t: Tables):
    rows = t.lineitem.agg(F.count("*").alias("n_rows")).scalar()
    return quality.missing_columns(t.lineitem, RULES).select("check", "column", "severity", rows.alias("n_rows"))


_HELD = "CASE WHEN event_type = 'error' AND user_id % 3 = 0 THEN NULL WHEN event_type = 'view' THEN '{\"n\": 1}' ELSE props END"


@query("q1_missing_fields", f"""
WITH r AS (SELECT event_type, {_HELD} AS doc FROM events), f AS (SELECT event_type, 'k' AS field, count(*) AS n_rows,
  count(*) FILTER (WHERE coalesce(json_extract(doc, '$.k') IS NULL, true)) AS n_missing FROM r GROUP BY 1
  UNION ALL SELECT event_type, 'n', count(*), count(*) FILTER (WHERE coalesce(json_extract(doc, '$.n') IS NULL, true)) FROM r GROUP BY 1)
SELECT event_type, field, n_rows, n_missing, CASE WHEN n_missing = n_rows THEN 'error' ELSE 'warning' END AS severity FROM f WHERE n_missing > 0""")
def q1_fields(t: Tables):
    rows = t.events.withColumn("doc", F.expr(_HELD))
    return quality.missing_fields(rows, "event_type", "doc", ["k", "n"])


@query("q2_fractional_values", "SELECT 'l_quantity' AS \"column\", count(*) FILTER (WHERE l_quantity % 1 <> 0) AS n_fractional "
       "FROM lineitem UNION ALL SELECT 'l_extendedprice', count(*) FILTER (WHERE l_extendedprice % 1 <> 0) FROM lineitem")
def q2(t: Tables):
    return quality.column_facts(t.lineitem, ["l_quantity", "l_extendedprice"]).select("column", "n_fractional")


@query("q3_value_ranges", "SELECT 'l_discount' AS \"column\", min(l_discount) + 0.0 AS min, max(l_discount) + 0.0 AS max FROM lineitem "
       "UNION ALL SELECT 'l_linenumber', min(l_linenumber)::DOUBLE, max(l_linenumber)::DOUBLE FROM lineitem")
def q3(t: Tables):
    return quality.column_facts(t.lineitem, ["l_discount", "l_linenumber"]).select("column", "min", "max")


@query("q4_null_shares", f"WITH {DIRTY} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round({_nulls(c)}, 6)::DOUBLE AS null_share" for c in _COLUMNS))
def q4(t: Tables):
    return quality.column_facts(dirty_lines(t)).select("column", F.round("null_share", 6).alias("null_share"))


@query("q5_constant_columns", f"WITH {DIRTY} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", (SELECT count(DISTINCT {c}) = 1 FROM dirty) AS constant" for c in _COLUMNS))
def q5(t: Tables):
    return quality.column_facts(dirty_lines(t)).select("column", "constant")


@query("q6_quality_score", f"""WITH {DIRTY}, {_ISSUES}, n AS (SELECT count(*) FILTER (WHERE severity = 'error') AS e,
  count(*) FILTER (WHERE severity = 'warning') AS w FROM issues)
SELECT e AS n_errors, w AS n_warnings, e = 0 AS passed, greatest(0, 100 - 15 * e - 5 * w) AS quality_score FROM n""")
def q6(t: Tables):
    return quality.quality_score(quality.find_issues(dirty_lines(t), RULES))


@query("q7_check_target", "SELECT count(*) AS n_samples, 0::BIGINT AS n_null, count(*) FILTER (WHERE toxic NOT IN (0, 1)) AS "
       "n_outside, round(avg(toxic), 6) AS positive_rate, true AS passed, avg(toxic) < 0.01 OR avg(toxic) > 0.99 AS unbalanced "
       "FROM labels")
def q7(t: Tables):
    return quality.check_target(t.labels, "toxic").withColumn("positive_rate", F.round("positive_rate", 6))


@query("q8_issue_report", f"WITH {DIRTY}, {_ISSUES} SELECT * FROM issues")
def q8(t: Tables):
    return quality.find_issues(dirty_lines(t), RULES).drop("message")


_VERDICT = ("n_errors, n_warnings, n_errors = 0 AS passed, greatest(0, 100 - 15 * n_errors - 5 * n_warnings) AS quality_score FROM "
            "(SELECT count(*) FILTER (WHERE severity = 'error') AS n_errors, count(*) FILTER (WHERE severity = 'warning') AS n_warnings FROM issues)")


@query("q8_quality_report", f"WITH {DIRTY}, {_ISSUES} SELECT 'lines' AS dataset, {len(_COLUMNS)} AS n_columns, "
       "(SELECT string_agg(severity || ':' || \"column\" || ':' || \"check\", ',' ORDER BY severity, \"column\", \"check\") FROM issues) AS faults, "
       + _VERDICT)
def q8_report(t: Tables):
    """The whole report row, through the JSON sink and back."""
    path = scratch_path(t.spark, "quality")
    report = quality.quality_report(dirty_lines(t), RULES, "lines")
    reports.write_report(report, path)
    stored = reports.read_report(t.spark, path, report.schema)
    faults = F.transform("issues", lambda i: F.concat_ws(":", i["severity"], i["column"], i["check"]))
    return stored.select("dataset", "n_columns", "n_errors", "n_warnings", "passed", "quality_score", F.concat_ws(",", faults).alias("faults"))


@query("q8_gate", f"WITH {DIRTY}, {_ISSUES}, v AS (SELECT {_VERDICT}) SELECT 'lines' AS dataset, NOT passed AS stopped, n_errors FROM v "
       "UNION ALL SELECT 'orders', (SELECT min(o_totalprice) < 0 OR avg((o_totalprice IS NULL)::INTEGER) > 0.5 FROM orders), 0")
def q8_gate(t: Tables):
    """What the gate lets through: a job stops where its table has errors."""
    rules = {"money": {"cols": ["o_totalprice"], "dtype": "float", "min": 0}}
    out = []
    for name, df, rule in (("lines", dirty_lines(t), RULES), ("orders", t.orders.select("o_totalprice", "o_custkey"), rules)):
        report = quality.quality_report(df, rule, name).cache()
        try:
            quality.gate(report)
            stopped = False
        except ValueError:
            stopped = True
        out.append(report.select("dataset", F.lit(stopped).alias("stopped"), "n_errors"))
    return out[0].unionByName(out[1])


@query("q9_duplicate_keys", "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def q9(t: Tables):
    return quality.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("q10_expectations", """
WITH r AS (SELECT count(*) = count(DISTINCT o_orderkey) AS ok FROM orders
  UNION ALL SELECT count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) = 0 FROM orders
  UNION ALL SELECT count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O', 'P')) = 0 FROM orders)
SELECT count(*) AS n_evaluated, count(*) FILTER (WHERE ok) AS n_successful, count(*) FILTER (WHERE NOT ok) AS n_failed,
  round(100.0 * count(*) FILTER (WHERE ok) / count(*), 6)::DOUBLE AS pct_successful FROM r""")
def q10(t: Tables):
    s = quality.suite_statistics([quality.check_unique(t.orders, ["o_orderkey"]),
                                  quality.check_value_set(t.orders, "o_orderstatus", ["F", "O"]),
                                  quality.check_value_set(t.orders, "o_orderstatus", ["F", "O", "P"])])
    return s.withColumn("pct_successful", F.round("pct_successful", 6))


# --- drift: line items shipped before and after a date; the price and the flag are shifted on purpose

FEATURES = ["price", "quantity", "discount", "part", "flat"]
SPLIT = "DATE '1998-06-01'"


def sides(t: Tables):
    later = F.col("l_shipdate") >= F.lit("1998-06-01").cast("date")
    rows = t.lineitem.select(
        "l_shipdate", (F.col("l_extendedprice") * F.when(later, 1.7).otherwise(1.0)).alias("price"),
        F.col("l_quantity").alias("quantity"), F.col("l_discount").alias("discount"),
        F.col("l_partkey").cast("double").alias("part"), F.lit(1.0).alias("flat"),
        flag(F.col("l_returnflag") == "R").alias("label"))
    return drift.drift_sides(rows, F.col("l_shipdate") < F.lit("1998-06-01").cast("date"), later, FEATURES, "label")


_SIDES = f"""sides AS (SELECT CASE WHEN l_shipdate < {SPLIT} THEN 'ref' ELSE 'cur' END AS side,
  l_extendedprice * CASE WHEN l_shipdate >= {SPLIT} THEN 1.7 ELSE 1.0 END AS price, l_quantity AS quantity,
  l_discount AS discount, l_partkey::DOUBLE AS part, 1.0::DOUBLE AS flat,
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label FROM lineitem)"""
_LONG = "long AS (" + " UNION ALL ".join(f"SELECT side, '{c}' AS feature, {c}::DOUBLE AS v FROM sides" for c in FEATURES) + ")"
_BINNED = f"""{_SIDES}, {_LONG}, b AS (SELECT feature, min(v) AS lo, max(v) AS hi FROM long GROUP BY 1),
binned AS (SELECT feature, side, CASE WHEN lo = hi THEN -1 ELSE {" + ".join(
    f"(v >= lo + {i}.0 * ((hi - lo) / 10.0))::INTEGER" for i in range(1, 10))} END AS bin FROM long JOIN b USING (feature)),
hist AS (SELECT feature, bin, count(*) FILTER (WHERE side = 'ref') AS n_ref, count(*) FILTER (WHERE side = 'cur') AS n_cur
  FROM binned GROUP BY 1, 2)"""
_PSI = _BINNED + """,
shares AS (SELECT feature, bin, least(greatest(n_ref / sum(n_ref) OVER w, 0.0001), 1.0) AS e,
  least(greatest(n_cur / sum(n_cur) OVER w, 0.0001), 1.0) AS a FROM hist WINDOW w AS (PARTITION BY feature)),
psi AS (SELECT feature, sum(CASE WHEN bin < 0 THEN 0.0 ELSE (a - e) * ln(a / e) END) AS psi FROM shares GROUP BY 1)"""
_SUMMARY = _PSI + """,
agg AS (SELECT count(*) AS n_features, count(*) FILTER (WHERE psi > 0.2) AS n_drifted, coalesce(max(psi), 0.0) AS m,
  coalesce(string_agg(CASE WHEN psi > 0.2 THEN feature END, ',' ORDER BY feature), '') AS drifted FROM psi),
rates AS (SELECT avg(label) FILTER (WHERE side = 'ref') AS r, avg(label) FILTER (WHERE side = 'cur') AS c FROM sides),
report AS (SELECT n_features, n_drifted, drifted, round(m, 4) AS max_psi,
  round(100.0 * n_drifted / greatest(n_features, 1), 1)::DOUBLE AS drift_pct, abs(r - c) > 0.02 AS target_drift,
  round(r, 4) AS target_ref_rate, round(c, 4) AS target_prod_rate FROM agg, rates),
full_report AS (SELECT *, CASE WHEN n_drifted = 0 THEN 'NONE' WHEN drift_pct > 30 THEN 'CRITICAL' WHEN drift_pct > 15
  THEN 'HIGH' ELSE 'MODERATE' END AS drift_severity, n_drifted > 0 OR target_drift AS drift_detected FROM report)"""


def psi_of(t: Tables):
    return drift.population_stability(sides(t), FEATURES)


@query("d1_histogram", f"WITH {_BINNED} SELECT * FROM hist")
def d1(t: Tables):
    return drift.histogram_counts(sides(t), FEATURES)


@query("d2_population_stability", f"WITH {_PSI} SELECT feature, round(psi, 6) AS psi FROM psi")
def d2(t: Tables):
    return psi_of(t).withColumn("psi", F.round("psi", 6))


@query("d3_drift_summary", f"WITH {_SUMMARY} SELECT n_features, n_drifted, drifted, max_psi, drift_pct FROM full_report")
def d3(t: Tables):
    return drift.drift_summary(psi_of(t)).select(
        "n_features", "n_drifted", F.concat_ws(",", "drifted_features").alias("drifted"), "max_psi", "drift_pct")


@query("d3_drift_report", f"""WITH {_SUMMARY}, top AS (SELECT string_agg(feature || '=' || printf('%.4f', psi), ',' ORDER BY psi DESC, feature DESC) AS top5
  FROM (SELECT * FROM psi ORDER BY psi DESC, feature DESC LIMIT 5))
SELECT n_features, n_drifted, drift_pct, drift_severity, max_psi, top5 FROM full_report, top""")
def d3_report(t: Tables):
    """Severity and the top five of the nested report, through the JSON sink and back."""
    path = scratch_path(t.spark, "drift")
    report = drift.drift_summary(psi_of(t))
    reports.write_report(report, path)
    stored = reports.read_report(t.spark, path, report.schema)
    top = F.transform("top5_psi", lambda x: F.concat(x["feature"], F.lit("="), F.format_string("%.4f", x["psi"])))
    return stored.select("n_features", "n_drifted", "drift_pct", "drift_severity", "max_psi", F.concat_ws(",", top).alias("top5"))


@query("d3_drift_flags", f"WITH {_PSI} SELECT feature, round(psi, 6) AS psi, psi > 0.2 AS drifted FROM psi")
def d3_flags(t: Tables):
    return drift.flag_drift(psi_of(t)).withColumn("psi", F.round("psi", 6))


@query("d4_target_drift", f"WITH {_SUMMARY} SELECT target_drift, target_ref_rate, target_prod_rate FROM full_report")
def d4(t: Tables):
    return drift.target_drift(sides(t), "label")


@query("d5_severity", f"WITH {_PSI}, n AS (SELECT limit_, count(*) FILTER (WHERE psi > limit_) AS n_drifted, "
       "round(100.0 * count(*) FILTER (WHERE psi > limit_) / count(*), 1)::DOUBLE AS drift_pct FROM psi, "
       "(VALUES (0.0::DOUBLE), (0.001), (0.2), (5.0)) AS l(limit_) GROUP BY 1) SELECT limit_ AS psi_threshold, n_drifted, "
       "drift_pct, CASE WHEN n_drifted = 0 THEN 'NONE' WHEN drift_pct > 30 THEN 'CRITICAL' WHEN drift_pct > 15 THEN 'HIGH' "
       "ELSE 'MODERATE' END AS drift_severity FROM n")
def d5(t: Tables):
    limits = F.explode(F.array(*[F.lit(x) for x in (0.0, 0.001, 0.2, 5.0)]))
    over = F.count(F.when(F.col("psi") > F.col("psi_threshold"), 1))
    df = psi_of(t).withColumn("psi_threshold", limits).groupBy("psi_threshold").agg(
        over.alias("n_drifted"), F.round(F.lit(100.0) * over / F.count("*"), 1).alias("drift_pct"))
    return df.withColumn("drift_severity", drift.severity(F.col("n_drifted"), F.col("drift_pct")))


@query("d6_drift_sides", f"WITH {_SIDES} SELECT side, label, count(*) AS n, round(sum(price), 2) AS price, "
       "sum(quantity) AS quantity FROM sides GROUP BY 1, 2")
def d6(t: Tables):
    return sides(t).groupBy("side", "label").agg(F.count("*").alias("n"), F.round(F.sum("price"), 2).alias("price"),
                                                 F.sum("quantity").alias("quantity"))


@query("d7_retrain_on_severity", f"WITH {_SUMMARY} SELECT drift_detected, drift_severity, "
       "drift_detected AND drift_severity IN ('HIGH', 'CRITICAL') AS retrain FROM full_report")
def d7(t: Tables):
    report = drift.drift_report(sides(t), FEATURES, "label")
    return drift.retrain_on_severity(report).select("drift_detected", "drift_severity", "retrain")


@query("d8_retrain_decision", f"""
WITH {_SUMMARY}, {q.PRED}, c AS ({q.counts()}), p AS (SELECT round(tp / (tp + fn), 4) AS recall FROM c)
SELECT drift_detected OR recall < 0.85 AS retrain, concat_ws(' | ',
  CASE WHEN drift_detected THEN printf('drift: %d features (max PSI=%.4f)', n_drifted, max_psi) END,
  CASE WHEN recall < 0.85 THEN printf('recall %.4f < 0.85', recall) END) AS reasons FROM full_report, p""")
def d8(t: Tables):
    from leadtime.operators.evaluation import performance_check
    report = drift.drift_report(sides(t), FEATURES, "label")
    found = drift.retrain_decision(report, performance_check(t.predictions, "label", "p_len", 0.5))
    return found.withColumn("reasons", F.concat_ws(" | ", "reasons"))


@query("d9_drift_trend", """
WITH h AS (SELECT event_type AS dataset, ts::DATE::VARCHAR AS run, round(max(value), 6) AS max_psi FROM events GROUP BY 1, 2)
SELECT dataset, run, max_psi, lag(max_psi) OVER w AS previous, round(max_psi - lag(max_psi) OVER w, 6) AS change FROM h
WINDOW w AS (PARTITION BY dataset ORDER BY run)""")
def d9(t: Tables):
    history = (t.events.groupBy(F.col("event_type").alias("dataset"), F.to_date("ts").cast("string").alias("run"))
               .agg(F.round(F.max("value"), 6).alias("max_psi")))
    return drift.drift_trend(history, "run").withColumn("change", F.round("change", 6))


@query("w1_top_features", f"WITH {_PSI} SELECT feature, round(psi, 6) AS psi FROM psi ORDER BY psi DESC, feature LIMIT 3")
def w1(t: Tables):
    return drift.top_features(psi_of(t), 3).withColumn("psi", F.round("psi", 6))


@query("w8_largest_psi", f"WITH {_PSI} SELECT round(coalesce(max(psi), 0.0), 6) AS max_psi FROM psi")
def w8(t: Tables):
    return psi_of(t).agg(F.round(F.coalesce(F.max("psi"), F.lit(0.0)), 6).alias("max_psi"))


@query("u3_both_samples", f"WITH {_SIDES} SELECT side, count(*) AS n, round(min(price), 2) AS lo, round(max(price), 2) AS hi "
       "FROM sides GROUP BY 1 UNION ALL SELECT 'both', count(*), round(min(price), 2), round(max(price), 2) FROM sides")
def u3(t: Tables):
    df = sides(t)
    facts = [F.count("*").alias("n"), F.round(F.min("price"), 2).alias("lo"), F.round(F.max("price"), 2).alias("hi")]
    return df.rollup("side").agg(*facts).withColumn("side", F.coalesce("side", F.lit("both")))
