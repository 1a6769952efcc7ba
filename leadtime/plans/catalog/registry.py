"""Model versions: promotion, rollback, clean-up, run logs.

Versions come from the documents: a language is a model, a source a version
of it, scored on the labelled documents of that source.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from leadtime.operators import evaluation as ev
from leadtime.operators import registry as reg
from leadtime.plans.bindings import Tables
from leadtime.plans.catalog import query
from leadtime.plans.catalog import sql as q
from leadtime.session import cut_lineage

_VERSION = "CAST(substr(source, 4) AS INTEGER)"
_VERSIONS = f"""versions AS (SELECT lang AS model, {_VERSION} AS version, count(*) AS n_docs, max(doc_id) AS run_id,
  CASE WHEN {_VERSION} = 3 THEN 'Production' WHEN {_VERSION} IN (5, 9) THEN 'Staging' ELSE 'None' END AS stage,
  CASE WHEN {_VERSION} = 3 THEN 'champion' WHEN {_VERSION} IN (5, 9) THEN 'challenger' ELSE 'none' END AS role
  FROM documents GROUP BY ALL)"""


def versions(t: Tables):
    v, new = F.substring("source", 4, 9).cast("int"), F.col("version")
    return (t.documents.groupBy(F.col("lang").alias("model"), v.alias("version"))
            .agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("run_id"))
            .withColumns({
                "stage": F.when(new == 3, "Production").when(new.isin(5, 9), "Staging").otherwise("None"),
                "role": F.when(new == 3, "champion").when(new.isin(5, 9), "challenger").otherwise("none")}))


# metrics per version of one model family: every source is a version
_METRICS = f"""sp AS (SELECT *, {_VERSION} AS version FROM pred), a AS ({q.auc('version', 'p_src', 'sp')}),
c AS ({q.counts('version', 'p_src', 0.5, 'sp')}),
metrics AS (SELECT 'risk' AS model, version, auc_roc, coalesce(tp / nullif(tp + fn, 0), 0) AS recall, tp + fp + tn + fn AS n_samples
  FROM c LEFT JOIN a USING (version)),
champ AS (SELECT * FROM metrics WHERE version = 3)"""


def version_metrics(t: Tables):
    rows = t.predictions.withColumn("version", F.substring("source", 4, 9).cast("int"))
    m = ev.validation_metrics(rows, "label", "p_src", ["version"])
    # one row per version, read as candidates and as champion
    return cut_lineage(m.withColumn("model", F.lit("risk")), "metrics")


@query("r4_promotion_decision", f"""
WITH {q.PRED}, {_METRICS}, j AS (SELECT m.*, c.version AS cv, coalesce(m.auc_roc < 0.5, true) AS floor_,
  coalesce(m.recall >= c.recall OR m.auc_roc >= c.auc_roc, false) AS better FROM metrics m LEFT JOIN champ c USING (model)
  WHERE m.version <> 3)
SELECT version, NOT floor_ AND (cv IS NULL OR better) AS promoted, CASE WHEN floor_ THEN 'auc_below_floor' WHEN cv IS NULL
  THEN 'first_champion' WHEN better THEN 'better_performance' ELSE 'champion_better' END AS reason FROM j""")
def r4(t: Tables):
    m = version_metrics(t)
    decided = reg.promotion_decision(m.where(F.col("version") != 3), m.where(F.col("version") == 3), min_auc=0.5)
    return decided.select("version", "promoted", "reason")


@query("r5_rollback_check", f"""
WITH {q.PRED}, {_METRICS}, j AS (SELECT m.version, m.recall IS NULL AS broken, m.recall < 0.1 AS weak,
  coalesce(c.version <> m.version AND m.auc_roc < c.auc_roc - 0.05, false) AS behind FROM metrics m LEFT JOIN champ c USING (model))
SELECT version, broken OR weak OR behind AS rollback, CASE WHEN broken THEN 'no_metrics' WHEN weak THEN 'low_recall'
  WHEN behind THEN 'auc_below_champion' ELSE 'ok' END AS reason FROM j""")
def r5(t: Tables):
    m = version_metrics(t)
    return reg.rollback_check(m, m.where(F.col("version") == 3), min_recall=0.1).select("version", "rollback", "reason")


@query("r6_promote", f"""
WITH {_VERSIONS}, d AS (SELECT model, max(version) AS new_version FROM versions WHERE version <> 3 GROUP BY 1)
SELECT model, version, CASE WHEN version = new_version THEN 'Production' WHEN stage = 'Production' THEN 'Archived' ELSE stage END AS stage,
  CASE WHEN version = new_version THEN 'champion' WHEN stage = 'Production' THEN 'archived' ELSE role END AS role
FROM versions JOIN d USING (model)""")
def r6(t: Tables):
    table = versions(t)
    change = table.where(F.col("version") != 3).groupBy("model").agg(F.max("version").alias("new_version"))
    return reg.promote(table, change).select("model", "version", "stage", "role")


@query("r6_stage_challenger", f"""
WITH {_VERSIONS}, d AS (SELECT model, min(version) AS new_version FROM versions GROUP BY 1)
SELECT model, version, CASE WHEN version = new_version THEN 'Staging' ELSE stage END AS stage,
  CASE WHEN version = new_version THEN 'challenger' ELSE role END AS role FROM versions JOIN d USING (model)""")
def r6_stage(t: Tables):
    table = versions(t)
    change = table.groupBy("model").agg(F.min("version").alias("new_version"))
    return reg.stage_challenger(table, change).select("model", "version", "stage", "role")


_LATEST = f"""WITH {_VERSIONS}, r AS (SELECT *, row_number() OVER (PARTITION BY model, stage ORDER BY version DESC) AS rn
  FROM versions WHERE stage IN ('Production', 'Staging')) SELECT model, stage, version, n_docs FROM r WHERE rn = 1"""


@query("r7_champion_and_challenger", _LATEST)
def r7(t: Tables):
    return reg.latest_by_stage(versions(t)).select("model", "stage", "version", "n_docs")


@query("r8_clean_up", f"""
WITH {_VERSIONS}, r AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY version DESC) AS rn FROM versions)
SELECT model, version, CASE WHEN rn > 10 AND stage NOT IN ('Production', 'Staging') THEN 'Archived' ELSE stage END AS stage FROM r""")
def r8(t: Tables):
    return reg.clean_up(versions(t)).select("model", "version", "stage")


@query("r10_run_rows", f"""
WITH {q.PRED}, c AS ({q.counts('split')}) SELECT 'run-1' AS run_id, 'metrics' AS kind, split || '_' || name AS name, value FROM (
  SELECT split, 'n_samples' AS name, (tp + fp + tn + fn)::VARCHAR AS value FROM c
  UNION ALL SELECT split, 'true_positive', tp::VARCHAR FROM c)""")
def r10(t: Tables):
    m = ev.metrics_at(t.predictions, "label", "p_len", 0.5, ["split"])
    return reg.run_rows(m, "run-1", {"n_samples": "n_samples", "true_positive": "tp"})


@query("w3_latest_per_stage", f"WITH {_VERSIONS} SELECT model, stage, max(version) AS version FROM versions "
       "WHERE stage IN ('Production', 'Staging', 'None') GROUP BY 1, 2")
def w3(t: Tables):
    return reg.latest_by_stage(versions(t), stages=("Production", "Staging", "None")).select("model", "stage", "version")


@query("w4_beyond_last", f"""
WITH {_VERSIONS} SELECT model, version, row_number() OVER (PARTITION BY model ORDER BY version DESC)::INTEGER AS age_rank,
  row_number() OVER (PARTITION BY model ORDER BY version DESC) > 10 AS beyond FROM versions""")
def w4(t: Tables):
    return reg.beyond_last(versions(t)).select("model", "version", "age_rank", "beyond")


@query("w5_previous_version", f"WITH {_VERSIONS} SELECT model, version, coalesce(lag(version) OVER (PARTITION BY model ORDER BY version), -1) "
       "AS previous_version FROM versions")
def w5(t: Tables):
    return reg.with_previous_version(versions(t)).select("model", "version", "previous_version").fillna(-1)
