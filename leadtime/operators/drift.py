"""Population stability, drift reports and retraining decisions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from leadtime.fixed_values import (DRIFT_CRITICAL_PCT, DRIFT_HIGH_PCT, PSI_BINS, PSI_LIMIT, PSI_SHARE_FLOOR,
                                   RETRAIN_RECALL_MIN, RETRAIN_SEVERITIES, TARGET_DRIFT_LIMIT)
from leadtime.functions.numeric import add_all, as_target, safe_columns, safe_numeric


def drift_sides(df: DataFrame, is_ref: Column, is_cur: Column, features: Sequence[str],
                target: str | None = None, side: str = "side") -> DataFrame:
    """Sanitised features of reference and current rows, tagged 'ref' and 'cur'.

    Give the predicates on plain columns (a year, a time range): they reach the scan.
    """
    rows = df.where(is_ref | is_cur)
    extra = [as_target(F.col(target)).alias(target)] if target else []
    return rows.select(F.when(is_ref, "ref").otherwise("cur").alias(side), *extra,
                       *[v.alias(c) for c, v in safe_columns(rows, features).items()])


def equal_width_bin(value: Column, low: Column, high: Column, bins: int = PSI_BINS) -> Column:
    """Bin 0..bins-1 over [low, high]; left-closed, the last one closed on both sides. -1 if low = high."""
    step = (high - low) / F.lit(float(bins))
    index = add_all([(value >= low + F.lit(float(i)) * step).cast("int") for i in range(1, bins)], 0)
    return F.when(low == high, F.lit(-1)).otherwise(index)


def histogram_counts(df: DataFrame, features: Sequence[str], side: str = "side", bins: int = PSI_BINS) -> DataFrame:
    """(feature, bin, n_ref, n_cur) over common bounds.

    Two passes whatever the number of features: one row of bounds, then counts
    that are combined map-side to sides x features x bins rows.
    """
    bounds = df.agg(F.struct(*[F.struct(F.min(safe_numeric(c)).alias("lo"),
                                        F.max(safe_numeric(c)).alias("hi")).alias(c) for c in features])
                    .alias("b")).scalar()
    bounded = df.select(side, *features, bounds.alias("_all"))
    each = [x for c in features for x in (F.lit(c), safe_numeric(c), F.col("_all")[c]["lo"], F.col("_all")[c]["hi"])]
    long = bounded.select(side, F.stack(F.lit(len(features)), *each).alias("feature", "_v", "_lo", "_hi"))
    rows = long.select(side, "feature", equal_width_bin(F.col("_v"), F.col("_lo"), F.col("_hi"), bins).alias("bin"))
    return rows.groupBy("feature", "bin").agg(F.count(F.when(F.col(side) == "ref", 1)).alias("n_ref"),
                                              F.count(F.when(F.col(side) == "cur", 1)).alias("n_cur"))


def population_stability(df: DataFrame, features: Sequence[str], side: str = "side", bins: int = PSI_BINS) -> DataFrame:
    """PSI per feature. Bins empty on both sides add nothing, so no full grid is built."""
    counts = histogram_counts(df, features, side, bins)
    whole = Window.partitionBy("feature")  # at most `bins` rows per feature

    def share(n):
        part = F.col(n) / F.greatest(F.sum(n).over(whole), F.lit(1))
        return F.least(F.greatest(part, F.lit(PSI_SHARE_FLOOR)), F.lit(1.0))

    shares = counts.withColumns({"_e": share("n_ref"), "_a": share("n_cur")})
    term = F.when(F.col("bin") < 0, F.lit(0.0)).otherwise(
        (F.col("_a") - F.col("_e")) * F.log(F.col("_a") / F.col("_e")))
    return shares.groupBy("feature").agg(F.sum(term).alias("psi"))


def flag_drift(psi: DataFrame, limit: float = PSI_LIMIT) -> DataFrame:
    return psi.withColumn("drifted", F.col("psi") > limit)


def severity(n_drifted: Column, pct: Column) -> Column:
    return (F.when(n_drifted == 0, "NONE").when(pct > DRIFT_CRITICAL_PCT, "CRITICAL")
            .when(pct > DRIFT_HIGH_PCT, "HIGH").otherwise("MODERATE"))


def top_features(psi: DataFrame, k: int = 5) -> DataFrame:
    return psi.orderBy(F.col("psi").desc(), "feature").limit(k)


def drift_summary(psi: DataFrame, limit: float = PSI_LIMIT) -> DataFrame:
    """One row: features, drifted ones, their share, the largest PSI, severity and the top five."""
    drifted = F.col("psi") > limit
    ranked = F.sort_array(F.collect_list(F.struct(F.col("psi"), F.col("feature"))), asc=False)
    base = psi.agg(F.count("*").alias("n_features"), F.count(F.when(drifted, 1)).alias("n_drifted"),
                   F.coalesce(F.max("psi"), F.lit(0.0)).alias("_max"),
                   F.sort_array(F.collect_list(F.when(drifted, F.col("feature")))).alias("drifted_features"),
                   F.slice(ranked, 1, 5).alias("_top"))
    pct = F.round(F.lit(100.0) * F.col("n_drifted") / F.greatest(F.col("n_features"), F.lit(1)), 1)
    return base.withColumn("drift_pct", pct).select(
        F.lit(limit).alias("psi_threshold"), "n_features", "n_drifted", "drift_pct", "drifted_features",
        F.round("_max", 4).alias("max_psi"), severity(F.col("n_drifted"), F.col("drift_pct")).alias("drift_severity"),
        F.transform("_top", lambda x: F.struct(x["feature"].alias("feature"), x["psi"].alias("psi"))).alias("top5_psi"))


def target_drift(df: DataFrame, target: str, side: str = "side", limit: float = TARGET_DRIFT_LIMIT) -> DataFrame:
    """One row: label rate of both sides and whether they differ by more than the limit."""
    y = as_target(F.col(target)).cast("double")
    ref = F.avg(F.when(F.col(side) == "ref", y))
    cur = F.avg(F.when(F.col(side) == "cur", y))
    return df.agg(F.coalesce(F.abs(ref - cur) > limit, F.lit(False)).alias("target_drift"),
                  F.round(ref, 4).alias("target_ref_rate"), F.round(cur, 4).alias("target_prod_rate"))


def drift_report(df: DataFrame, features: Sequence[str], target: str, side: str = "side",
                 limit: float = PSI_LIMIT) -> DataFrame:
    """The whole report as one nested row, ready for a JSON sink."""
    y = target_drift(df, target, side)
    t = y.select(F.struct(*y.columns)).scalar()
    out = drift_summary(population_stability(df, features, side), limit).withColumn("_y", t)
    return out.select(*[c for c in out.columns if c != "_y"], "_y.*").withColumn(
        "drift_detected", (F.col("n_drifted") > 0) | F.col("target_drift"))


def retrain_on_severity(report: DataFrame) -> DataFrame:
    """Retrain when drift is flagged and severe; label drift alone has severity NONE and does not."""
    go = F.col("drift_detected") & F.col("drift_severity").isin(RETRAIN_SEVERITIES)
    return report.withColumn("retrain", go)


def retrain_decision(drift: DataFrame, performance: DataFrame, min_recall: float = RETRAIN_RECALL_MIN) -> DataFrame:
    """Retrain on drift, on lost recall or without a model, with the reasons.

    ``drift``: one row (drift_detected, n_drifted, max_psi); ``performance``: one
    row (model_available, recall). An empty table stands for a report that is
    not there: then nothing drifted, and no model is available.
    """
    d = drift.agg(F.struct(F.coalesce(F.bool_or("drift_detected"), F.lit(False)).alias("hit"),
                           F.max("n_drifted").alias("n"), F.max("max_psi").alias("psi")).alias("s")).scalar()
    p = performance.agg(F.coalesce(F.bool_or("model_available"), F.lit(False)).alias("has"),
                        F.coalesce(F.min("recall"), F.lit(1.0)).alias("recall")).withColumn("_d", d)
    d = F.col("_d")
    weak = F.col("has") & (F.col("recall") < min_recall)
    reasons = F.array_compact(F.array(
        F.when(d["hit"], F.format_string("drift: %d features (max PSI=%.4f)", d["n"], d["psi"])),
        F.when(weak, F.format_string(f"recall %.4f < {min_recall}", F.col("recall"))),
        F.when(~F.col("has"), F.lit("no production model available"))))
    return p.select((F.size(reasons) > 0).alias("retrain"), reasons.alias("reasons"))


def drift_trend(history: DataFrame, run: str, dataset: str = "dataset", value: str = "max_psi") -> DataFrame:
    """Each run beside the one before it of the same data set."""
    w = Window.partitionBy(dataset).orderBy(run)
    return history.withColumns({"previous": F.lag(value).over(w), "change": F.col(value) - F.lag(value).over(w)})
