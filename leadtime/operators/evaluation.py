"""Evaluation of binary scores: confusion counts, curves, thresholds, AUC.

Curves and AUC start by collapsing equal scores and never order all rows in one
task: order-preserving buckets (see ``prefix``) carry the running totals.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from leadtime.fixed_values import (CANDIDATE_MIN_AUC, PRECISION_MIN_POSITIVES, RECALL_TARGET, SWEEP_THRESHOLDS)
from leadtime.functions.numeric import flag, ratio_or_zero
from leadtime.operators.prefix import add_before, bounds_of, with_bucket

COUNTS = ("tp", "fp", "tn", "fn")


def predict_at(score: Column, threshold: float | Column) -> Column:
    return flag(score >= (threshold if isinstance(threshold, Column) else F.lit(threshold)))


def confusion(df: DataFrame, label: str, score: str, threshold: float = 0.5, by: Sequence[str] = ()) -> DataFrame:
    hit, true = F.col(score) >= F.lit(threshold), F.col(label) == 1
    return df.groupBy(*by).agg(
        F.count(F.when(hit & true, 1)).alias("tp"), F.count(F.when(hit & ~true, 1)).alias("fp"),
        F.count(F.when(~hit & ~true, 1)).alias("tn"), F.count(F.when(~hit & true, 1)).alias("fn"))


def with_rates(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1, accuracy from tp/fp/tn/fn; 0 where a denominator is 0."""
    tp, fp, tn, fn = (F.col(c) for c in COUNTS)
    return counts.withColumns({
        "predicted_positive": tp + fp,
        "precision": ratio_or_zero(tp, tp + fp), "recall": ratio_or_zero(tp, tp + fn),
        "f1": ratio_or_zero(2 * tp, 2 * tp + fp + fn),
        "accuracy": ratio_or_zero(tp + tn, tp + fp + tn + fn)})


def f_beta(precision: Column, recall: Column, beta: float) -> Column:
    b2 = float(beta) ** 2
    return ratio_or_zero((1 + b2) * precision * recall, b2 * precision + recall)


def _per_score(df: DataFrame, label: str, score: str, by: Sequence[str]) -> DataFrame:
    return (df.where(F.col(score).isNotNull()).groupBy(*by, F.col(score).cast("double").alias("score"))
            .agg(F.count(F.when(F.col(label) == 1, 1)).alias("pos"),
                 F.count(F.when(F.col(label) == 0, 1)).alias("neg")))


def _bucketed(scores: DataFrame, bounds: Sequence[float] | None) -> DataFrame:
    if bounds is None:
        # the condition holds for every row; with it the subquery needs the columns of the curve and so reuses its shuffle
        bounds = bounds_of(scores.where("pos + neg >= 0"), "score")
    return with_bucket(scores, "score", bounds)


def _ranked(df: DataFrame, label: str, score: str, by: Sequence[str], bounds: Sequence[float] | None,
            threshold: float) -> DataFrame:
    """Pairs won, class totals and hits at one threshold per group, in one pass over the scores.

    Each bucket contributes its own pairs and, through one number, the negatives
    of all buckets below it, so the offsets are never joined back to the rows.
    """
    points = _bucketed(_per_score(df, label, score, by), bounds)
    below = Window.partitionBy(*by, "_bucket").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    inner = points.withColumn("_below", F.coalesce(F.sum("neg").over(below), F.lit(0)))
    hit = F.col("score") >= F.lit(float(threshold))
    buckets = inner.groupBy(*by, "_bucket").agg(
        F.sum(F.col("pos").cast("double") * (F.col("_below") + F.col("neg") / 2)).alias("_inner"),
        F.sum("pos").alias("_p"), F.sum("neg").alias("_n"),
        F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("_tp"),
        F.sum(F.when(hit, F.col("neg")).otherwise(0)).alias("_fp"))
    # groups x buckets rows from here on
    earlier = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifted = buckets.withColumn("_off", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    wins = F.sum(F.col("_inner") + F.col("_p").cast("double") * F.col("_off"))
    none = F.lit(0)
    return shifted.groupBy(*by).agg(
        wins.alias("_wins"), F.coalesce(F.sum("_p"), none).alias("n_pos"), F.coalesce(F.sum("_n"), none).alias("n_neg"),
        F.coalesce(F.sum("_tp"), none).alias("tp"), F.coalesce(F.sum("_fp"), none).alias("fp")).withColumn(
        "auc_roc", F.try_divide(F.col("_wins"), F.col("n_pos").cast("double") * F.col("n_neg")))


def roc_auc(df: DataFrame, label: str, score: str, by: Sequence[str] = (),
            bounds: Sequence[float] | None = None) -> DataFrame:
    """Exact AUC with ties at half weight; NULL where a group has one class only."""
    return _ranked(df, label, score, by, bounds, 0.5).select(*by, "n_pos", "n_neg", "auc_roc")


def metrics_at(df: DataFrame, label: str, score: str, threshold: float = 0.5, by: Sequence[str] = (),
               bounds: Sequence[float] | None = None) -> DataFrame:
    """AUC, precision, recall, F1 and counts per group at one threshold."""
    m = _ranked(df, label, score, by, bounds, threshold).withColumns(
        {"tn": F.col("n_neg") - F.col("fp"), "fn": F.col("n_pos") - F.col("tp")})
    return (with_rates(m).drop("_wins")
            .withColumns({"n_samples": F.col("n_pos") + F.col("n_neg"), "threshold": F.lit(float(threshold))}))


def threshold_sweep(df: DataFrame, label: str, score: str, thresholds: Sequence[float] = tuple(SWEEP_THRESHOLDS),
                    by: Sequence[str] = ()) -> DataFrame:
    """Counts and rates at every threshold.

    A row only says how many thresholds it passes; groups x (thresholds + 1)
    rows are left after one map-side combined aggregate, and the totals at or
    above each threshold are added up from those.
    """
    steps = sorted(thresholds)
    passed = F.lit(0)
    for t in steps:
        passed = passed + (F.col(score) >= F.lit(t)).cast("int")
    bins = (df.select(*by, passed.alias("_k"), F.col(label).alias("_y")).groupBy(*by, "_k")
            .agg(F.count(F.when(F.col("_y") == 1, 1)).alias("_p"), F.count(F.when(F.col("_y") == 0, 1)).alias("_n")))
    table = F.array(*[F.struct(F.lit(float(t)).alias("threshold"), F.lit(i + 1).alias("need"))
                      for i, t in enumerate(steps)])
    spread = bins.select(*by, "_k", "_p", "_n", F.explode(table).alias("_t")).select("*", "_t.*")
    at = F.col("_k") >= F.col("need")
    counts = spread.groupBy(*by, "threshold").agg(
        F.sum(F.when(at, F.col("_p")).otherwise(0)).alias("tp"), F.sum(F.when(at, F.col("_n")).otherwise(0)).alias("fp"),
        F.sum(F.when(~at, F.col("_n")).otherwise(0)).alias("tn"), F.sum(F.when(~at, F.col("_p")).otherwise(0)).alias("fn"))
    return with_rates(counts)


def pr_curve(df: DataFrame, label: str, score: str, by: Sequence[str] = (),
             bounds: Sequence[float] | None = None) -> DataFrame:
    """One row per distinct score as threshold: counts, precision, recall, F1."""
    points = _bucketed(_per_score(df, label, score, by), bounds)
    run = add_before(points, {"_tp": "pos", "_fp": "neg"}, ["score"], groups=by, descending=True,
                     totals={"_P": "pos", "_N": "neg"})
    tp, fp = F.col("_tp") + F.col("pos"), F.col("_fp") + F.col("neg")
    counts = run.select(*by, F.col("score").alias("threshold"), tp.alias("tp"), fp.alias("fp"),
                        (F.col("_N") - fp).alias("tn"), (F.col("_P") - tp).alias("fn"))
    return with_rates(counts)


def threshold_for_recall(curve: DataFrame, target: float = RECALL_TARGET, by: Sequence[str] = ()) -> DataFrame:
    """The highest threshold whose recall reaches the target."""
    return curve.where(F.col("recall") >= target).groupBy(*by).agg(F.max("threshold").alias("threshold"))


def thresholds_for_precision(curve: DataFrame, targets: Sequence[float],
                             min_positives: int = PRECISION_MIN_POSITIVES) -> DataFrame:
    """Per precision target: the threshold with the best recall, or ``achievable = false``.

    Among equal recalls the higher threshold is taken. Every target is an
    aggregate of the same pass over the curve.
    """
    def pick(t):
        fits = (F.col("precision") >= t) & (F.col("predicted_positive") >= min_positives)
        return F.max(F.when(fits, F.struct("recall", "threshold", "precision", "predicted_positive")))

    best = curve.agg(*[pick(t).alias(f"_t{i}") for i, t in enumerate(targets)])
    rows = F.array(*[F.struct(F.lit(float(t)).alias("target"), F.col(f"_t{i}").alias("b"))
                     for i, t in enumerate(targets)])
    return best.select(F.explode(rows).alias("r")).select(
        "r.target", F.col("r.b").isNotNull().alias("achievable"), "r.b.threshold", "r.b.precision", "r.b.recall",
        "r.b.predicted_positive")


def best_f_beta(curve: DataFrame, beta: float = 1.0, by: Sequence[str] = ()) -> DataFrame:
    """The threshold with the largest F-beta; the higher one among equals."""
    value = f_beta(F.col("precision"), F.col("recall"), beta)
    best = curve.groupBy(*by).agg(F.max(F.struct(value.alias("fbeta"), F.col("threshold"))).alias("b"))
    return best.select(*by, "b.threshold", "b.fbeta")


def select_candidate(metrics: DataFrame, name: str, min_auc: float = CANDIDATE_MIN_AUC,
                     min_recall: float = RECALL_TARGET) -> DataFrame:
    """The candidate with the best recall (then AUC, then name) among those above both limits."""
    fits = metrics.where((F.col("auc_roc") >= min_auc) & (F.col("recall") >= min_recall))
    return (fits.agg(F.max(F.struct("recall", "auc_roc", name)).alias("b")).where(F.col("b").isNotNull())
            .select(f"b.{name}", "b.recall", "b.auc_roc"))


def class_report(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """Precision, recall, F1, support per class and their macro and weighted averages."""
    c = confusion(df, label, score, threshold)
    tp, fp, tn, fn = (F.col(x) for x in COUNTS)

    def of(name, hit, false, lost):
        return F.struct(F.lit(name).alias("class"), ratio_or_zero(hit, hit + false).alias("precision"),
                        ratio_or_zero(hit, hit + lost).alias("recall"),
                        ratio_or_zero(2 * hit, 2 * hit + false + lost).alias("f1"), (hit + lost).alias("support"))

    both = c.select(of("0", tn, fn, fp).alias("a"), of("1", tp, fp, fn).alias("b"))
    a, b = F.col("a"), F.col("b")
    whole = a["support"] + b["support"]

    def average(name, weigh):
        return F.struct(F.lit(name).alias("class"), *[weigh(m).alias(m) for m in ("precision", "recall", "f1")],
                        whole.alias("support"))

    macro = average("macro avg", lambda m: (a[m] + b[m]) / 2)
    weighted = average("weighted avg", lambda m: ratio_or_zero(a[m] * a["support"] + b[m] * b["support"], whole))
    return both.select(F.explode(F.array(a, b, macro, weighted)).alias("r")).select("r.*")


def performance_check(df: DataFrame, label: str, score: str, threshold: float) -> DataFrame:
    """The stored-model check: rounded recall and AUC, threshold, samples; an empty input means no model."""
    m = metrics_at(df, label, score, threshold)
    return m.select((F.coalesce(F.col("n_samples"), F.lit(0)) > 0).alias("model_available"),
                    F.round("recall", 4).alias("recall"), F.round("auc_roc", 4).alias("auc_roc"), "threshold",
                    F.coalesce("n_samples", F.lit(0)).alias("n_samples"))


def validation_metrics(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    return metrics_at(df, label, score, 0.5, by).select(*by, "auc_roc", "recall", "n_samples")


def trial_score(df: DataFrame, label: str, score: str, threshold: float = 0.5, metric: str = "f1",
                by: Sequence[str] = ()) -> DataFrame:
    """The value a parameter search maximises; a missing or non-finite one counts as 0."""
    name = "auc_roc" if metric == "auc" else metric
    m = metrics_at(df, label, score, threshold, by)
    value = F.when(~F.isnan(name) & (F.abs(F.col(name)) != float("inf")), F.col(name))
    return m.select(*by, F.coalesce(value, F.lit(0.0)).alias("trial_score"))


def linear_contributions(df: DataFrame, coefficients: Mapping[str, float], keep: Sequence[str]) -> DataFrame:
    """Contribution of every feature of a linear score: coefficient * (value - mean)."""
    centre = df.agg(F.struct(*[F.avg(F.col(c).cast("double")).alias(c) for c in coefficients]).alias("m")).scalar()
    rows = df.withColumn("_m", centre)
    return rows.select(*keep, *[(F.lit(float(w)) * (F.col(c) - F.col("_m")[c])).alias(c) for c, w in coefficients.items()])


def contribution_ranking(contributions: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean absolute contribution per feature, largest first."""
    wide = contributions.agg(*[F.avg(F.abs(F.col(c))).alias(c) for c in features])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("mean_abs")) for c in features])
    return wide.select(F.explode(rows).alias("r")).select("r.*").orderBy(F.col("mean_abs").desc(), "feature")


def highest_risk_contributions(contributions: DataFrame, features: Sequence[str], score: str, keys: Sequence[str],
                               n_rows: int = 10, k: int = 5) -> DataFrame:
    """The rows with the highest score, each with its k largest contributions by size."""
    top = contributions.orderBy(F.col(score).desc(), *keys).limit(n_rows)
    each = F.array(*[F.struct(F.abs(F.col(c)).alias("size"), F.lit(c).alias("feature"), F.col(c).alias("contribution"))
                     for c in features])
    best = F.slice(F.sort_array(each, asc=False), 1, k)
    return (top.select(*keys, score, F.posexplode(best).alias("rank", "c"))
            .select(*keys, score, (F.col("rank") + 1).alias("rank"), "c.feature", "c.contribution"))


def top_k_per_group(df: DataFrame, group: Sequence[str], order: str, k: int, tie: Sequence[str] = ()) -> DataFrame:
    """The k largest rows per group. Spark limits every task to k rows per group before the
    shuffle, so a heavy group does not travel whole."""
    w = Window.partitionBy(*group).orderBy(F.col(order).desc(), *tie)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
