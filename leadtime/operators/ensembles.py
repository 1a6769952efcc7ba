"""Combining the scores of several models, one DOUBLE column per model."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame, functions as F

from leadtime.fixed_values import MISSING_MODEL_SCORE, PSEUDO_LABEL_CONFIDENCE
from leadtime.functions.numeric import add_all, ratio_or_zero
from leadtime.operators.evaluation import roc_auc
from leadtime.operators.prefix import add_before


def check_weights(weights: Sequence[float], n_models: int) -> list[float]:
    if len(weights) != n_models:
        raise ValueError("one weight per model is needed")
    if any(w < 0 for w in weights):
        raise ValueError("weights must not be negative")
    if sum(weights) == 0:
        raise ValueError("the weights must not all be zero")
    return [float(w) for w in weights]


def blend(scores: Sequence[str], weights: Sequence[float]) -> str:
    """SQL text of the weighted mean of the score columns."""
    terms = " + ".join(f"{float(w)!r}D * `{c}`" for c, w in zip(scores, weights))
    return f"(({terms}) / {float(sum(weights))!r}D)"


def soft_vote(df: DataFrame, scores: Sequence[str], weights: Sequence[float] | None = None,
              name: str = "p_vote") -> DataFrame:
    """Weighted mean of both class probabilities, renormalised; the class is 1 only above one half."""
    if not scores:
        raise ValueError("no models to vote")
    w = check_weights(weights or [1.0] * len(scores), len(scores))
    one = F.expr(blend(scores, w))
    zero = add_all([F.lit(x) * (F.lit(1.0) - F.col(c)) for c, x in zip(scores, w)]) / F.lit(float(sum(w)))
    p = one / F.greatest(one + zero, F.lit(1e-12))
    return df.withColumn(name, p).withColumn("predicted", (F.col(name) > 0.5).cast("int"))


def fill_missing_models(df: DataFrame, scores: Sequence[str], fill: float = MISSING_MODEL_SCORE) -> DataFrame:
    """A model that gave no score counts with the neutral score."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(fill)) if c in df.columns else F.lit(fill) for c in scores})


def simplex_grid(n_models: int, steps: int) -> list[tuple[float, ...]]:
    """All weight vectors that are multiples of 1/steps and add up to 1."""
    out = []
    for bars in combinations(range(steps + n_models - 1), n_models - 1):
        edges = (-1, *bars, steps + n_models - 1)
        out.append(tuple((b - a - 1) / steps for a, b in zip(edges, edges[1:])))
    return sorted(out)


def blend_objectives(df: DataFrame, label: str, scores: Sequence[str], grid: Sequence[Sequence[float]],
                     objective: str = "f1", threshold: float = 0.5) -> DataFrame:
    """(weight_id, objective value) for every weight vector of a fixed list.

    For threshold metrics each row becomes a few flags per weight vector that
    are added up map-side; only one row per weight vector and task is shuffled.
    """
    blended = [f"round({blend(scores, w)}, 12)" for w in grid]
    if objective == "auc":
        each = F.expr(f"posexplode(array({', '.join(blended)}))").alias("weight_id", "_score")
        m = roc_auc(df.select(F.col(label).alias("_y"), each), "_y", "_score", ["weight_id"])
        return m.select("weight_id", F.col("auc_roc").alias("objective"))
    flags = ", ".join(f"{b} >= {float(threshold)!r}D" for b in blended)
    hits = F.expr(f"posexplode(array({flags}))").alias("weight_id", "_hit")
    true = F.col("_y") == 1
    c = (df.select(F.col(label).alias("_y"), hits).groupBy("weight_id")
         .agg(F.count(F.when(F.col("_hit") & true, 1)).alias("tp"),
              F.count(F.when(F.col("_hit") & ~true, 1)).alias("fp"),
              F.count(F.when(~F.col("_hit") & true, 1)).alias("fn")))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    value = {"f1": ratio_or_zero(2 * tp, 2 * tp + fp + fn), "precision": ratio_or_zero(tp, tp + fp),
             "recall": ratio_or_zero(tp, tp + fn)}[objective]
    return c.select("weight_id", value.alias("objective"))


def search_weights(df: DataFrame, label: str, scores: Sequence[str], grid: Sequence[Sequence[float]],
                   objective: str = "f1", threshold: float = 0.5) -> DataFrame:
    """The best weight vector as one row; among equals the one listed first."""
    tried = blend_objectives(df, label, scores, grid, objective, threshold)
    best = tried.agg(F.max(F.struct(F.col("objective"), (-F.col("weight_id")).alias("neg"))).alias("b"))
    vectors = F.expr("array(" + ", ".join("array(" + ", ".join(f"{float(x)!r}D" for x in w) + ")" for w in grid) + ")")
    chosen = best.select((-F.col("b.neg")).alias("weight_id"), F.col("b.objective").alias("objective"))
    vector = F.get(vectors, F.col("weight_id"))
    return chosen.select("weight_id", "objective", *[F.get(vector, F.lit(i)).alias(f"w_{c}") for i, c in enumerate(scores)])


def apply_weights(df: DataFrame, scores: Sequence[str], weights: Sequence[float], name: str = "p_blend") -> DataFrame:
    """Blend with stored weights; only the size of a weight counts."""
    return df.withColumn(name, F.expr(blend(scores, check_weights([abs(w) for w in weights], len(scores)))))


def pseudo_labels(df: DataFrame, score: str, confidence: float = PSEUDO_LABEL_CONFIDENCE) -> DataFrame:
    """Rows whose likelier class reaches the confidence, with that class as label."""
    p = F.col(score)
    sure = F.greatest(p, F.lit(1.0) - p)
    return (df.withColumns({"confidence": sure, "pseudo_label": (p > 0.5).cast("int")})
            .where(F.col("confidence") >= confidence))


def pseudo_label_summary(df: DataFrame, score: str, confidence: float = PSEUDO_LABEL_CONFIDENCE) -> DataFrame:
    p = F.col(score)
    kept = F.greatest(p, F.lit(1.0) - p) >= confidence
    n, k = F.count("*"), F.count(F.when(kept, 1))
    return df.agg(n.alias("n_rows"), k.alias("n_kept"), (100.0 * k / F.greatest(n, F.lit(1))).alias("coverage_pct"),
                  F.count(F.when(kept & (p <= 0.5), 1)).alias("n_class_0"),
                  F.count(F.when(kept & (p > 0.5), 1)).alias("n_class_1"))


def cross_features(df: DataFrame, scores: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Per pair of models: product, mean, max, absolute difference; and mean, std, max, min over all."""
    out = [F.col(c).alias(f"{c}_pred") for c in scores]
    for a, b in combinations(scores, 2):
        x, y = F.col(a), F.col(b)
        out += [(x * y).alias(f"{a}_x_{b}_prod"), ((x + y) / 2).alias(f"{a}_x_{b}_mean"),
                F.greatest(x, y).alias(f"{a}_x_{b}_max"), F.abs(x - y).alias(f"{a}_x_{b}_diff")]
    columns = [F.col(c) for c in scores]
    n = float(len(scores))
    mean = add_all(columns) / n
    spread = F.sqrt(add_all([(c - mean) * (c - mean) for c in columns]) / n)
    widest = F.greatest(*columns) if len(scores) > 1 else columns[0]
    smallest = F.least(*columns) if len(scores) > 1 else columns[0]
    return df.select(*keep, *out, mean.alias("pred_mean"), spread.alias("pred_std"), widest.alias("pred_max"),
                     smallest.alias("pred_min"))


def assign_folds(df: DataFrame, label: str, keys: Sequence[str], folds: int = 5, seed: int = 42,
                 name: str = "fold") -> DataFrame:
    """Stratified folds whose sizes differ by at most one per class.

    The rank of a row within its class, in the order of its md5, is its rank
    within one of 65,536 hash groups plus the sizes of the groups before it; a
    class with most of the rows is therefore spread over 65,536 window groups.
    """
    digest = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))
    rows = df.withColumns({"_digest": digest, "_one": F.lit(1).cast("bigint")}).withColumn(
        "_bucket", F.substring("_digest", 1, 4))
    ranked = add_before(rows, {"_rank": "_one"}, ["_digest", *keys], groups=[label])
    return ranked.withColumn(name, (F.col("_rank") % folds).cast("int")).drop("_digest", "_one", "_bucket", "_rank")
