"""Scoring rows with a model's probability: linear scores, bands, A/B routing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from leadtime.fixed_values import CHALLENGER_SHARE, RISK_LABELS, SCORE_THRESHOLD
from leadtime.functions.numeric import add_all, clip


def logistic(coefficients: Mapping[str, float], intercept: float) -> Column:
    z = add_all([F.lit(float(w)) * F.col(c) for c, w in coefficients.items()]) + F.lit(float(intercept))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def bounded(score: Column) -> Column:
    return clip(score, 0.0, 1.0)


def risk_band(score: Column, threshold: float = SCORE_THRESHOLD, labels: Sequence[str] = RISK_LABELS) -> Column:
    """High from the threshold on, moderate from half of it, low below."""
    high, moderate, low = labels
    half = max(0.0, min(1.0, threshold * 0.5))
    return F.when(score >= threshold, high).when(score >= half, moderate).otherwise(low)


def route(keys: Sequence[str], share: int = CHALLENGER_SHARE, enabled: bool = True) -> Column:
    """'challenger' for ``share`` of 100 hash groups of the key, else 'champion'; the same key stays in its group."""
    if not enabled:
        return F.lit("champion")
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    group = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % 100
    return F.when(group < share, "challenger").otherwise("champion")


def score_rows(df: DataFrame, score: Column, version: str | Column, threshold: float = SCORE_THRESHOLD,
               labels: Sequence[str] = RISK_LABELS) -> DataFrame:
    """Bound the score, band it, and round it for output. The band uses the unrounded score."""
    p = bounded(score)
    v = version if isinstance(version, Column) else F.lit(version)
    return df.withColumn("_p", p).withColumns({
        "probability": F.round("_p", 4), "risk": risk_band(F.col("_p"), threshold, labels),
        "threshold_used": F.lit(float(threshold)), "model_version": F.concat(F.lit("v"), v.cast("string"))}).drop("_p")


def score_with_roles(df: DataFrame, champion: Column, challenger: Column, champion_version: str,
                     challenger_version: str, keys: Sequence[str], share: int = CHALLENGER_SHARE,
                     threshold: float = SCORE_THRESHOLD, labels: Sequence[str] = RISK_LABELS) -> DataFrame:
    """Route each row to a model by its key and score it with that model."""
    routed = df.withColumn("role", route(keys, share))
    other = F.col("role") == "challenger"
    return score_rows(routed, F.when(other, challenger).otherwise(champion),
                      F.when(other, F.lit(challenger_version)).otherwise(F.lit(champion_version)), threshold, labels)
