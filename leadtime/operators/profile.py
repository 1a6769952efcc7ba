"""Summaries: label rates, parse profiles, weights, fingerprints, column profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from leadtime.functions.numeric import safe_numeric
from leadtime.operators.prefix import rank_values


def label_rates(df: DataFrame, label: str, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n_rows"), F.avg(F.col(label).cast("double")).alias("rate"))


def time_profile(df: DataFrame, time: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows, valid times, their share in percent, first and last time, missing times."""
    valid = F.count(time)
    return df.groupBy(*by).agg(
        F.count("*").alias("n_rows"), valid.alias("n_valid"),
        (100.0 * valid / F.greatest(F.count("*"), F.lit(1))).alias("pct_valid"),
        F.min(time).alias("first_time"), F.max(time).alias("last_time"),
        (F.count("*") - valid).alias("n_missing"))


def distinct_sorted(df: DataFrame, column: Column, name: str) -> DataFrame:
    return df.select(column.alias(name)).where(F.col(name).isNotNull()).distinct().orderBy(name)


def imbalance_weight(df: DataFrame, label: str) -> DataFrame:
    """negatives / max(positives, 1), one row."""
    pos = F.count(F.when(F.col(label) == 1, 1))
    neg = F.count(F.when(F.col(label) == 0, 1))
    return df.agg(pos.alias("n_pos"), neg.alias("n_neg"),
                  (neg / F.greatest(pos, F.lit(1))).alias("weight"))


def balanced_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Row weight n / (2 * rows of the row's class)."""
    totals = df.agg(F.struct(F.count("*").alias("n"), F.count(F.when(F.col(label) == 1, 1)).alias("pos"))
                    .alias("t")).scalar()
    t = F.col("_totals")
    mine = F.when(F.col(label) == 1, t["pos"]).otherwise(t["n"] - t["pos"])
    return (df.withColumn("_totals", totals)
            .withColumn(name, t["n"] / (F.lit(2.0) * F.greatest(mine, F.lit(1)))).drop("_totals"))


def positive_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Row weight: the imbalance weight for positives, 1 for the others."""
    ratio = imbalance_weight(df, label).select("weight").scalar()
    return df.withColumn(name, F.when(F.col(label) == 1, ratio).otherwise(F.lit(1.0)))


def fingerprint(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row count and a hash sum that does not depend on row order.

    Each value is written with its length, so that no two rows share a text. The sum of the 60-bit hashes is a decimal.
    """
    values = [F.col(c).cast("string") for c in columns]
    text = F.concat_ws("|", *[F.coalesce(F.concat(F.length(v), F.lit(":"), v), F.lit("~")) for v in values])
    value = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(20,0)")
    return df.agg(F.count("*").alias("n_rows"),
                  F.coalesce(F.sum(value), F.lit(0)).cast("string").alias("hash_sum"))


def leaderboard(metrics: DataFrame, run: str, metric: str, value: str, ts: str, names: Sequence[str]) -> DataFrame:
    """Long metric rows to one row per run with the latest value of each named metric."""
    return metrics.groupBy(run).pivot(metric, list(names)).agg(F.max_by(value, ts))


def means(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.avg(c).alias(f"mean_{c}") for c in columns])


def melt(df: DataFrame, columns: Sequence[str], keep: Sequence[str], fill: float | None = None) -> DataFrame:
    """Rows (keep..., feature, value), one per listed column."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), safe_numeric(c, fill).alias("value"))
                      for c in columns])
    return df.select(*keep, F.explode(pairs).alias("_p")).select(*keep, "_p.feature", "_p.value")


def column_profile(df: DataFrame, columns: Sequence[str], side: str,
                   quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Per side and column: rows, share of missing, mean, population std, min, max, exact quantiles, distinct.

    Equal values collapse first; everything else is read from those counts, whose one shuffle all steps share. A quantile
    is the value at rank ceil(q * n). The std adds up squares around the mean, not around 0.
    """
    values = melt(df, columns, [side]).groupBy(side, "feature", "value").agg(F.count("*").alias("_w"))
    held = F.when(F.col("value").isNotNull(), F.col("_w"))
    weighted = F.col("value") * F.col("_w")
    stats = values.groupBy(side, "feature").agg(
        F.sum("_w").alias("n_rows"), ((F.sum("_w") - F.coalesce(F.sum(held), F.lit(0))) / F.sum("_w")).alias("null_share"),
        F.try_divide(F.sum(weighted), F.sum(held)).alias("mean"), F.min("value").alias("min"), F.max("value").alias("max"),
        F.count("value").alias("n_distinct"))
    centre = stats.select(F.col(side).alias("_s"), F.col("feature").alias("_f"), F.col("mean").alias("_m"))
    same = F.col(side).eqNullSafe(F.col("_s")) & (F.col("feature") == F.col("_f"))
    off = F.col("value") - F.col("_m")
    spread = (values.join(F.broadcast(centre), same).groupBy(side, "feature")  # a row for each side and listed column
              .agg(F.sqrt(F.try_divide(F.sum(off * off * F.col("_w")), F.sum(held))).alias("std")))
    names = {f"q{int(round(q * 100))}": f"greatest(ceil(_n * {float(q)!r}D) - 1, 0)" for q in quantiles}
    ranks = rank_values(values, "value", names, [side, "feature"], "_w").drop("n")
    out = stats
    for part in (spread, ranks):
        part = part.withColumnsRenamed({side: "_s", "feature": "_f"})
        out = out.join(part, same, "left").drop("_s", "_f")
    return out.select(side, "feature", "n_rows", "null_share", "mean", "std", "min", "max", *names, "n_distinct")
