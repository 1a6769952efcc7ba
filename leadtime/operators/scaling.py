"""Standardisation with population moments; the fitted parameters are a one-row table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from leadtime.operators.cleaning import align_for_scoring, sanitize


def fit_scaler(df: DataFrame, columns: Sequence[str], where: Column | None = None) -> DataFrame:
    """One row, one struct(mean, std) per column; a zero deviation becomes 1.

    ``where`` restricts the rows the parameters come from (e.g. the training
    split); all columns are fitted in a single pass.
    """
    rows = df if where is None else df.where(where)
    def param(c: str) -> str:
        std = f"stddev_pop(CAST(`{c}` AS DOUBLE))"
        return (f"named_struct('mean', coalesce(avg(CAST(`{c}` AS DOUBLE)), 0D), "
                f"'std', coalesce(nullif({std}, 0D), 1D)) AS `{c}`")

    return rows.agg(*[F.expr(param(c)) for c in columns])


def apply_scaler(df: DataFrame, params: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Standardise the columns that exist; the parameters arrive as a scalar subquery, not a join."""
    chosen = [c for c in (columns or params.columns) if c in df.columns and c in params.columns]
    scaled = {c: F.expr(f"(CAST(`{c}` AS DOUBLE) - _params.`{c}`.mean) / _params.`{c}`.std") for c in chosen}
    return df.withColumn("_params", params.select(F.struct(*chosen)).scalar()).withColumns(scaled).drop("_params")


def prepare_training(df: DataFrame, features: Sequence[str], scaled: Sequence[str], keep: Sequence[str],
                     where: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Sanitised and scaled features beside the kept columns, and the fitted parameters."""
    clean = sanitize(df, features, keep)
    params = fit_scaler(clean, [c for c in scaled if c in features], where)
    return apply_scaler(clean, params), params


def prepare_inference(df: DataFrame, features: Sequence[str], params: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """New rows aligned to the feature list and scaled with stored parameters."""
    return apply_scaler(align_for_scoring(df, features, keep), params)
