"""Row-wise composites on top of counted features; no shuffles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from leadtime.functions.flags import count_flags, weighted_index
from leadtime.functions.names import with_mark
from leadtime.functions.numeric import add_all, flag, safe_columns, smoothed_ratio


def activity_totals(df: DataFrame, parts: Mapping[str, Sequence[str]]) -> DataFrame:
    """Each output is the sum of its listed count columns."""
    v = safe_columns(df, [c for cols in parts.values() for c in cols])
    return df.withColumns({out: add_all([v[c] for c in cols]) for out, cols in parts.items()})


def presence_flags(df: DataFrame, over: Mapping[str, tuple[str, float]]) -> DataFrame:
    """Each output is 1 where its column exceeds its limit: ``{out: (column, limit)}``."""
    v = safe_columns(df, [c for c, _ in over.values()])
    return df.withColumns({out: flag(v[c] > F.lit(limit)) for out, (c, limit) in over.items()})


def smoothed_ratios(df: DataFrame, ratios: Mapping[str, tuple[str, str]]) -> DataFrame:
    v = safe_columns(df, [c for pair in ratios.values() for c in pair])
    return df.withColumns({out: smoothed_ratio(v[a], v[b]) for out, (a, b) in ratios.items()})


def newcomer_flag(df: DataFrame, counts: Sequence[str], name: str) -> DataFrame:
    """1 where all the listed counts are zero. The choice of counts is the variant."""
    none = F.lit(True)
    for v in safe_columns(df, counts).values():
        none = none & (v == 0)
    return df.withColumn(name, flag(none))


def condition_burden(df: DataFrame, weights: Mapping[str, float], count_name: str, index_name: str) -> DataFrame:
    """Number of set flags and their weighted sum; flags must be 0/1 already."""
    present = [c for c in weights if c in df.columns]
    return df.withColumns({count_name: count_flags([F.col(c) for c in present]),
                           index_name: weighted_index(weights, df.columns)})


def cost_rollup(df: DataFrame, marks: Sequence[str], name: str) -> DataFrame:
    """Sum over the columns whose name contains a mark; 0 where there are none."""
    return sum_of(df, with_mark(df.columns, marks), name)


def sum_of(df: DataFrame, columns: Sequence[str], name: str, clean: bool = False) -> DataFrame:
    """Sum of columns. ``clean`` says that they are finite numbers already, so that nothing is checked per row."""
    values = [F.col(c) for c in columns] if clean else list(safe_columns(df, columns).values())
    return df.withColumn(name, add_all(values))
