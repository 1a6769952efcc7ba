"""Flags: code tests, code maps, counts and weighted sums of flags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from leadtime.functions.numeric import add_all, clip, flag, safe_numeric


def code_flag(value: Column, true_codes: Sequence[float] = (1,)) -> Column:
    """1 where the code is one of ``true_codes``; missing and other codes are 0."""
    # NaN and infinity equal no code, so the plain cast is enough
    return flag(value.try_cast("double").isin([float(c) for c in true_codes]))


def clip_flag(value: Column) -> Column:
    """The integer value bounded to 0..1 (a code 2 becomes 1)."""
    return clip(safe_numeric(value, 0.0).cast("int"), 0, 1)


def map_codes(value: Column, mapping: Mapping[str, float], other: float = 0) -> Column:
    """Look codes up in a fixed mapping; unknown and missing codes become ``other``."""
    chosen = None
    for code, result in mapping.items():
        hit = value.cast("string") == F.lit(str(code))
        chosen = F.when(hit, F.lit(result)) if chosen is None else chosen.when(hit, F.lit(result))
    return F.lit(other) if chosen is None else chosen.otherwise(F.lit(other))


def count_flags(flags: Sequence[Column]) -> Column:
    return add_all(list(flags), 0)


def weighted_index(weights: Mapping[str, float], columns: Sequence[str]) -> Column:
    """Sum of ``column * weight`` over the weighted columns that exist."""
    return add_all([F.col(c) * F.lit(w) for c, w in weights.items() if c in columns], 0)
