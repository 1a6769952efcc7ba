"""Numbers: tolerant casts, clips, ratios, right-closed bins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegralType


def safe_numeric(value: Column | str, fill: float | None = 0.0) -> Column:
    """Double, with unparsable, NaN and infinite values replaced by ``fill``; a str is a column name."""
    if isinstance(value, str):
        x = f"try_cast(`{value}` AS DOUBLE)"
        finite = f"CASE WHEN NOT isnan({x}) AND abs({x}) <> double('Infinity') THEN {x} END"
        return F.expr(finite if fill is None else f"coalesce({finite}, {float(fill)!r}D)")
    number = value.try_cast("double")
    finite = F.when(~F.isnan(number) & (F.abs(number) != float("inf")), number)
    return finite if fill is None else F.coalesce(finite, F.lit(float(fill)))


def safe_columns(df: DataFrame, names: Sequence[str], default: float = 0.0) -> dict[str, Column]:
    """The named columns as safe numbers; absent ones are the default.

    Whole-number columns can be neither NaN nor infinite, so only their NULLs are filled.
    """
    fields = {f.name: f for f in df.schema.fields}
    out = {}
    for name in names:
        field = fields.get(name)
        if field is None:
            out[name] = F.lit(float(default))
        elif isinstance(field.dataType, IntegralType):
            number = f"CAST(`{name}` AS DOUBLE)"
            out[name] = F.expr(f"coalesce({number}, {float(default)!r}D)" if field.nullable else number)
        else:
            out[name] = safe_numeric(name, default)
    return out


def column_or(df: DataFrame, name: str, default: float = 0.0) -> Column:
    """The named column as a safe number, or the default where the table has no such column."""
    return safe_columns(df, [name], default)[name]


def as_target(value: Column) -> Column:
    """Integer label; whatever is not a number becomes 0."""
    return safe_numeric(value, 0.0).cast("int")


def clip(value: Column, low: float | None, high: float | None) -> Column:
    """Bound a value; NULL stays NULL (``greatest``/``least`` alone would drop it)."""
    bounded = value
    if low is not None:
        bounded = F.greatest(bounded, F.lit(low))
    if high is not None:
        bounded = F.least(bounded, F.lit(high))
    return F.when(value.isNotNull(), bounded)


def smoothed_ratio(numerator: Column, denominator: Column) -> Column:
    return numerator / (denominator + F.lit(1))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is NULL."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def add_all(values: Sequence[Column], empty: float = 0.0) -> Column:
    return reduce(lambda a, b: a + b, values) if values else F.lit(empty)


def right_closed_bin(value: Column, edges: Sequence[float], labels: Sequence) -> Column:
    """``(e0, e1] -> labels[0]`` and so on, the lowest edge included; outside -> NULL."""
    if len(labels) != len(edges) - 1:
        raise ValueError("one label per interval is needed")
    chosen = F.when(value < F.lit(edges[0]), F.lit(None))
    for upper, label in zip(edges[1:], labels):
        chosen = chosen.when(value <= F.lit(upper), F.lit(label))
    return chosen


def right_closed_ordinal(value: Column, edges: Sequence[float], outside: float = 1.0) -> Column:
    """Index of the right-closed interval as a double; outside or NULL -> ``outside``."""
    labels = [float(i) for i in range(len(edges) - 1)]
    return F.coalesce(right_closed_bin(value, edges, labels), F.lit(outside))


def uniform_hash(*keys: Column, seed: int | str = 0) -> Column:
    """A number in [0, 1) that depends on the keys and the seed only.

    Built on md5, so it is the same on every run, partitioning and engine.
    """
    text = F.concat_ws("|", *[k.cast("string") for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
