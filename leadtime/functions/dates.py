"""Dates: tolerant parsing, observation dates, look-back and forward windows."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from leadtime.fixed_values import DAYS_PER_YEAR


def parse_yyyymmdd(value: Column, dtype: str | None = None) -> Column:
    """``20100312``, ``'20100312'``, ``'20100312.0'`` or a double -> DATE; anything else NULL.

    Pass ``dtype`` of the input column when it is a float: its plain text would
    be in scientific notation.
    """
    if dtype in ("double", "float"):
        value = F.when(value == F.floor(value), value.try_cast("bigint"))
    raw = F.trim(value.cast("string"))
    text = F.when(F.endswith(raw, F.lit(".0")), F.left(raw, F.length(raw) - 2)).otherwise(raw)
    digits = (F.length(text) == 8) & (F.translate(text, "0123456789", "") == "")
    # a failed cast yields NULL at once; a failed format parse would raise and catch for every bad row
    dashed = F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2))
    return F.when(digits, dashed.try_cast("date"))


def year_start(year: Column) -> Column:
    """First of January of a year column: the observation date."""
    return F.make_date(year.cast("int"), F.lit(1), F.lit(1))


def in_lookback(ts: Column, obs: Column, months: int) -> Column:
    """Half-open ``[obs - months, obs)``."""
    return (ts >= F.add_months(obs, -months)) & (ts < obs)


def in_forward(ts: Column, obs: Column, months: int) -> Column:
    """``(obs, obs + months]``: the observation day itself is excluded, the end is included."""
    return (ts > obs) & (ts <= F.add_months(obs, months))


def whole_days(ts: Column, obs: Column) -> Column:
    """Full days from ``ts`` to midnight of ``obs``, rounded down; calendar days, so no time zone matters."""
    day = F.to_date(ts)
    return (F.datediff(obs, day) - (ts > day).cast("int")).cast("bigint")


def age_years(birth: Column, obs: Column) -> Column:
    return F.datediff(obs, birth.cast("date")) / F.lit(DAYS_PER_YEAR)
