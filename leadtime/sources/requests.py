"""Scoring requests: schema, defaults, range checks, quarantine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from leadtime.fixed_values import REQUEST_FIELDS


def request_schema(fields: Sequence[tuple] = tuple(REQUEST_FIELDS)) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind, *_ in fields)


def parse_requests(df: DataFrame, payload: str, fields: Sequence[tuple] = tuple(REQUEST_FIELDS),
                   keep: Sequence[str] = ()) -> DataFrame:
    """JSON text to typed fields; absent optional fields take their default."""
    body = F.from_json(F.col(payload), request_schema(fields)).alias("_b")
    parsed = df.select(*keep, body)
    return parsed.select(*keep, *[
        (F.col(f"_b.{name}") if default is None else F.coalesce(F.col(f"_b.{name}"), F.lit(default).cast(kind))).alias(name)
        for name, kind, default, *_ in fields])


def with_faults(df: DataFrame, fields: Sequence[tuple] = tuple(REQUEST_FIELDS)) -> DataFrame:
    """Adds the list of faults: required fields without a value and values out of range."""
    tests = []
    for name, _, _, low, high in fields:
        c = F.col(name)
        tests.append(F.when(c.isNull(), F.lit(f"{name} is required")))
        if low is not None:
            tests.append(F.when(c < low, F.lit(f"{name} is below {low}")))
        if high is not None:
            tests.append(F.when(c > high, F.lit(f"{name} is above {high}")))
    return df.withColumn("faults", F.array_compact(F.array(*tests)))


def split_requests(df: DataFrame, fields: Sequence[tuple] = tuple(REQUEST_FIELDS)) -> tuple[DataFrame, DataFrame]:
    """(valid requests, quarantined requests with their faults); no request is lost."""
    checked = with_faults(df, fields)
    return checked.where(F.size("faults") == 0).drop("faults"), checked.where(F.size("faults") > 0)
