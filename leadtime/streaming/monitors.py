"""Windowed monitoring of prediction events.

The same functions run on a stored table and on a stream. On a stream the
watermark bounds the state: windows older than the delay are closed and dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from leadtime.fixed_values import LATENCY_BOUNDS
from leadtime.functions.numeric import ratio_or_zero


def timed(df: DataFrame, time: str, delay: str = "1 hour") -> DataFrame:
    """Event time as TIMESTAMP, with a watermark when the input is a stream."""
    typed = df.withColumn(time, F.col(time).cast("timestamp"))
    return typed.withWatermark(time, delay) if df.isStreaming else typed


def _seconds(length: str) -> float:
    number, unit = length.split()
    return float(number) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]


def _windowed(df: DataFrame, time: str, length: str, slide: str | None, by: Sequence[str], **aggregates) -> DataFrame:
    w = F.window(time, length, slide) if slide else F.window(time, length)
    out = df.groupBy(w, *by).agg(*[a.alias(n) for n, a in aggregates.items()])
    return out.select(F.col("window.start").alias("window_start"), *by, *aggregates)


def request_rate(df: DataFrame, time: str, by: Sequence[str], length: str = "1 minute", slide: str | None = None) -> DataFrame:
    """Requests per second and window for each label."""
    out = _windowed(df, time, length, slide, by, n=F.count("*"))
    return out.withColumn("per_second", F.col("n") / _seconds(length))


def error_rate(df: DataFrame, time: str, status: str, by: Sequence[str] = (), length: str = "1 minute",
               slide: str | None = None) -> DataFrame:
    """Server errors per second, and their share of all requests of the window."""
    out = _windowed(df, time, length, slide, by, n=F.count("*"), n_errors=F.count(F.when(F.col(status) >= 500, 1)))
    return out.withColumns({"errors_per_second": F.col("n_errors") / _seconds(length),
                            "error_share": F.col("n_errors") / F.col("n")})


def sliding_rates(df: DataFrame, time: str, by: Sequence[str] = (), status: str | None = None, length: str = "5 minutes",
                  slide: str = "1 minute") -> DataFrame:
    """Requests per second of overlapping windows, and with a status column the share of server errors.

    Events are counted once, into panes as long as the slide; a window adds up its panes. So an event is not copied into
    every window that holds it, and state holds panes. On a stream both steps close with the watermark (append mode).
    """
    if _seconds(length) % _seconds(slide):
        raise ValueError(f"{length} is no multiple of {slide}")
    counts = {"n": F.count("*"), **({"n_errors": F.count(F.when(F.col(status) >= 500, 1))} if status else {})}
    panes = df.groupBy(F.window(time, slide), *by).agg(*[c.alias(n) for n, c in counts.items()])
    wide = panes.groupBy(F.window(F.window_time("window"), length, slide), *by).agg(*[F.sum(n).alias(n) for n in counts])
    out = wide.select(F.col("window.start").alias("window_start"), *by, *counts).withColumn("per_second", F.col("n") / _seconds(length))
    return out.withColumn("error_share", F.col("n_errors") / F.col("n")) if status else out


def closed_windows(df: DataFrame, events: DataFrame, time: str, length: str, delay: str = "1 hour") -> DataFrame:
    """Of a stored table's windows, those that a stream with this delay has closed after all events."""
    newest = events.agg(F.max(F.unix_micros(time)).alias("at")).scalar()
    end = F.unix_micros("window_start") + F.lit(int(_seconds(length) * 1e6))
    return df.where(end <= newest - F.lit(int(_seconds(delay) * 1e6)))


def label_counts(df: DataFrame, time: str, by: Sequence[str], length: str = "1 minute", slide: str | None = None) -> DataFrame:
    """Predictions per label (risk band and version, or A/B role) and their rate."""
    return request_rate(df, time, by, length, slide)


def mean_latency(df: DataFrame, time: str, latency: str, by: Sequence[str] = (), length: str = "5 minutes",
                 slide: str | None = None) -> DataFrame:
    """Mean latency in milliseconds; the latency column is in seconds."""
    return _windowed(df, time, length, slide, by, n=F.count(latency), mean_ms=F.avg(latency) * 1000)


def bucket_quantile(cumulative: Sequence[Column], total: Column, bounds: Sequence[float], q: float) -> Column:
    """Quantile from cumulative bucket counts, linear within the bucket; beyond the last bound, that bound."""
    rank = F.lit(float(q)) * total
    out = None
    for i, upper in enumerate(bounds):
        lower = F.lit(float(bounds[i - 1]) if i else 0.0)
        before = cumulative[i - 1] if i else F.lit(0)
        inside = lower + (F.lit(float(upper)) - lower) * ratio_or_zero(rank - before, cumulative[i] - before)
        hit = cumulative[i] >= rank
        out = F.when(hit, inside) if out is None else out.when(hit, inside)
    return F.when(total > 0, out.otherwise(F.lit(float(bounds[-1]))))


def latency_quantiles(df: DataFrame, time: str, latency: str, quantiles: Sequence[float] = (0.5, 0.95, 0.99),
                      by: Sequence[str] = (), length: str = "1 minute", slide: str | None = None,
                      bounds: Sequence[float] = tuple(LATENCY_BOUNDS)) -> DataFrame:
    """Quantiles in milliseconds from fixed buckets: a few counters per window, however many requests."""
    counters = {f"le_{i}": F.count(F.when(F.col(latency) <= b, 1)) for i, b in enumerate(bounds)}
    out = _windowed(df, time, length, slide, by, n=F.count(latency), **counters)
    cumulative = [F.col(f"le_{i}") for i in range(len(bounds))]
    return out.select("window_start", *by, "n", *[
        (bucket_quantile(cumulative, F.col("n"), bounds, q) * 1000).alias(f"p{int(round(q * 100))}_ms") for q in quantiles])


def latest_gauge(df: DataFrame, time: str, by: Sequence[str], value: str) -> DataFrame:
    """The most recent value per label."""
    newest = F.max(F.struct(F.col(time).alias("at"), F.col(value).alias("value")))
    return df.groupBy(*by).agg(newest.alias("_g")).select(*by, F.col("_g.value").alias("value"), F.col("_g.at").alias("at"))


def fold_gauge(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """The most recent of several rows of ``latest_gauge`` per label."""
    return latest_gauge(df, "at", by, "value")


def fold_totals(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """The sum of several rows of ``running_totals`` per label."""
    return df.groupBy(*by).agg(*[F.sum(c).alias(c) for c in df.columns if c not in by])


def running_totals(df: DataFrame, by: Sequence[str], status: str | None = None) -> DataFrame:
    """Requests and errors so far."""
    aggregates = [F.count("*").alias("n_requests")]
    if status:
        aggregates.append(F.count(F.when(F.col(status) >= 500, 1)).alias("n_errors"))
    return df.groupBy(*by).agg(*aggregates)
