"""Experiment runs kept as small files: ``<run>/{metrics,params,tags}/<name>``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from leadtime.sources import commits

PLACE = r"/([^/]+)/(metrics|params|tags)/([^/]+)$"


def read_runs(spark: SparkSession, root: str) -> DataFrame:
    """Rows (run_id, kind, name, value, ts, step). A metric line is ``epoch_ms value step``."""
    raw = (spark.read.text(f"{root.rstrip('/')}/*/{{metrics,params,tags}}/*")
           .select("value", F.col("_metadata.file_path").alias("_path")))
    where = raw.select("value", *[F.regexp_extract("_path", PLACE, i).alias(n)
                                  for i, n in ((1, "run_id"), (2, "kind"), (3, "name"))])
    part = F.split(F.trim("value"), r"\s+")
    metric = F.col("kind") == "metrics"
    return where.select(
        "run_id", "kind", "name",
        F.when(metric, F.get(part, F.lit(1))).otherwise(F.col("value")).alias("value"),
        F.when(metric, F.get(part, F.lit(0)).try_cast("bigint")).alias("ts"),
        F.when(metric, F.get(part, F.lit(2)).try_cast("int")).alias("step"))


def write_run(spark: SparkSession, root: str, run: str, metrics: Mapping[str, Sequence[tuple[int, float, int]]],
              params: Mapping[str, object] | None = None, tags: Mapping[str, object] | None = None) -> None:
    """The files of one finished run: a metric has lines (epoch_ms, value, step), a parameter or tag one value. A run is written once."""
    files = {f"metrics/{n}": "\n".join(f"{ts} {value!r} {step}" for ts, value, step in lines) for n, lines in metrics.items()}
    files |= {f"params/{n}": str(v) for n, v in (params or {}).items()} | {f"tags/{n}": str(v) for n, v in (tags or {}).items()}
    for name, text in files.items():
        if not commits.publish(spark, f"{root.rstrip('/')}/{run}/{name}", text):
            raise FileExistsError(f"run {run} has {name} already")


def append_run(rows: DataFrame, path: str) -> None:
    """Add long run rows (run_id, kind, name, value) to the log table."""
    rows.withColumn("logged_at", F.current_timestamp()).write.mode("append").parquet(path)
