"""Reports as nested rows: JSON sinks, run history, archive, scan with a default."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F


def write_report(report: DataFrame, path: str) -> None:
    """Replace the current report. A report is one row."""
    report.write.mode("overwrite").json(path)


def append_history(report: DataFrame, path: str) -> None:
    """Add the report to the run history, one JSON line per run."""
    report.write.mode("append").json(path)


def archive_report(report: DataFrame, path: str, run: str) -> None:
    """Keep a copy under its run label; running the same label again replaces its copy."""
    report.write.mode("overwrite").json(f"{path.rstrip('/')}/run={run}")


def read_report(spark: SparkSession, path: str, schema: str, default: Mapping | None = None) -> DataFrame:
    """The stored report, or one row of defaults when there is none."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
    empty = spark.createDataFrame([], schema)
    row = tuple((default or {}).get(c) for c in empty.columns)
    return spark.createDataFrame([row], schema) if default is not None else empty


def with_run(report: DataFrame, run: str) -> DataFrame:
    return report.withColumn("run", F.lit(run))
