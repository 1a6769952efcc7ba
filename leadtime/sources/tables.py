"""Raw CSV files, stored Parquet tables and their partitions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from leadtime.operators.cleaning import union_all


def read_entity_years(spark: SparkSession, paths: str | Sequence[str], schema: StructType | str, year: str,
                      pattern: str = r"^.*_((?:19|20)\d{2})_") -> DataFrame:
    """All yearly files in one scan; the year comes from the file's place (the last match counts)."""
    raw = spark.read.schema(schema).option("header", True).csv(paths)
    return raw.withColumn(year, F.regexp_extract(F.col("_metadata.file_path"), pattern, 1).try_cast("int"))


def read_event_tables(spark: SparkSession, shards: Mapping[str, Sequence[str]],
                      schemas: Mapping[str, StructType | str]) -> dict[str, DataFrame]:
    """Event tables by logical name; several shards of a table are put together by column name."""
    return {name: union_all([spark.read.schema(schemas[name]).option("header", True).csv(p) for p in paths])
            for name, paths in shards.items()}


def read_dirty_csv(spark: SparkSession, paths: str | Sequence[str], schema: str, header: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows that fit the schema, rejected lines with their file). No column may be called ``_line``.

    A line is judged as a whole, whichever columns are read later: a value of the wrong type, or too few or too many, rejects it.
    Blank lines are skipped, and with ``header`` the lines that repeat the column names. Values may be quoted, but not span lines.
    """
    raw = spark.read.text(paths).where(F.trim("value") != "")
    names = spark.createDataFrame([], schema).columns
    if header:
        raw = raw.where(F.translate("value", '" ', "") != ",".join(names))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_line"}
    read = raw.select("value", F.col("_metadata.file_path").alias("file"), F.from_csv("value", f"{schema}, _line string", options).alias("_r"))
    bad = F.col("_r._line").isNotNull()
    return read.where(~bad).select(*[F.col(f"_r.{c}").alias(c) for c in names]), read.where(bad).select(F.col("value").alias("line"), "file")


def read_tables(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """Parquet tables by name; all missing inputs are named in one error."""
    found, absent = {}, []
    for name, path in paths.items():
        try:
            found[name] = spark.read.parquet(path)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            absent.append(f"{name} ({path})")
    if absent:
        raise FileNotFoundError("missing inputs: " + ", ".join(absent))
    return found


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Parquet sink. The rebalance hint lets Spark split heavy partition values and merge small ones."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def read_split(spark: SparkSession, path: str, split: str, column: str = "split") -> DataFrame:
    """One split of a table stored by split: only its directory is read."""
    return spark.read.parquet(path).where(F.col(column) == split)
