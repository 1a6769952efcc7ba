"""The cleaning job: raw event files to typed tables, with rejected lines and a profile of every table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from leadtime.operators import cleaning, profile
from leadtime.sources.tables import read_dirty_csv, write_table


def clean_events(spark: SparkSession, shards: Mapping[str, Sequence[str]], schema: str, out: str, key: str, dates: Sequence[str],
                 cohort: DataFrame | None = None, time: str = "event_date") -> None:
    """Each table of raw files becomes ``out/<name>``, its rejected lines ``out/rejected/table=<name>``.

    Rows outside the cohort go before anything is parsed. Date texts are parsed tolerantly, and the event's time is the first of
    ``dates`` that a row has. The raw files are read once for the rows and once for the rejected lines.
    """
    for name, paths in shards.items():
        rows, rejected = read_dirty_csv(spark, list(paths), schema)
        rows = cleaning.normalise_key(rows, key)
        if cohort is not None:
            rows = cleaning.restrict_to(rows, cohort, key)
        rows = cleaning.event_date(cleaning.parse_dates(rows, list(dates)), dates, time, per_row=True)
        write_table(rows, f"{out}/{name}")
        rejected.write.mode("overwrite").parquet(f"{out}/rejected/table={name}")


def cleaning_profile(spark: SparkSession, names: Sequence[str], out: str, amount: str, time: str = "event_date") -> DataFrame:
    """Per table: rows, valid and missing times, first and last time, the amounts' sum, rejected lines."""
    tables = [spark.read.parquet(f"{out}/{n}").select(F.lit(n).alias("table"), time, amount) for n in names]
    rows = cleaning.union_all(tables)
    facts = profile.time_profile(rows, time, ["table"])
    sums = rows.groupBy("table").agg(F.sum(amount).alias("amount"))
    bad = spark.read.parquet(f"{out}/rejected").groupBy(F.col("table").cast("string").alias("table")).agg(F.count("*").alias("n_rejected"))
    return facts.join(sums, "table").join(bad, "table", "left").fillna(0, ["n_rejected"])
