"""A feature table kept in versions, safe with several writers.

A save writes its files under a name of its own and then claims the next free version with one record, which
only one writer can create. A version exists once its record does, so readers see whole versions only, two saves at once give
two versions, and a failed job leaves the former version as it was.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from leadtime.operators.cleaning import read_columns
from leadtime.operators.profile import fingerprint
from leadtime.sources import commits

META = ("version int, dataset_version string, n_rows bigint, n_columns int, dataset_hash string, "
        "columns array<string>, place string, created_at timestamp")


class FeatureTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def versions(self) -> DataFrame:
        """All versions with the one before each."""
        try:
            records = self.spark.read.schema(META).json(f"{self.root}/commits")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            records = self.spark.createDataFrame([], META)
        # one short record per save: the whole history is one small group
        known = records.agg(F.sort_array(F.collect_list("version")).alias("_v")).scalar()
        before = F.filter("_known", lambda v: v < F.col("version"))
        return (records.withColumn("_known", known).withColumn("previous_version", F.array_max(before)).drop("_known"))

    def latest(self) -> int:
        return max(commits.records(self.spark, f"{self.root}/commits"), default=0)

    def save(self, df: DataFrame, scaler: DataFrame | None = None, dataset_version: str = "v1") -> int:
        """Store a new version and return its number."""
        place = f"{self.root}/rows/{uuid.uuid4().hex}"
        df.write.parquet(f"{place}/data")
        if scaler is not None:
            scaler.write.parquet(f"{place}/scaler")
        stored = self.spark.read.parquet(f"{place}/data")
        facts = fingerprint(stored, stored.columns).first()
        record = {"dataset_version": dataset_version, "n_rows": facts["n_rows"], "n_columns": len(stored.columns), "dataset_hash": facts["hash_sum"],
                  "columns": stored.columns, "place": place, "created_at": datetime.now(timezone.utc).isoformat()}
        version = self.latest() + 1
        while not commits.publish(self.spark, f"{self.root}/commits/{version}", json.dumps({"version": version, **record})):
            version += 1  # another writer was first
        return version

    def _place(self, version: int | None) -> str:
        found = commits.records(self.spark, f"{self.root}/commits")
        v = version or max(found, default=0)
        if v not in found:
            raise FileNotFoundError(f"no feature table below {self.root}" + (f" with version {v}" if v else ""))
        return json.loads(commits.text_of(self.spark, found[v]))["place"]

    def load(self, columns: Sequence[str] | None = None, version: int | None = None) -> DataFrame:
        """The newest (or a given) version; listed columns it lacks are 0."""
        df = self.spark.read.parquet(f"{self._place(version)}/data")
        return read_columns(df, columns) if columns else df

    def scaler(self, version: int | None = None) -> DataFrame:
        return self.spark.read.parquet(f"{self._place(version)}/scaler")

    def clean_up(self, keep: int) -> list[int]:
        """Drop the files of all but the newest ``keep`` versions; their records stay. Returns the dropped versions."""
        found = commits.records(self.spark, f"{self.root}/commits")
        old = sorted(found)[:-keep] if keep else sorted(found)
        for v in old:
            commits.discard(self.spark, json.loads(commits.text_of(self.spark, found[v]))["place"])
        return old
