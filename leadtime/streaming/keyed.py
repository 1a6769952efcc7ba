"""Keyed tables that the batches of a stream bring up to date: running totals, latest values.

The stream itself keeps no state. A batch is reduced to one row per key, folded into the rows those keys had before, and
written as new files of the buckets it touches; a commit record then says which files make up the table. A batch that is
repeated, after a crash or by a restarted job, starts again from the commit before it, so nothing counts twice.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from leadtime.sources import commits


class KeyedTable:
    """One row per key in a folder.

    ``reduce`` makes rows of the table's shape from a batch; ``fold`` makes one row per key from several such rows, in any order
    and grouping. Only buckets with keys of the batch are read and written again.
    """

    def __init__(self, spark: SparkSession, folder: str, keys: Sequence[str], reduce: Callable[[DataFrame], DataFrame],
                 fold: Callable[[DataFrame], DataFrame], buckets: int = 64):
        self.spark, self.folder, self.keys, self.buckets = spark, folder.rstrip("/"), list(keys), buckets
        self.reduce, self.fold = reduce, fold

    def _files(self, batch: int, bucket: str) -> str:
        return f"{self.folder}/rows/batch={batch}/_bucket={bucket}"

    def _state(self, before: int | None = None) -> dict[str, int]:
        """Bucket to the batch that wrote it last, as of the newest commit (below a batch)."""
        found = commits.records(self.spark, f"{self.folder}/commits")
        found = {n: p for n, p in found.items() if before is None or n < before}
        return json.loads(commits.text_of(self.spark, found[max(found)])) if found else {}

    def apply(self, batch: DataFrame, batch_id: int) -> bool:
        """Bring the table up to date with a batch; False if that batch has been committed before."""
        if batch_id in commits.records(self.spark, f"{self.folder}/commits"):
            return False
        state = self._state(batch_id)
        bucket = F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.keys]), F.lit(self.buckets))
        new = self.reduce(batch).withColumn("_bucket", bucket).persist()
        try:
            touched = sorted(str(r[0]) for r in new.select("_bucket").distinct().collect())  # at most one for each bucket
            rows, old = new.drop("_bucket"), [self._files(state[b], b) for b in touched if b in state]
            if old:
                rows = rows.unionByName(self.spark.read.schema(rows.schema).parquet(*old))
            if touched:
                (self.fold(rows).select(*rows.columns).withColumn("_bucket", bucket).repartition(len(touched), "_bucket")
                 .write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.folder}/rows/batch={batch_id}"))
        finally:
            new.unpersist()
        now = {**state, **{b: batch_id for b in touched}}
        return commits.publish(self.spark, f"{self.folder}/commits/{batch_id}", json.dumps(now, sort_keys=True))

    def read(self) -> DataFrame:
        """The table as of the newest commit."""
        state = self._state()
        if not state:
            raise ValueError(f"{self.folder} has no committed batch with rows")
        return self.spark.read.parquet(*[self._files(n, b) for b, n in sorted(state.items())])

    def clean_up(self, keep: int = 2) -> list[int]:
        """Delete the files of batches that none of the newest ``keep`` commits refers to; returns these batches."""
        found = commits.records(self.spark, f"{self.folder}/commits")
        newest = sorted(found)[-keep:]
        used = {n for c in newest for n in json.loads(commits.text_of(self.spark, found[c])).values()}
        gone = [n for n in sorted(found) if n not in used and n not in newest]
        for n in gone:
            commits.discard(self.spark, f"{self.folder}/rows/batch={n}")
        return gone
