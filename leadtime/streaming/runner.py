"""Running the monitors as streaming jobs over files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from leadtime.session import scratch_path
from leadtime.streaming.keyed import KeyedTable


def read_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def run_aggregate(stream: DataFrame, out: str, checkpoint: str, mode: str = "complete") -> None:
    """Process all that has arrived. Each batch has its own folder, so a repeated batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    query = (stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
             .foreachBatch(write).trigger(availableNow=True).start())
    query.awaitTermination()


def run_append(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Rows that need no aggregate go to the exactly-once file sink."""
    query = (stream.writeStream.outputMode("append").format("parquet").option("path", out)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()


def complete_result(stream: DataFrame) -> DataFrame:
    """The table a complete-mode job leaves after all available input: its last batch."""
    spark = stream.sparkSession
    out, checkpoint = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-state")
    run_aggregate(stream, out, checkpoint)
    batches = spark.read.parquet(out)
    last = batches.agg({"batch": "max"}).first()[0]
    return batches.where(batches["batch"] == last).drop("batch")


def append_result(stream: DataFrame) -> DataFrame:
    spark = stream.sparkSession
    out, checkpoint = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-state")
    run_append(stream, out, checkpoint)
    return spark.read.parquet(out)


def run_closed(stream: DataFrame, out: str, checkpoint: str) -> list[dict[str, int]]:
    """Append mode: each window is written once, when the watermark has passed its end, and leaves the state.

    Rows for windows that are closed already are dropped. Returns, for every batch, the rows it read, the rows in state after it and
    the rows it dropped for being late.
    """
    query = (stream.writeStream.outputMode("append").format("parquet").option("path", out)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return [{"batch": p["batchId"], "n_input": p["numInputRows"], "n_state": sum(s["numRowsTotal"] for s in p["stateOperators"]),
             "n_late": sum(s["numRowsDroppedByWatermark"] for s in p["stateOperators"])} for p in query.recentProgress]


def closed_result(stream: DataFrame) -> DataFrame:
    """The windows that an append-mode job has closed after all available input."""
    spark = stream.sparkSession
    out, checkpoint = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-state")
    run_closed(stream, out, checkpoint)
    return spark.read.schema(stream.schema).parquet(out)


def run_keyed(stream: DataFrame, table: KeyedTable, checkpoint: str) -> None:
    """Bring a keyed table up to date with all that has arrived; batches may repeat."""
    query = (stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda rows, n: table.apply(rows, n) and None)
             .trigger(availableNow=True).start())
    query.awaitTermination()
