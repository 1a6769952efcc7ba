"""Words, scratch tables and bounded filters shared by the corpus operators."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from leadtime import session

__all__ = ["SPACE", "bits_table", "cut_lineage", "discard", "lower_words", "maybe_in", "read", "scratch_path", "settle", "small_batches", "stored", "words"]

#: What separates words: blank, and the five control characters 0x09 to 0x0D.
SPACE = r"[\x20\x09-\x0D]+"


#: While set, the shuffle files of a query are deleted when it ends. The written table is all that later jobs read.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Limits the bytes of a batch of rows on its way to a Python worker; the limit while ``small_batches`` holds.
BATCH_LIMIT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20

#: Share of the driver's heap in use from which it drops finished queries when a scratch table is written.
FULL = 1 / 3

#: Scratch tables of this driver, in the order in which they were made.
MADE: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, remembered so that a pipeline can delete it once its stage is over."""
    MADE.append(session.scratch_path(spark, name))
    return MADE[-1]


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write the rows once to the shared folder and go on from that table."""
    return stored(df, name)[0]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def words(text: Column) -> Column:
    """The words of a text in order; none for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def lower_words(text: Column) -> Column:
    """The words of a text with A-Z made small. One replacement of characters also turns what separates words into blanks, and
    splitting at a blank needs no pattern."""
    small = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n\x0b\x0c\r", "abcdefghijklmnopqrstuvwxyz     ")
    return F.array_remove(F.split(small, " "), "")


def bits_table(keys: DataFrame, key: str, log2_bits: int) -> DataFrame:
    """A bitmap of hashed keys as a table (slot, bits): at most ``2 ** (log2_bits - 6)`` rows for any input.

    The bound makes it safe to broadcast. It only thins out rows before an
    exact join: with many keys it fills up and lets more rows through.
    """
    at = F.pmod(F.col(key), F.lit(1 << log2_bits))
    return (keys.select(F.shiftright(at, 6).alias("_slot"), (at % 64).cast("int").alias("_bit"))
            .groupBy("_slot").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_bits")))


def maybe_in(df: DataFrame, key: str, bits: DataFrame, log2_bits: int) -> DataFrame:
    """Rows whose key may be among the keys of ``bits_table`` (never loses one that is)."""
    at = F.pmod(F.col(key), F.lit(1 << log2_bits))
    hit = F.expr(f"getbit(_bits, cast(pmod({key}, 64L) as int)) = 1")
    return (df.withColumn("_slot", F.shiftright(at, 6)).join(F.broadcast(bits), "_slot").where(hit).drop("_slot", "_bits"))


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Queries that are run meanwhile send their rows to Python workers a few megabytes at a time.

    A batch lies outside the heap, twice over while it grows, and what was allocated for large ones is hardly given back.
    """
    before = spark.conf.get(BATCH_LIMIT)
    spark.conf.set(BATCH_LIMIT, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(BATCH_LIMIT, before)


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The rows written to a new table in the shared folder and read back from it, and the table's path (see ``discard``)."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(SHUFFLES_GO) if before is None else spark.conf.set(SHUFFLES_GO, before)
    heap = spark._jvm.java.lang.Runtime.getRuntime()
    if heap.totalMemory() - heap.freeMemory() > FULL * heap.maxMemory():
        settle(spark)  # else the heap grows to its limit first, and what it has touched is not given back
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that no later job reads."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def settle(spark: SparkSession) -> None:
    """Let the driver drop what it holds of finished queries: plans, generated classes, buffers, and with them shuffles and broadcasts.

    A chain of many short queries leaves far more of these than a collector takes away by itself before its heap is full.
    """
    gc.collect()  # tables that Python no longer refers to are still referred to by their counterparts until then
    spark._jvm.System.gc()
