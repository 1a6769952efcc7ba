"""Fixed virtual slots: records are hashed into slots, and a versioned map deals the slots to shards.

A record never changes its slot. Only the small map from slots to shards is
edited when shards fill unevenly or are added, so that an edit moves whole
slots and nothing else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

SLOTS = 4096


def virtual_slot(key: Column, slots: int = SLOTS) -> Column:
    """The slot of a key; NULL has a slot as well."""
    return F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")


def slot_bytes(records: DataFrame, slot: str = "virtual_slot", size: str = "size") -> DataFrame:
    """Bytes and rows of each slot (slots without rows are left out)."""
    return records.groupBy(slot).agg(F.sum(size).alias("bytes"), F.count("*").alias("rows"))


def first_map(sizes: DataFrame, shards: int, slots: int = SLOTS, slot: str = "virtual_slot") -> DataFrame:
    """Version 1 of the map (version, slot, shard): the heaviest slot goes to the lightest shard, and so on.

    One row per slot is folded, a number fixed by ``slots`` whatever the size of
    the records. Ties go to the smaller slot and the smaller shard. Slots
    without records are dealt as well, with zero bytes.
    """
    every = sizes.sparkSession.range(slots).select(F.col("id").cast("int").alias(slot))
    heavy = (every.join(F.broadcast(sizes), slot, "left")
             .select(F.struct((-F.coalesce(F.col("bytes"), F.lit(0))).alias("less"), F.col(slot).alias("slot")).alias("s")))
    fold = f"""aggregate(all_slots,
        named_struct('load', array_repeat(0L, {shards}), 'dealt', cast(array() as array<struct<slot:int,shard:int>>)),
        (a, s) -> transform(array(cast(array_position(a.load, array_min(a.load)) as int) - 1), k -> named_struct(
            'load', transform(a.load, (x, i) -> if(i = k, x - s.less, x)),
            'dealt', concat(a.dealt, array(named_struct('slot', s.slot, 'shard', k)))))[0]).dealt"""
    folded = heavy.agg(F.sort_array(F.collect_list("s")).alias("all_slots")).select(F.explode(F.expr(fold)).alias("d"))
    return folded.select(F.lit(1).alias("version"), F.col("d.slot").alias(slot), F.col("d.shard").alias("shard"))


def grow(current: DataFrame, sizes: DataFrame, slot: str = "virtual_slot") -> DataFrame:
    """The next version with one shard more, which takes slots from the others; no other slot moves.

    Every shard hands over slots, largest first, as long as what it gave stays
    within its share of the new mean.
    """
    sized = current.join(F.broadcast(sizes.select(slot, "bytes")), slot, "left").withColumn("bytes", F.coalesce("bytes", F.lit(0)))
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # one row per shard
    per = (sized.groupBy("shard").agg(F.sum("bytes").alias("load"))
           .withColumn("fresh", F.max("shard").over(every) + 1)
           .withColumn("mean", F.sum("load").over(every) / (F.count("*").over(every) + 1)))
    given = Window.partitionBy("shard").orderBy(F.desc("bytes"), slot)
    planned = sized.join(F.broadcast(per), "shard").withColumn("through", F.sum("bytes").over(given))
    moves = (F.col("bytes") > 0) & (F.col("through") <= F.col("load") - F.col("mean"))
    return planned.select((F.col("version") + 1).alias("version"), slot,
                          F.when(moves, F.col("fresh")).otherwise(F.col("shard")).cast("int").alias("shard"))


def save_map(slot_map: DataFrame, folder: str) -> None:
    """Add one version to the stored map; earlier versions stay for rolling back."""
    slot_map.coalesce(1).write.mode("append").partitionBy("version").parquet(folder)


def load_map(spark: SparkSession, folder: str, version: int | None = None, slot: str = "virtual_slot") -> DataFrame:
    """One stored version, the newest if none is named."""
    stored = spark.read.parquet(folder)
    wanted = F.lit(version) if version is not None else stored.agg(F.max("version")).first()[0]
    return stored.where(F.col("version") == wanted).select("version", slot, "shard")


def assign(records: DataFrame, slot_map: DataFrame, key: str = "doc_id", slot: str = "virtual_slot", piece_bits: int = 8) -> DataFrame:
    """Add ``shard`` and ``position``: the place in the shard, gapless from 0.

    Places are counted in two steps: inside a piece of a slot, and from a table
    of pieces (slots * 2 ** piece_bits rows at most), so no task holds a shard. Rows
    with one key lie in one piece, in the order of their other columns.
    """
    piece = F.pmod(F.shiftright(F.xxhash64(F.col(key), F.lit("piece")), 7), F.lit(1 << piece_bits)).cast("int")
    others = [c for c in records.columns if c not in (key, slot)]
    placed = records.withColumn("_piece", piece).join(F.broadcast(slot_map.select(slot, "shard")), slot)
    inside = Window.partitionBy(slot, "_piece").orderBy(F.col(key).asc_nulls_first(), *others)
    counts = placed.groupBy("shard", slot, "_piece").agg(F.count("*").alias("_n"))
    ahead = Window.partitionBy("shard").orderBy(slot, "_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(slot, "_piece", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_start"))
    numbered = placed.withColumn("_in", F.row_number().over(inside) - 1)
    return (numbered.join(starts, [slot, "_piece"])
            .withColumn("position", (F.col("_start") + F.col("_in")).cast("long")).drop("_start", "_in", "_piece"))
