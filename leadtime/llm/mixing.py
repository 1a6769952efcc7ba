"""Mixing sources to target weights by hash thresholds found in nested histograms.

Every document has a fixed hash. A source takes whole passes over its
documents and, of the last pass, the documents below a threshold. A histogram
of words by hash bucket gives the bucket that holds the threshold; only this
bucket is split further. Nothing is sorted, and a smaller budget always takes a subset
of what a larger one takes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from leadtime.llm.common import SPACE, cut_lineage

#: Bits of a document's hash that are split off at each level; 48 bits in all.
LEVELS = (12, 12, 12, 12)
WEIGHTS = (5.0, 2.0, 1.0)


def word_count(text: Column) -> Column:
    """Number of words; 0 for NULL."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(SPACE.replace("[", "[^"))).cast("long")


def hash48(key: Column) -> Column:
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 12), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, repeat_limit: int = 3) -> DataFrame:
    """(source, source_size, target) of each source; one row per source goes through the window.

    Weights go round by the sources' code-point order, NULL last. A target never
    exceeds ``repeat_limit`` times the source's size; what is over is shared out again
    by weight, until no target is above. Sorting sources by size per weight shows
    which are held at their limit: the first ones, as many as the level allows.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights)) + 1)
    limit = (F.col("source_size") * repeat_limit)
    weighted = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
                .withColumn("_w", pick).withColumn("_cap", limit).withColumn("_ratio", limit / F.col("_w")))
    by_ratio = Window.orderBy("_ratio", F.col("source").asc_nulls_last())
    before, rest, whole = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing), \
        by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(whole) - F.coalesce(F.sum("_cap").over(before), F.lit(0))) / F.sum("_w").over(rest))
    leveled = weighted.withColumn("_level", level)
    final = F.max(F.when(F.col("_level") <= F.col("_ratio"), F.col("_level"))).over(whole)  # the first level that fits; later ones are lower
    return (leveled.withColumn("_final", final)
            .select("source", "source_size",
                    F.least(F.col("_cap").cast("double"), F.coalesce(F.col("_final") * F.col("_w"), F.col("_cap").cast("double"))).alias("target")))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[float] = WEIGHTS,
        repeat_limit: int = 3, size: Column | None = None) -> DataFrame:
    """(key, size, source, source_size, target, passes) of every row; ``passes`` is how often the mix takes it.

    A NULL source is a source of its own; a NULL or empty text has size 0 and
    follows its hash like any other. Rows with one key are taken together. A source's
    words miss its target by less than one document (or than the rows of one key).
    """
    sized = cut_lineage(docs.select(F.col(key).alias("_key"), F.col(source).alias("source"),
                                    (size if size is not None else word_count(F.col(text))).alias("size"),
                                    hash48(F.col(key)).alias("_hash")), "mix-sizes")
    targets = source_targets(sized, weights, repeat_limit)
    ratio = F.col("target") / F.col("source_size")
    passes = F.when(F.col("source_size") > 0, F.floor(ratio)).otherwise(F.lit(0)).cast("long")
    targets = cut_lineage(targets.withColumn("_full", passes)
                          .withColumn("_left", F.col("target") - F.col("_full") * F.col("source_size")), "mix-targets")
    left, keyed = 48, targets.select("source", F.col("_left").alias("_budget"), F.lit(0).cast("long").alias("_prefix"))
    for bits in LEVELS:  # a histogram of the boundary bucket only, level by level
        left -= bits
        join = F.col("s.source").eqNullSafe(F.col("k.source")) & (F.shiftright("_hash", left + bits) == F.col("_prefix"))
        counted = (sized.alias("s").join(keyed.alias("k"), join)
                   .groupBy("s.source", F.shiftright("_hash", left).alias("_bucket"))
                   .agg(F.sum("size").alias("_words"), F.first("_budget").alias("_budget")))
        w = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
        inside = counted.withColumn("_before", F.coalesce(F.sum("_words").over(w), F.lit(0)))
        over = inside.where(F.col("_before") + F.col("_words") > F.col("_budget"))
        keyed = cut_lineage(over.groupBy("source").agg(F.min(F.struct("_bucket", F.col("_budget") - F.col("_before"), "_words")).alias("_m"))
                            .select("source", F.col("_m._bucket").alias("_prefix"), F.col("_m.col2").alias("_budget"),
                                    F.col("_m._words").alias("_edge")), "mix-level")
    # the last bucket is one key in practice: it goes where the total comes nearer to the target
    last = keyed.select(F.col("source").alias("_s"), (F.col("_prefix") + F.when(F.col("_budget") * 2 >= F.col("_edge"), 1).otherwise(0)).alias("_below"))
    edges = targets.join(last, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s").withColumnRenamed("source", "_source")
    taken = F.col("_full") + F.when((F.col("_full") < repeat_limit) & (F.col("_hash") < F.col("_below")), 1).otherwise(0)
    return (sized.join(edges, F.col("source").eqNullSafe(F.col("_source")))
            .select(F.col("_key").alias(key), "size", "source", "source_size", "target", taken.cast("long").alias("passes")))
