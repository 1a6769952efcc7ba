"""Repeated passages by hashed windows of words, thinned out by content-selected grams.

Of every window of ``span`` successive ``k``-word grams the one with the smallest hash stands for the window, so that
two equal windows of ``least`` words have the same one, at the same place. A window whose gram occurs once
cannot be repeated; it is left out by a bitmap of fixed size. All others are counted by the hash of their
words, in an aggregate without pairs: a window is repeated if it occurs twice, whatever stands around it and
however common its gram is.

Windows that may be repeated are then looked up by their hash in the table of counts, and those of a text are joined
to stretches. Very common windows are looked up in several parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from leadtime.llm.common import bits_table, cut_lineage, words

#: Words of a passage that counts; words of a gram; grams of a window: k + span - 1 words are no more than ``least``.
LEAST, K, SPAN = 50, 20, 31
KEY_BITS = 26
#: Occurrences of a window that are looked up together.
PART = 2000
#: Rows of a batch that a task gives back.
BATCH = 100_000
M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * M2
    return x ^ (x >> np.uint64(29))


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each place on."""
    h = h.astype(np.uint64)
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out, done, part, size = np.zeros(n, np.uint64), 0, h, 1
    while done < k:  # parts of 1, 2, 4, ... words, those that add up to k
        if k & size:
            out = _mixed(out * M1 + part[done:done + n])
            done += size
        if done < k:
            part = _mixed(part[:-size] * M1 + part[size:])
            size *= 2
    return out


def window_grams(g: np.ndarray, span: int) -> np.ndarray:
    """Place of the smallest hash (the first of equal ones) of every window of ``span`` hashes."""
    if len(g) < span:
        return np.empty(0, np.int64)
    best, step = np.arange(len(g)), 1
    while step < span:  # windows of 2, 4, 8, ... hashes; the last step makes it span
        by = min(step, span - step)
        a, b = best[:-by], best[by:]
        best = np.where(g[a] <= g[b], a, b)
        step += by
    return best


def _bitmap(keys: DataFrame, key: str) -> np.ndarray:
    """A bitmap of hashed keys on the driver: 8 MB for any input."""
    filled = bits_table(keys, key, KEY_BITS).toArrow()
    bits = np.zeros(1 << (KEY_BITS - 6), np.int64)
    bits[filled["_slot"].to_numpy()] = filled["_bits"].to_numpy()
    return bits.view(np.uint8)


def _hits(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys & (len(bitmap) * 8 - 1)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def together(pieces: Iterator[list], names: list[str]) -> Iterator[pa.RecordBatch]:
    """The columns of many texts in batches of about ``BATCH`` rows."""
    held, size = [], 0
    for piece in pieces:
        held.append(piece)
        size += len(piece[0])
        if size >= BATCH:
            yield pa.RecordBatch.from_arrays([pa.concat_arrays(x) for x in zip(*held)], names)
            held, size = [], 0
    if size:
        yield pa.RecordBatch.from_arrays([pa.concat_arrays(x) for x in zip(*held)], names)


def joined(at: np.ndarray, n: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, end, largest n) of the stretches that windows of ``least`` words at rising places make up."""
    starts = np.flatnonzero(np.concatenate([[True], np.diff(at) > least]))
    return at[starts], at[np.append(starts[1:], len(at)) - 1] + least, np.maximum.reduceat(n, starts)


def repeated_passages(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, k: int = K, span: int = SPAN) -> DataFrame:
    """(key, row, first, end, copies): the stretches [first, end) of words of a text that stand elsewhere too, in the same text or another.

    Stretches of one text do not overlap. ``copies`` is the largest number of occurrences of a window of ``least`` words in
    the stretch. Words are compared as they are, by 64-bit hashes. NULL, empty and short texts have no stretches;
    repeated rows are copies of each other. ``row`` tells texts with the same key apart. A whole copy of a text is one stretch.
    """
    if k + span - 1 > least:
        raise ValueError("windows longer than the passages to find")
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()
    hashed = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("row"), F.transform(words(F.col(text)), lambda w: F.xxhash64(w)).alias("h"))

    def texts(batch: pa.RecordBatch, column: int) -> Iterator[np.ndarray]:
        offsets, flat = np.asarray(batch.column(column).offsets), np.asarray(batch.column(column).values)
        return (flat[a:b] for a, b in zip(offsets[:-1], offsets[1:]))

    def selected(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each(h):
            g = grams(h, k)
            return [pa.array(g[np.unique(window_grams(g, span))].astype(np.int64))]

        with np.errstate(over="ignore"):
            yield from together((each(h) for batch in it for h in texts(batch, 0)), ["g"])

    def windows(h: np.ndarray, bitmap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of the windows of a text whose grams may be shared."""
        g, w = grams(h, k), grams(h, least).astype(np.int64)
        at = np.flatnonzero(_hits(bitmap, g.astype(np.int64))[window_grams(g, span)[:len(w)]])
        return at, w[at]

    shared = hashed.select("h").mapInArrow(selected, "g long").groupBy("g").agg(F.count("*").alias("n")).where("n > 1")
    some_grams = spark.sparkContext.broadcast(_bitmap(shared, "g"))

    def counted(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            yield from together(([pa.array(windows(h, some_grams.value)[1])] for batch in it for h in texts(batch, 0)), ["w"])

    counts = cut_lineage(hashed.select("h").mapInArrow(counted, "w long").groupBy("w").agg(F.count("*").alias("n")).where("n > 1"), "windows")
    some_windows = spark.sparkContext.broadcast(_bitmap(counts, "w"))
    parts = F.ceil(F.col("n") / PART).cast("int")
    common = counts.where(F.col("n") > PART).select("w", parts.alias("parts")).orderBy("w").toArrow()  # one in PART windows at most
    common = spark.sparkContext.broadcast((common["w"].to_numpy(), common["parts"].to_numpy()))

    def placed(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, sizes = common.value

        def each(batch, i, h):
            at, w = windows(h, some_grams.value)
            hit = _hits(some_windows.value, w)
            at, w = at[hit], w[hit]
            part = np.zeros(len(w), np.int32)
            if len(names):
                spot = np.minimum(np.searchsorted(names, w), len(names) - 1)
                many = names[spot] == w
                part[many] = ((batch.column(1)[i].as_py() & 0x7FFFFFFF) + at[many] + i) % sizes[spot[many]]
            who = pa.array(np.full(len(w), i))
            return [pa.array(w), pa.array(part), batch.column(0).take(who), batch.column(1).take(who), pa.array(at)]

        with np.errstate(over="ignore"):
            yield from together((each(batch, i, h) for batch in it for i, h in enumerate(texts(batch, 2))), ["w", "part", "key", "row", "at"])

    found = hashed.mapInArrow(placed, f"w long, part int, key {kind}, row long, at long")
    looked_up = counts.select("w", "n", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    # a place and its count in one long; repeated rows fall together before the shuffle
    packed = F.shiftleft("at", 31).bitwiseOR(F.least("n", F.lit((1 << 31) - 1)))
    gathered = found.join(looked_up, ["w", "part"]).groupBy("key", "row").agg(F.collect_set(packed).alias("all"))

    def merge(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each(batch, i, x):
            x = np.sort(x)
            first, end, n = joined(x >> 31, x & ((1 << 31) - 1), least)
            who = pa.array(np.full(len(first), i))
            return [batch.column(0).take(who), batch.column(1).take(who), *(pa.array(c) for c in (first, end, n))]

        yield from together((each(batch, i, x) for batch in it for i, x in enumerate(texts(batch, 2))), ["key", "row", "first", "end", "copies"])

    return gathered.mapInArrow(merge, f"key {kind}, row long, first long, end long, copies long").withColumnRenamed("key", key)
