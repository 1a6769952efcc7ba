"""Toxicity: class-conditional Kneser-Ney models, compared by their log-likelihoods per word.

A model predicts the symbols of words (digits, letters without case, other UTF-8 bytes, and the end of a word)
from the two before. Toxic and ordinary documents have trigram counts of their own; what
modified Kneser-Ney discounts take from them goes to one model of both classes' counts, which itself backs off to numbers of
distinct contexts. A trigram that is rare in a class so says little there, however odd it is.

Counts cover every labelled row that may teach: Spark joins labels and texts, each task counts its own texts, an
aggregate adds up. There are at most ``SYMBOLS ** 3`` trigrams (4.5 million) for any input, which bounds what the driver
holds and what is broadcast; scoring is one pass over the texts without a shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from leadtime.llm.common import bits_table, maybe_in

#: What stands between words, ten digits, 26 letters, the bytes from 0x80.
SYMBOLS = 1 + 10 + 26 + 128
#: Symbols handled at once.
PIECE = 1 << 21
#: Scores per word are told apart to this fraction when the threshold is chosen.
STEP = 1 / 256

_SYMBOL = np.zeros(256, np.uint8)
_SYMBOL[48:58] = np.arange(1, 11)
_SYMBOL[65:91] = _SYMBOL[97:123] = np.arange(11, 37)
_SYMBOL[128:] = np.arange(37, 165)


def events(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(trigram codes, row of each) of the texts, piece by piece; code 0 is no event.

    Before a word the context is empty; after it comes its end. A long text spans several pieces.
    """
    flat = texts.cast(pa.large_binary()).fill_null(b"")
    ends = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset:flat.offset + len(flat) + 1]
    body = np.frombuffer(flat.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
    stream = np.concatenate([np.zeros(2, np.uint8), np.insert(_SYMBOL[body], ends[1:] - ends[0], 0)])
    borders = ends - ends[0] + np.arange(len(ends))
    for lo in range(0, len(stream) - 2, PIECE):
        hi = min(lo + PIECE, len(stream) - 2)
        before, middle, last = (stream[lo + i:hi + i].astype(np.int32) for i in range(3))
        before[middle == 0] = 0
        yield (before * SYMBOLS + middle) * SYMBOLS + last, np.repeat(np.arange(len(flat)), np.diff(np.clip(borders, lo, hi)))


def starts(codes: np.ndarray) -> np.ndarray:
    """Which events begin a word."""
    return (codes > 0) & (codes < SYMBOLS)


def trigram_counts(taught: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Trigram counts of ordinary and of toxic texts; ``taught`` has the columns text and toxic (0 or 1)."""
    size = SYMBOLS ** 3

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * size, np.int64)
        for batch in batches:
            label = np.asarray(batch.column(1)).astype(np.int64)
            for codes, row in events(batch.column(0)):
                total += np.bincount(codes + label[row] * size, minlength=2 * size)
        total = total.reshape(2, size)
        at = np.flatnonzero(total.any(axis=0))
        at = at[at > 0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[0, at]), pa.array(total[1, at])], ["code", "ordinary", "toxic"])

    rows = (taught.select("text", "toxic").mapInArrow(tally, "code long, ordinary long, toxic long")
            .groupBy("code").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic")).toPandas())
    out = np.zeros((2, size))
    out[:, rows["code"].to_numpy(np.int64)] = rows[["ordinary", "toxic"]].to_numpy(float).T
    return out[0], out[1]


def discounts(counts: np.ndarray) -> np.ndarray:
    """What to take off a count of 0, 1, 2, and 3 or more: modified Kneser-Ney, from how many counts are 1 to 4."""
    n = [max(1, int((counts == i).sum())) for i in range(1, 5)]
    y = n[0] / (n[0] + 2 * n[1])
    return np.array([0.0, *(min(i, max(0.5, i - (i + 1) * y * n[i] / n[i - 1])) for i in (1, 2, 3))])


def backed_off(counts: np.ndarray, context: np.ndarray, below: np.ndarray, n_contexts: int) -> np.ndarray:
    """Probabilities: discounted counts over their context's sum, the rest spread as ``below``; ``below`` itself where a context is new."""
    off = discounts(counts)[np.minimum(counts, 3).astype(int)]
    total, left = np.bincount(context, counts, n_contexts)[context], np.bincount(context, off, n_contexts)[context]
    return np.where(total > 0, (counts - off + left * below) / np.maximum(total, 1), below)


def shared_model(counts: np.ndarray) -> np.ndarray:
    """Kneser-Ney probabilities of every trigram's last symbol from the counts of both classes together."""
    code = np.arange(SYMBOLS ** 3)
    seen = (counts > 0).reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    pairs = seen.sum(axis=0).astype(float)  # distinct symbols before a pair
    single = backed_off((pairs > 0).sum(axis=0).astype(float), np.zeros(SYMBOLS, int), np.full(SYMBOLS, 1 / SYMBOLS), 1)
    at = np.arange(SYMBOLS ** 2)
    double = backed_off(pairs.ravel(), at // SYMBOLS, single[at % SYMBOLS], SYMBOLS)
    return backed_off(counts, code // SYMBOLS, double[code % SYMBOLS ** 2], SYMBOLS ** 2)


def odds_table(ordinary: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Toxic less ordinary log-likelihood of every trigram; 0 where neither class knows the context."""
    shared, context = shared_model(ordinary + toxic), np.arange(SYMBOLS ** 3) // SYMBOLS
    a, b = (backed_off(c, context, shared, SYMBOLS ** 2) for c in (toxic, ordinary))
    table = np.log(a) - np.log(b)
    table[0] = 0.0
    return table


def log_odds(docs: DataFrame, table: np.ndarray, text: str = "text") -> DataFrame:
    """All columns of docs but the text, with ``per_word``: the log-likelihoods' difference over the number of words (0 without words)."""
    context = np.arange(SYMBOLS ** 3) // SYMBOLS
    # most trigrams differ from their context's usual value nowhere: send that value and the exceptions
    usual = np.median(table.reshape(-1, SYMBOLS), axis=1)
    odd = np.flatnonzero(table != usual[context])
    sent = docs.sparkSession.sparkContext.broadcast((usual, odd, table[odd]))
    kept = [c for c in docs.columns if c != text]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != text)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        usual, at, value = sent.value
        table = np.repeat(usual, SYMBOLS)
        table[at] = value
        for batch in it:
            total, n_words = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            for codes, row in events(batch.column(0)):
                total += np.bincount(row, table[codes], batch.num_rows)
                n_words += np.bincount(row[starts(codes)], minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(total / np.maximum(n_words, 1))], [*kept, "per_word"])

    return docs.select(text, *kept).mapInArrow(batches, f"{kinds}, per_word double")


def threshold(steps: np.ndarray, toxic: np.ndarray, ordinary: np.ndarray) -> tuple[float, float]:
    """(per-word odds from which a document is toxic, slope) with the fewest errors on counted steps, in the middle of equal ones."""
    order = np.argsort(steps)
    steps, toxic, ordinary = steps[order], toxic[order], ordinary[order]
    errors = np.concatenate([[0], np.cumsum(toxic)]) + np.concatenate([np.cumsum(ordinary[::-1])[::-1], [0]])
    borders = np.concatenate([[steps[0] - 1], (steps[1:] + steps[:-1]) / 2, [steps[-1] + 1]])
    best = np.flatnonzero(errors == errors.min())
    at = float(borders[best[len(best) // 2]]) * STEP
    far = (steps * STEP - at)[:, None] * 2.0 ** np.arange(0, 7)
    loss = (toxic[:, None] * np.logaddexp(0, -far) + ordinary[:, None] * np.logaddexp(0, far)).sum(axis=0)
    return at, float(2.0 ** int(loss.argmin()))


def _remainder(key: str | Column) -> Column:
    return F.crc32((F.col(key) if isinstance(key, str) else key).cast("string").cast("binary")) % 5


def teaching_rows(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str) -> DataFrame:
    """(text, toxic, tried) of labelled rows that may teach; equal texts with equal labels teach once, by their smallest key.

    ``tried`` marks a quarter of them, which chooses the threshold instead of being counted.
    """
    usable = labels.where((_remainder(key) != 0) & F.col(label).isin(0, 1)).select(F.col(key).alias("_id"), F.col(label).cast("int").alias("toxic"))
    hashes = [F.xxhash64(text).alias("_h"), F.xxhash64(F.lit(1), text).alias("_g")]
    # the filter only thins out the join: a bit or more for each label, at most 64 MB; every row it lets through is compared
    keyed = usable.withColumn("_k", F.xxhash64("_id"))
    bits = min(28, max(16, 4 + math.ceil(math.log2(1 + usable.count()))))
    marks = bits_table(keyed.select("_k"), "_k", bits)
    maybe = lambda cols: maybe_in(docs.select(F.col(key).alias("_key"), *cols).withColumn("_k", F.xxhash64("_key")), "_k", marks, bits)
    found = maybe(hashes).join(usable, F.col("_key") == F.col("_id"))
    chosen = found.groupBy("_h", "_g", "toxic").agg(F.min("_key").alias("_id"))
    rows = maybe([F.col(text).alias("text"), *hashes]).withColumnsRenamed({"_h": "_h2", "_g": "_g2"})
    joined = rows.join(chosen, (F.col("_key") == F.col("_id")) & (F.col("_h") == F.col("_h2")) & (F.col("_g") == F.col("_g2")))
    return joined.select("text", "toxic", (_remainder("_id") == 4).alias("tried"))


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """(key, held_out, score, predicted, per_word) of every document; other columns of either table take no part.

    A document is held out if crc32 of its key modulo 5 is 0 (never so for a NULL key, whose rows cannot teach either). Labels other
    than 0 and 1 are left out; a document with both labels teaches both classes. Texts without words have odds of 0 per word.
    Where the quarter that chooses the threshold lacks a class, all teaching rows choose it; where all rows lack one, no
    document is told apart and every score is the share of toxic labels (0 without labels).
    """
    taught = teaching_rows(docs, labels, key, text, label).cache()
    try:
        table = odds_table(*trigram_counts(taught.where("not tried")))
        tried = (log_odds(taught, table).withColumn("step", F.round(F.col("per_word") / STEP).cast("long"))
                 .groupBy("tried", "step").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("ordinary")).toPandas())
    finally:
        taught.unpersist()
    chosen = tried[tried["tried"]]
    if not (chosen["toxic"].sum() and chosen["ordinary"].sum()):
        chosen = tried
    scored = log_odds(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), table)
    if chosen["toxic"].sum() and chosen["ordinary"].sum():
        at, slope = threshold(*(chosen[c].to_numpy(float) for c in ("step", "toxic", "ordinary")))
        score = 1 / (1 + F.exp(-slope * (F.col("per_word") - at)))
    else:
        score = F.lit(float(chosen["toxic"].sum() / max(1, chosen["toxic"].sum() + chosen["ordinary"].sum())))
    out = F.coalesce(_remainder("key") == 0, F.lit(False))
    return (scored.select(F.col("key").alias(key), out.alias("held_out"), score.alias("score"), "per_word")
            .select(key, "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "per_word"))
