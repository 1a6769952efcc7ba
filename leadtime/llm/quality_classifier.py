"""Quality classifier: logistic regression on hashed word n-grams, fitted by follow-the-regularised-leader.

Documents become sparse vectors of hashed words and word pairs, scaled to
length 1. Spark hashes the words; each task turns them into vectors with numpy
and scores them as sparse dot products. Fitting uses a bounded sample
of labelled documents dealt over a fixed number of learners whose weights are averaged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from leadtime.llm.common import words

BITS = 18
#: Bounds of the fit: labelled documents, documents of a learner, passes over them.
SAMPLE, PER_LEARNER, PASSES = 24_000, 4_000, 3
#: Words turned into vectors at once (one longer text is taken whole).
SLICE = 300_000
ALPHA, BETA, L1, L2 = 0.6, 1.0, 1e-4, 1e-4


def hashed(text: Column) -> list[Column]:
    """64-bit hashes of the words of a text, and of what is left of them without letters a-z and digits."""
    bare = F.translate(F.lower(F.coalesce(text, F.lit(""))), "abcdefghijklmnopqrstuvwxyz0123456789", "")
    return [F.transform(words(text), lambda w: F.xxhash64(w)).alias("_words"), F.transform(words(bare), lambda w: F.xxhash64(w, F.lit(1))).alias("_marks")]


def sparse_rows(flat: np.ndarray, offsets: np.ndarray, marks: np.ndarray, mark_offsets: np.ndarray,
                bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, value, row) triples of all documents of a batch.

    ``flat`` and ``marks`` hold the hashes of one document after another. A document's words and pairs of words
    have length 1, its marks as well, and one cell tells which tenth of its pairs it holds before.
    """
    n = len(offsets) - 1
    shift = np.uint64(64 - bits)

    def cells(h: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        with np.errstate(over="ignore"):
            bucket = ((h * np.uint64(0xBF58476D1CE4E5B9)) >> shift).astype(np.int64)
        cell, counts = np.unique((owner << bits) | bucket, return_counts=True)
        owner, bucket, value = cell >> bits, cell & ((1 << bits) - 1), np.sqrt(counts)  # a word repeated often says little more
        norm = np.sqrt(np.bincount(owner, value ** 2, n))
        return bucket, value / norm[owner], owner, counts

    h, row = flat.astype(np.uint64), np.repeat(np.arange(n), np.diff(offsets))
    with np.errstate(over="ignore"):
        pair = (h[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ h[1:]
    inside = row[:-1] == row[1:]
    owner = row[1:][inside]
    grams = cells(np.concatenate([h, pair[inside]]), np.concatenate([row, owner]))
    distinct = np.bincount(np.unique(np.stack([owner.astype(np.uint64), pair[inside]]), axis=1)[0].astype(np.int64) if len(owner) else owner, minlength=n)
    pairs = np.bincount(owner, minlength=n)
    tenth = np.where(pairs > 0, 10 * (pairs - distinct) // np.maximum(pairs, 1), 10)
    signs = cells(marks.astype(np.uint64), np.repeat(np.arange(n), np.diff(mark_offsets)))
    return (np.concatenate([grams[0], signs[0], tenth]), np.concatenate([grams[1], signs[1], np.ones(n)]), np.concatenate([grams[2], signs[2], np.arange(n)]))


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, passes: int = PASSES, bits: int = BITS) -> np.ndarray:
    """FTRL-proximal updates, one document after another; the last weight is the bias."""
    size = (1 << bits) + 1
    z, n = np.zeros(size), np.zeros(size)
    for _ in range(passes):
        for (at, x), y in zip(rows, labels):
            w = _weights(z[at], n[at])
            p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - y) * x
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - step * w
            n[at] += g * g
    return _weights(z, n)


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def fit(labelled: DataFrame, text: str = "text", label: str = "label", learners: int = 1) -> np.ndarray:
    """Weights from labelled documents (a bounded number, see ``classify``), dealt out by a hash of their text.

    Documents with a NULL label are left out. Each learner sees its own documents
    and returns its non-zero weights; their mean has at most 2 ** BITS + 1 numbers. Without
    labels all weights are 0 and every score is 0.5.
    """
    chosen = labelled.where(F.col(label).isNotNull()).select(
        F.pmod(F.xxhash64(text), F.lit(learners)).cast("int").alias("_part"), F.xxhash64(text).alias("_h"),
        F.col(label).cast("double").alias("_y"), *hashed(F.col(text)))

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_h", "_y"])
        rows = []
        for h, m in zip(pdf["_words"], pdf["_marks"]):
            at, x, _ = sparse_rows(np.asarray(h, np.int64), np.array([0, len(h)]), np.asarray(m, np.int64), np.array([0, len(m)]))
            rows.append((np.append(at, 1 << BITS), np.append(x, 1.0)))
        w = ftrl(rows, pdf["_y"].to_numpy())
        at = np.flatnonzero(w)
        return pd.DataFrame({"at": at, "w": w[at]})

    total = np.zeros((1 << BITS) + 1)
    parts = chosen.groupBy("_part").applyInPandas(learn, "at long, w double").groupBy("at").agg(F.sum("w").alias("w")).toPandas()
    total[parts["at"].to_numpy(np.int64)] = parts["w"].to_numpy(float) / learners
    return total


def score(docs: DataFrame, weights: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) of every row, whole texts; a text without words gets the bias alone."""
    kind = docs.schema[key].dataType.simpleString()
    held = docs.sparkSession.sparkContext.broadcast(weights)  # 2 ** BITS + 1 numbers for any input

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = held.value
        for whole in it:
            ends = np.asarray(whole.column(1).offsets)
            cuts = np.unique(np.searchsorted(ends, np.arange(ends[0], ends[-1], SLICE)))  # rows at which another SLICE words begin
            for first, end in zip([0, *cuts], [*cuts, whole.num_rows]):
                if end > first:
                    batch = whole.slice(first, end - first)
                    at, x, owner = sparse_rows(*_flat(batch.column(1)), *_flat(batch.column(2)))
                    odds = np.bincount(owner, w[at] * x, batch.num_rows) + w[-1]
                    yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(odds, -35, 35))))], ["key", "score"])

    return docs.select(F.col(key).alias("key"), *hashed(F.col(text))).mapInArrow(batches, f"key {kind}, score double").withColumnRenamed("key", key)


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.asarray(lists.offsets)
    return np.asarray(lists.values)[offsets[0]:offsets[-1]], offsets - offsets[0]


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
             sample: int = SAMPLE) -> DataFrame:
    """(key, held_out, score, predicted) of every document.

    A document is held out if crc32 of its key modulo 3 is 1 (never so for a NULL key); only the others teach.
    Of the labels, those whose hashed key falls below a threshold teach: about ``sample`` of
    them, however many there are. Several labels of one document teach several times.
    """
    out = F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))
    usable = labels.where(~out & F.col(label).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("_id"), F.col(label).alias("label"))
    n = usable.count()
    share, learners = min(1.0, sample / max(1, n)), max(1, min(n, sample) // PER_LEARNER)
    marked = usable.where(F.pmod(F.xxhash64("_id", F.lit("teach")), F.lit(1 << 30)) < int(share * (1 << 30)))
    # the sample bounds what is broadcast
    taught = docs.select(F.col(key).alias("_key"), F.col(text).alias("text")).join(F.broadcast(marked), F.col("_key") == F.col("_id")).select("text", "label")
    scored = score(docs, fit(taught, learners=learners), key, text)
    return scored.select(key, out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
