"""Vector compression: product codes whose codebooks are fitted by Ball k-means in whole numbers.

Each entry of a codebook and the vector parts it held last time form a ball. Around a moved
entry, parts nearer to it than half its distance to every other entry are its stable core and need no comparison; the ball's
radius says which entries are neighbours at all, and the ring a part lies in says which of them can be as near as its
own. Only those are compared, so results equal a search over all entries, ties included.

Rows stay in Spark tables: a round writes each row's codes and then adds up sums per entry within the tasks. The
driver holds codebooks only: at most ``entries`` times the dimension.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from leadtime.llm.common import discard, stored

#: Rings are taken together by how many neighbours they reach: up to 4, 16, 64, all.
RINGS = (4, 16, 64)

Codebooks = list[np.ndarray]


def bounds(width: int, parts: int) -> list[int]:
    """Where the parts of a vector begin and end; equal parts if ``parts`` divides the width."""
    return [i * width // parts for i in range(parts + 1)]


def whole_numbers(vectors: DataFrame, key: str, vector: str, label: str | None, scale: int, parts: int) -> tuple[DataFrame, int]:
    """(_key, _label, _v) with each component as floor(scale * x), and the vectors' width.

    Vectors that are NULL or empty or hold NULL or non-finite components are left out. So are those of another width than the
    vector of the smallest key, and those with a component so large that squared distances would not fit 64 bits.
    """
    x = F.col(vector)
    rows = vectors.select(F.col(key).alias("_key"), (F.col(label) if label else F.lit(None).cast("int")).alias("_label"), x.cast("array<double>").alias("_x"))
    fine = rows.where(F.col("_x").isNotNull() & (F.size("_x") > 0)).where(~F.exists("_x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))))
    first = fine.orderBy(F.col("_key").asc_nulls_last(), "_x").select(F.size("_x")).first()
    width = first[0] if first else 0
    most = 2.0 ** ((58 - max(1, -(-width // parts)).bit_length()) // 2)
    fine = fine.where((F.size("_x") == width) & ~F.exists("_x", lambda c: F.abs(c * float(scale)) >= most))
    return fine.select("_key", "_label", F.transform("_x", lambda c: F.floor(c * float(scale)).cast("int")).alias("_v")), width


def first_codebooks(rows: DataFrame, width: int, parts: int, entries: int) -> Codebooks:
    """The parts of the rows with the smallest keys, ascending (equal keys by their vectors, NULL last)."""
    seeds = rows.orderBy(F.col("_key").asc_nulls_last(), "_v").select("_v").limit(entries).collect()
    v = np.array([r[0] for r in seeds], np.int64).reshape(len(seeds), width)
    cuts = bounds(width, parts)
    return [v[:, a:b] for a, b in zip(cuts, cuts[1:])]


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances, every row of x to every entry."""
    high = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)))
    kind = np.float64 if 4 * high * high * max(1, x.shape[1]) < 1 << 52 else np.int64  # doubles are exact below, and faster
    x, entries = x.astype(kind), entries.astype(kind)
    return ((x * x).sum(1)[:, None] + (entries * entries).sum(1) - 2 * (x @ entries.T)).astype(np.int64)


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of the nearest of all entries, ties to the lower index."""
    found = squared(x, entries)
    at = found.argmin(axis=1)
    return at, found[np.arange(len(x)), at]


def ball_nearest(x: np.ndarray, old: np.ndarray, entries: np.ndarray, apart: np.ndarray, work: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """What ``nearest`` returns, from each row's entry of the round before.

    ``apart`` holds the entries' squared distances to one another. An entry more than twice as far from a row's own entry as
    the row is cannot be nearer to the row. ``work`` counts [rows, rows in stable cores, compared pairs].
    """
    own = x - entries[old]
    own = (own * own).sum(axis=1)
    at, best = old.copy(), own.copy()
    order = np.argsort(old, kind="stable")
    for ball in np.split(order, np.flatnonzero(np.diff(old[order])) + 1) if len(order) else []:
        centre, reach = old[ball[0]], 4 * own[ball]
        gaps = np.delete(apart[centre], centre)
        near = np.flatnonzero(gaps <= reach.max())  # the radius: no other entry can take a row of this ball
        near = near[np.argsort(gaps[near], kind="stable")]
        ring = np.searchsorted(gaps[near], reach, side="right")  # how many of them can take this row
        near += near >= centre
        if work is not None:
            work += [len(ball), int((ring == 0).sum()), 0]
        for low, high in zip((0, *RINGS), (*RINGS, len(entries))):
            inside = np.flatnonzero((ring > low) & (ring <= high))
            if len(inside) == 0:
                continue
            rows, most = ball[inside], int(ring[inside].max())
            some = np.sort(near[:most])
            found = squared(x[rows], entries[some])
            found[apart[centre][some][None, :] > reach[inside][:, None]] = np.iinfo(np.int64).max
            pick = found.argmin(axis=1)
            least, which = found[np.arange(len(rows)), pick], some[pick]
            better = (least < best[rows]) | ((least == best[rows]) & (which < at[rows]))
            at[rows[better]], best[rows[better]] = which[better], least[better]
            if work is not None:
                work[2] += len(rows) * most
    return at, best


def _matrix(column: pa.Array, width: int, kind: type = np.int64) -> np.ndarray:
    return np.asarray(column.flatten()).astype(kind).reshape(len(column), width)


def assign(rows: DataFrame, books: Codebooks, width: int, known: bool) -> DataFrame:
    """(_key, _label, _v, _code, _error): each part's nearest entry; by balls if the rows' codes are known."""
    sent = rows.sparkSession.sparkContext.broadcast(books)  # at most entries x width numbers
    key, label = (rows.schema[c].dataType.simpleString() for c in ("_key", "_label"))
    cuts = bounds(width, len(books))

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = sent.value
        apart = [squared(b, b) for b in books]
        for batch in it:
            v = _matrix(batch.column(2), width)
            old = _matrix(batch.column(3), len(books)) if known else None
            codes, error = np.zeros((batch.num_rows, len(books)), np.int32), np.zeros(batch.num_rows, np.int64)
            for p, book in enumerate(books):
                x = v[:, cuts[p]:cuts[p + 1]]
                at, far = ball_nearest(x, old[:, p], book, apart[p]) if known else nearest(x, book)
                codes[:, p] = at
                error += far
            listed = pa.ListArray.from_arrays(np.arange(batch.num_rows + 1, dtype=np.int32) * len(books), pa.array(codes.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], listed, pa.array(error)], ["_key", "_label", "_v", "_code", "_error"])

    columns = ["_key", "_label", "_v", *(["_code"] if known else [])]
    return rows.select(*columns).mapInArrow(batches, f"_key {key}, _label {label}, _v array<int>, _code array<int>, _error long")


def moved(coded: DataFrame, books: Codebooks, width: int) -> Codebooks:
    """Each entry as the componentwise floor(sum / count) of its parts; unused entries stay."""
    cuts, widest = bounds(width, len(books)), max(b.shape[1] for b in books)

    def tally(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((len(b), widest + 1), np.int64) for b in books]
        for batch in it:
            v, codes = _matrix(batch.column(0), width), _matrix(batch.column(1), len(books))
            for p in range(len(books)):
                order = np.argsort(codes[:, p], kind="stable")
                which, first = np.unique(codes[order, p], return_index=True)
                if len(which):
                    sums[p][which, 0] += np.diff(np.append(first, len(order)))
                    sums[p][which, 1:1 + cuts[p + 1] - cuts[p]] += np.add.reduceat(v[order, cuts[p]:cuts[p + 1]], first, axis=0)
        for p, s in enumerate(sums):
            used = np.flatnonzero(s[:, 0])
            listed = pa.ListArray.from_arrays(np.arange(len(used) + 1, dtype=np.int32) * (widest + 1), pa.array(s[used].ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(used), p)), pa.array(used), listed], ["part", "entry", "sums"])

    totals = (coded.select("_v", "_code").mapInArrow(tally, "part long, entry long, sums array<long>").groupBy("part", "entry")
              .agg(*(F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(widest + 1))).collect())
    out = [b.copy() for b in books]
    for part, entry, n, *sums in totals:
        out[part][entry] = [s // n for s in sums[:out[part].shape[1]]]
    return out


def fit_and_encode(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str | None = "label", parts: int = 4,
                   entries: int = 256, rounds: int = 4, scale: int = 1024) -> tuple[DataFrame, Codebooks]:
    """((_key, _label, _v, _code, _error) of every kept vector, the codebooks).

    Codebooks start as the parts of the ``entries`` smallest keys (fewer vectors: fewer entries), then follow ``rounds`` rounds
    of assigning and moving, and a last assignment. See ``whole_numbers`` for what is left out; repeated keys
    and rows count as often as they stand there; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows, width = whole_numbers(vectors, key, vector, label, scale, parts)
    now, path = stored(rows, "vector-parts")
    books = first_codebooks(now, width, parts, entries)
    if len(books[0]) == 0:
        empty = now.select("*", F.array().cast("array<int>").alias("_code"), F.lit(0).cast("long").alias("_error"))
        return empty, books
    for done in range(rounds + 1):
        before = path
        now, path = stored(assign(now, books, width, done > 0), "vector-codes")
        discard(spark, before)
        if done < rounds:
            books = moved(now, books, width)
    return now, books


def decode(coded: DataFrame, books: Codebooks, scale: int = 1024) -> DataFrame:
    """(_key, _near): the vector that the codes stand for, as the middle of each whole-number step."""
    sent = coded.sparkSession.sparkContext.broadcast(books)
    key = coded.schema["_key"].dataType.simpleString()

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            codes = _matrix(batch.column(1), len(sent.value))
            near = np.concatenate([b[codes[:, p]] for p, b in enumerate(sent.value)], axis=1)
            listed = pa.ListArray.from_arrays(np.arange(len(near) + 1, dtype=np.int32) * near.shape[1], pa.array((near.ravel() + 0.5) / scale))
            yield pa.RecordBatch.from_arrays([batch.column(0), listed], ["_key", "_near"])

    return coded.select("_key", "_code").mapInArrow(batches, f"_key {key}, _near array<double>")


def codebooks_sha256(books: Codebooks) -> str:
    return hashlib.sha256(",".join(str(int(c)) for book in books for c in book.ravel()).encode()).hexdigest()


def compress(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", **options) -> DataFrame:
    """(key, code, error, label_error, codebooks_sha256) of every kept vector (see ``fit_and_encode``).

    ``code`` has two hex digits a part; errors are squared distances in whole numbers. A label's error sums
    over its rows, NULL labels together; the sums come back by a join on the label, which Spark splits where one label has very
    many rows.
    """
    coded, books = fit_and_encode(vectors, key, vector, label, **options)
    sums = coded.groupBy("_label").agg(F.sum("_error").alias("label_error")).withColumnRenamed("_label", "_of")
    code = F.lower(F.array_join(F.transform("_code", lambda c: F.lpad(F.hex(c), 2, "0")), ""))
    return coded.join(sums, F.col("_label").eqNullSafe(F.col("_of"))).select(
        F.col("_key").alias(key), code.alias("code"), F.col("_error").alias("error"), "label_error", F.lit(codebooks_sha256(books)).alias("codebooks_sha256"))
