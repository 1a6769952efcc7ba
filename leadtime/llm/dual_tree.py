"""Ranked lexical search of a set of items against all documents, by dual trees.

Spark turns every document into a sparse vector: for each of the items' terms that it holds, what one
weighted occurrence in an item adds to its score. Each task arranges its documents in a hierarchy whose nodes hold the largest
value of every coordinate; the items form another one. The product of two nodes' maxima bounds every score between their
members: if it is below the weakest k-th score among the node's items, the whole batch of pairs is left out, which cannot
change a result. Scores are whole numbers and exact.

Items come in blocks of bounded size, each of which passes over the documents once. Within a block, a hashed share of the
documents goes first; its k-th scores are a floor for all other tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from leadtime.llm.common import discard, stored

#: Bytes of item texts in a block, numbers in a task's document hierarchy, documents of a leaf, one document in so many goes first.
BLOCK, CELLS, LEAF, FIRST = 1 << 17, 1 << 23, 16, 32
#: Bytes of a text taken apart at once.
PIECE = 1 << 22

#: Terms are runs of digits, letters and bytes from 0x80; only A-Z become small.
_TERM = bytes(i + 32 if 65 <= i <= 90 else i if 48 <= i <= 57 or 97 <= i <= 122 or i >= 128 else 32 for i in range(256))


def terms(text: bytes | None) -> Iterator[list[bytes]]:
    """The terms of a text in order, piece by piece."""
    text = (text or b"").translate(_TERM)
    at = 0
    while at < len(text):
        end = text.find(b" ", at + PIECE) if len(text) - at > PIECE else -1
        yield text[at:end if end >= 0 else len(text)].split()
        at = end if end >= 0 else len(text)


class Pyramid:
    """Levels of maxima over rows taken in pairs: level 0 are the rows, the last level is the root."""

    def __init__(self, rows: np.ndarray):
        self.levels = [rows]
        while len(self.levels[-1]) > 1:
            self.levels.append(np.maximum.reduceat(self.levels[-1], np.arange(0, len(self.levels[-1]), 2), axis=0))

    def children(self, level: int, nodes: np.ndarray) -> np.ndarray:
        below = np.stack([2 * nodes, 2 * nodes + 1], axis=1).ravel()
        return below[below < len(self.levels[level - 1])]


def by_heaviest(owner: np.ndarray, term: np.ndarray, gain: np.ndarray, n: int) -> np.ndarray:
    """The rows 0..n-1 ordered by their heaviest term and the next, so that neighbours share large coordinates."""
    order = np.lexsort((term, -gain, owner))
    first = np.searchsorted(owner[order], np.arange(n))
    second = np.minimum(first + 1, np.searchsorted(owner[order], np.arange(n), side="right") - 1)
    return np.lexsort((term[order][second], term[order][first]))


class Items:
    """A block of items as rows over the block's terms, with the bounds of their hierarchy."""

    def __init__(self, keys: list, counts: list[dict[bytes, int]], vocabulary: dict[bytes, int], weights: np.ndarray):
        owner = np.repeat(np.arange(len(counts)), [len(c) for c in counts])
        term = np.array([vocabulary[t] for c in counts for t in c], np.int64)
        value = np.array([n for c in counts for n in c.values()], np.int64) * weights[term]
        order = by_heaviest(owner, term, value, len(counts))
        self.order, self.keys = order, [keys[i] for i in order]
        whole = np.zeros((len(counts), len(vocabulary)), np.int64)
        whole[owner, term] = value
        # doubles hold every sum exactly below 2 ** 53; an occurrence adds less than 10 ** 6 times its weight
        kind = np.float64 if whole.sum(axis=1).max() * 10 ** 6 < 1 << 53 else np.int64
        self.tree, self.weights = Pyramid(whole[order].astype(kind)), weights


class Best:
    """The k best documents found for each item; equal scores by the smaller key, NULL keys last."""

    def __init__(self, n: int, k: int, floors: np.ndarray):
        self.k, self.found = k, [[] for _ in range(n)]
        self.floors = floors.copy()  # a score below cannot be among the best
        self.raise_floors()

    def raise_floors(self) -> None:
        self.weakest = [self.floors]
        while len(self.weakest[-1]) > 1:
            self.weakest.append(np.minimum.reduceat(self.weakest[-1], np.arange(0, len(self.weakest[-1]), 2)))

    def offer(self, items: np.ndarray, scores: np.ndarray, keys: list) -> None:
        hit = scores >= self.floors[items][:, None]
        for row in np.flatnonzero(hit.any(axis=1)):
            i = items[row]
            new = [(-int(scores[row, j]), keys[j] is None, keys[j]) for j in np.flatnonzero(hit[row])]
            self.found[i] = sorted(self.found[i] + new, key=lambda x: x[:2] if x[1] else x)[:self.k]
            if len(self.found[i]) == self.k:
                self.floors[i] = max(self.floors[i], -self.found[i][-1][0])
        if hit.any():
            self.raise_floors()


def search(items: Items, best: Best, keys: list, owner: np.ndarray, term: np.ndarray, value: np.ndarray) -> int:
    """Offer every document that may be among an item's best; returns how many pairs were scored.

    ``owner``, ``term`` and ``value`` are the documents' coordinates, by document; each document has one at least.
    """
    n, kind = len(keys), items.tree.levels[0].dtype
    place = np.empty(n, np.int64)
    order = by_heaviest(owner, term, value * items.weights[term], n)
    place[order] = np.arange(n)
    sort = np.argsort(place[owner], kind="stable")
    row, term, value = place[owner][sort], term[sort], value[sort].astype(kind)
    leaves = np.zeros((-(-n // LEAF), items.tree.levels[0].shape[1]), kind)
    np.maximum.at(leaves, (row // LEAF, term), value)
    tree, starts = Pyramid(leaves), np.searchsorted(row, np.arange(n + 1))
    scored = 0

    def visit(level: int, node: int, at: int, nodes: np.ndarray) -> None:
        nonlocal scored
        most = tree.levels[level][node]
        nodes = nodes[items.tree.levels[at][nodes] @ most >= best.weakest[at][nodes]]
        if len(nodes) == 0:
            return
        if at > 0:
            at, nodes = at - 1, items.tree.children(at, nodes)
        if level > 0:
            for child in tree.children(level, np.array([node])):
                visit(level - 1, int(child), at, nodes)
            return
        while at > 0:
            nodes = nodes[items.tree.levels[at][nodes] @ most >= best.weakest[at][nodes]]
            at, nodes = at - 1, items.tree.children(at, nodes)
        nodes = nodes[items.tree.levels[0][nodes] @ most >= best.weakest[0][nodes]]
        if len(nodes) == 0:
            return
        low, high = node * LEAF, min(n, (node + 1) * LEAF)
        a, b = starts[low], starts[high]
        scores = np.add.reduceat(items.tree.levels[0][np.ix_(nodes, term[a:b])] * value[a:b], starts[low:high] - a, axis=1)
        scored += scores.size
        best.offer(nodes, scores, [keys[i] for i in order[low:high]])

    visit(len(tree.levels) - 1, 0, len(items.tree.levels) - 1, np.zeros(1, np.int64))
    return scored


def sparse_documents(docs: DataFrame, key: str, text: str, vocabulary: dict[bytes, int]) -> DataFrame:
    """(_key, _n, _terms, _counts): a document's number of terms, and those of the vocabulary with their occurrences."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)  # the terms of one block of items
    kind = docs.schema[key].dataType

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = sent.value.get
        for batch in it:
            sizes, at, counts, offsets = [], [], [], [0]
            for text in batch.column(1).cast(pa.large_binary()):
                n, held = 0, np.zeros(0, np.int64)
                for found in terms(text.as_py()):
                    n += len(found)
                    ids = np.fromiter(map(find, found, repeat(-1)), np.int64, len(found))
                    held = np.concatenate([held, ids[ids >= 0]])
                which, times = np.unique(held, return_counts=True)
                sizes.append(n)
                at.append(which)
                counts.append(times)
                offsets.append(offsets[-1] + len(which))
            cuts = pa.array(offsets, pa.int32())
            lists = [pa.ListArray.from_arrays(cuts, pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int32())) for x in (at, counts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), *lists], ["_key", "_n", "_terms", "_counts"])

    return (docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
            .mapInArrow(batches, f"_key {kind.simpleString()}, _n long, _terms array<int>, _counts array<int>"))


def best_in_tasks(vectors: DataFrame, items: Items, floors: np.ndarray, k: int, n_docs: int, n_terms: int, item_type) -> DataFrame:
    """(_place, _item, _score, _key): the k best documents of each task's rows for each item, none below its floor."""
    sent = vectors.sparkSession.sparkContext.broadcast((items, floors))
    kinds = [to_arrow_type(t) for t in (item_type, vectors.schema["_key"].dataType)]
    names = [t.simpleString() for t in (item_type, vectors.schema["_key"].dataType)]

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, floors = sent.value
        best = Best(len(items.keys), k, floors)
        step = max(LEAF, CELLS * LEAF // (2 * items.tree.levels[0].shape[1]))
        for whole in it:
            for first in range(0, whole.num_rows, step):
                batch = whole.slice(first, step)
                lists = batch.column(2)
                owner = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(lists.offsets)))
                tf = np.asarray(batch.column(3).flatten()).astype(np.int64)
                m = 75 + 25 * np.asarray(batch.column(1))[owner] * n_docs // n_terms
                search(items, best, batch.column(0).to_pylist(), owner, np.asarray(lists.flatten()).astype(np.int64),
                       1_000_000_000 * tf // (1000 * tf + 12 * m))
        rows = [(i, items.keys[i], -s, x) for i, found in enumerate(best.found) for s, _, x in found]
        columns = [pa.array([r[j] for r in rows], t) for j, t in enumerate((pa.int32(), kinds[0], pa.int64(), kinds[1]))]
        yield pa.RecordBatch.from_arrays(columns, ["_place", "_item", "_score", "_key"])

    return vectors.where(F.size("_terms") > 0).mapInArrow(batches, f"_place int, _item {names[0]}, _score long, _key {names[1]}")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("_place").orderBy(F.desc("_score"), F.col("_key").asc_nulls_last())
    return found.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k)


def _block(items: list, docs: DataFrame, item_key: str, item_type, key: str, text: str, k: int) -> DataFrame | None:
    counts: list[dict[bytes, int]] = []
    for row in items:
        held: dict[bytes, int] = {}
        for found in terms(row[1].encode() if row[1] is not None else None):
            for t in found:
                held[t] = held.get(t, 0) + 1
        counts.append(held)
    keys, counts = [r[0] for r, c in zip(items, counts) if c], [c for c in counts if c]
    vocabulary = {t: i for i, t in enumerate(sorted({t for c in counts for t in c}))}
    if not counts:
        return None
    vectors, _ = stored(sparse_documents(docs, key, text, vocabulary), "term-vectors")
    n_docs, n_terms = vectors.agg(F.count(F.when(F.col("_n") > 0, 1)), F.coalesce(F.sum("_n"), F.lit(0))).first()
    holders = dict(vectors.select(F.explode("_terms").alias("t")).groupBy("t").count().collect())  # one row a term of the block
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holders.get(i, 0) + 1))) for i in range(len(vocabulary))], np.int64)
    block = Items(keys, counts, vocabulary, weights)
    floors = np.ones(len(keys), block.tree.levels[0].dtype)
    first = F.pmod(F.xxhash64("_key", "_n", "_terms", "_counts"), F.lit(FIRST)) == 0
    begun, _ = stored(_ranked(best_in_tasks(vectors.where(first), block, floors, k, n_docs, n_terms, item_type), k), "first-found")
    for place, least in begun.where(F.col("_rank") == k).select("_place", "_score").collect():  # one number an item
        floors[place] = least
    rest = best_in_tasks(vectors.where(~first), block, floors, k, n_docs, n_terms, item_type)
    ranked = _ranked(begun.drop("_rank").union(rest), k)
    return ranked.select(F.col("_item").alias(item_key), F.col("_rank").alias("rank"), F.col("_key").alias(key), F.col("_score").alias("score"))


def top_documents(items: DataFrame, docs: DataFrame, k: int = 20, item_key: str = "item_id", item_text: str = "text", key: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """(item_key, rank, key, score): the k highest-scoring documents of every item with a score above 0, fewer if there are fewer.

    Every row of items is an item of its own and every row of docs a document, also where keys repeat or are NULL (last among equal
    scores). NULL and empty texts hold no term: such items have no rows, such documents are found by none. Other
    columns take no part. Weights, lengths and scores follow the whole corpus.
    """
    numbered, path = stored(items.select(F.col(item_key).alias("_item"), F.col(item_text).alias("_text"), F.monotonically_increasing_id().alias("_row")), "items")
    total = numbered.agg(F.coalesce(F.sum(F.octet_length("_text")), F.lit(0))).first()[0]
    blocks, kind = max(1, -(-total // BLOCK)), items.schema[item_key].dataType
    found = None
    for b in range(blocks):
        held = numbered.where(F.col("_row") % blocks == b).orderBy("_row").select("_item", "_text").collect()
        part = _block(held, docs, item_key, kind, key, text, k)
        found = part if found is None else found if part is None else found.union(part)
    discard(docs.sparkSession, path)
    if found is None:
        return docs.sparkSession.createDataFrame([], f"`{item_key}` {kind.simpleString()}, rank int, `{key}` {docs.schema[key].dataType.simpleString()}, score long")
    return found
