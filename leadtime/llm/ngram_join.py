"""Exact Jaccard join of word-shingle sets by a partitioned universe and pigeonholes.

Sets are put into size bands. For a band, shingles fall by hash into ``m``
segments. Two sets of the band (or of it and the next) that are similar enough differ in at most H
shingles, so with m = H + 1 + spare segments they agree on more than ``spare`` of them.
A set emits a key for each of its segments that holds two shingles or more; emptier segments
are costly, as many unlike sets agree on them. A set with more than ``spare`` costly segments also emits the
one-deletion neighbourhoods of its segments in a partition half as fine, where some pair of
segments differs by one shingle at most: so two such sets meet as well. ``spare`` is chosen per
band by the expected number of keys. Sets that share a key are candidates; they are compared exactly.

Each text is split and hashed once; its shingles are stored. Keys are shuffled in passes, one range of their hashes after
the other, and candidates are compared in rounds, so that a shuffle stays near half of the stored shingles at any size of the input.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from leadtime.llm.common import bits_table, cut_lineage, discard, lower_words, small_batches, stored
from leadtime.llm.components import components

#: Ratio of a band's ends; shingles of a block of candidates compared in one go; bits of the filters.
RATIO, BLOCK, KEY_BITS, CLASS_BITS = 1.4, 1_000_000, 26, 23
#: Shingles whose keys are made in one go; bytes of a shuffled key; of the stored shingles, the share that the keys of a pass may take.
CHUNK, KEY_BYTES, PASS_SHARE = 300_000, 18, 0.5
#: Names of sets that a worker remembers to leave out copies.
REMEMBERED = 100_000
K1, K2, K3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def word_hashes(text: Column) -> Column:
    return F.transform(lower_words(text), lambda w: F.xxhash64(w))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * K2
    x = (x ^ (x >> np.uint64(27))) * K3
    return x ^ (x >> np.uint64(31))


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct 64-bit shingles of a text's word hashes; a shorter text is one shingle."""
    return batch_shingles([hashes], width)[0]


def batch_shingles(texts: list[np.ndarray], width: int) -> list[np.ndarray]:
    """The shingles of each text. Texts are hashed end to end; windows that reach into the next text are left out."""
    if not texts:
        return []
    h = np.concatenate(texts).astype(np.uint64)
    ends = np.cumsum([len(t) for t in texts])
    every = rolled(h, width) if len(h) >= width else h[:0]
    out = []
    for end, t in zip(ends.tolist(), texts):
        n = len(t)
        s = every[end - n:end - width + 1] if n >= width else rolled(h[end - n:end], n)
        s = np.sort(s)
        out.append(s[np.concatenate([[True], s[1:] != s[:-1]])] if len(s) else s)
    return out


def rolled(h: np.ndarray, width: int) -> np.ndarray:
    """One number for each window of ``width`` word hashes."""
    if not width:
        return h[:0]
    rows = len(h) - width + 1
    s = np.full(rows, width, np.uint64)
    for i in range(width):
        s = mixed(s * K1 + h[i:i + rows])
    return s


def set_class(tokens: np.ndarray) -> int:
    """One 64-bit number for a set; sets with one number are taken to be equal."""
    return int((mixed(tokens * K1).sum(dtype=np.uint64) + np.uint64(len(tokens)) * K3).astype(np.int64))


class Scheme:
    """How sets are cut for pairs whose smaller set lies in one band."""

    def __init__(self, number: int, low: int, high: int, percent: int):
        self.number, self.low, self.high = number, low, high
        small = high - 1
        large = small * 100 // percent
        self.apart = (100 - percent) * (small + large) // (100 + percent)
        self.half = (self.apart + 2) // 2
        middle = (low + high) / 2
        best = (middle + self.half, -1)  # deletion neighbourhoods for every set
        for spare in range(self.apart + 2):
            m = self.apart + 1 + spare
            p = math.exp(-middle / m) * (1 + middle / m)
            tail = 0.5 * math.erfc((spare + 0.5 - m * p) / math.sqrt(2 * m * p * (1 - p) + 1e-9))
            best = min(best, (m * (1 - p) + tail * (middle + self.half), spare))
        self.spare = best[1]

    def keys(self, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The keys of all sets and, for each key, the place of its set in the list."""
        if not self.apart or not sets:
            return np.empty(0, np.uint64), np.empty(0, np.int64)  # only equal sets, which are one class
        flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        each = mixed(flat ^ K3)
        again, out = np.ones(len(sets), bool), []
        if self.spare >= 0:
            m = self.apart + 1 + self.spare
            _, sizes, sums = self._cut(flat, owner, each, len(sets), m)
            cheap = np.flatnonzero(sizes > 1)
            again = m - np.bincount(cheap // m, minlength=len(sets)) > self.spare
            out.append((self._name(sums[cheap], cheap % m, 0), cheap // m))
        if again.any():
            m, some = self.half, again[owner]
            at, sizes, sums = self._cut(flat[some], owner[some], each[some], len(sets), m)
            whole = np.flatnonzero(np.repeat(again, m))
            out += [(self._name(sums[whole], whole % m, 1), whole // m), (self._name(sums[at] - each[some], at % m, 1), at // m)]
        return np.concatenate([k for k, _ in out]), np.concatenate([w for _, w in out])

    @staticmethod
    def _cut(flat: np.ndarray, owner: np.ndarray, each: np.ndarray, n: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each token's segment, and size and sum of the segments, m for each of n sets; sorted tokens lie in rising segments."""
        at = owner * m + (((flat >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)).astype(np.int64)
        sizes = np.bincount(at, minlength=n * m)
        through = np.concatenate([np.zeros(1, np.uint64), np.cumsum(each, dtype=np.uint64)])
        ends = np.cumsum(sizes)
        return at, sizes, through[ends] - through[ends - sizes]

    def expected(self) -> float:
        """About how many keys a set emits."""
        return 0 if not self.apart else self.apart + 1 + self.spare if self.spare >= 0 else self.high + self.half

    def _name(self, sums: np.ndarray, segment: np.ndarray, kind: int) -> np.ndarray:
        return mixed(sums * K1 + (segment.astype(np.uint64) * np.uint64(4096) + np.uint64(self.number * 2 + kind)) * K2)


@lru_cache(maxsize=None)
def schemes_of(size: int, percent: int) -> tuple[Scheme, ...]:
    """The schemes in which a set of this size has partners: its own band's, and those of smaller sets within reach."""
    bands = [(1, 2)]
    while bands[-1][1] <= size:
        low = bands[-1][1]
        bands.append((low, max(low + 1, int(low * RATIO))))
    return tuple(scheme(i, low, high, percent) for i, (low, high) in enumerate(bands) if (high - 1) * 100 >= percent * size)


@lru_cache(maxsize=None)
def scheme(number: int, low: int, high: int, percent: int) -> Scheme:
    return Scheme(number, low, high, percent)


def signatures(sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys of sets, and the place of each key's set: two sets with at least ``percent`` % in common share a key, unless they
    are equal."""
    by_scheme = {}
    for i, s in enumerate(sets):
        for one in schemes_of(len(s), percent) if len(s) else ():
            by_scheme.setdefault(one, []).append(i)
    keys, places = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for one, mine in by_scheme.items():
        k, at = one.keys([sets[i] for i in mine])
        keys.append(k)
        places.append(np.array(mine, np.int64)[at])
    return np.concatenate(keys).astype(np.int64), np.concatenate(places)


def signature(tokens: np.ndarray, percent: int) -> np.ndarray:
    """The distinct keys of one set."""
    return np.unique(signatures([tokens], percent)[0])


def chunks(sets: list[np.ndarray], tokens: int = CHUNK) -> Iterator[list[int]]:
    """Places of consecutive sets, about ``tokens`` shingles at a time."""
    begun, held = 0, 0
    for i, s in enumerate(sets):
        held += len(s)
        if held >= tokens or i + 1 == len(sets):
            yield list(range(begun, i + 1))
            begun, held = i + 1, 0


def linked(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect all sets of a list which similar pairs connect, at most one per set.

    A set's shingles that no other set of the list has bound its overlap with any, so
    that most loners are never compared. The others are counted against all sets at
    once over an inverted list. Members of the largest group are put off, as the rest finds their links; those
    that another group has overtaken by the end take their turn then, so that all sets never compared lie in one group.
    """
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(flat, kind="stable")
    first = np.concatenate([[True], np.diff(flat[order]) != 0])
    run = np.cumsum(first) - 1
    begin = np.flatnonzero(first)
    common = np.diff(np.append(begin, len(flat)))
    token = np.empty(len(flat), np.int64)
    token[order] = run
    holders = owner[order]
    shared = np.bincount(owner[common[token] > 1], minlength=len(sets))
    alive = shared * 100 >= percent * sizes
    root = np.arange(len(sets))
    members = {}  # of the groups of two sets or more
    largest, most = -1, 1
    starts = np.concatenate([[0], np.cumsum(sizes)])
    edges = []
    todo = np.flatnonzero(alive)
    todo = todo[np.argsort(sizes[todo] - shared[todo], kind="stable")]
    while len(todo):
        put_off = []
        for r in todo:
            if root[r] == largest:
                put_off.append(r)
                continue
            mine = token[starts[r]:starts[r + 1]]
            mine = mine[common[mine] > 1]
            n = common[mine]
            at = np.repeat(begin[mine] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            met, overlap = np.unique(holders[at], return_counts=True)
            near = met[alive[met] & (overlap * 100 >= percent * (sizes[r] + sizes[met] - overlap)) & (root[met] != root[r])]
            for s in near:
                if root[s] != root[r]:
                    edges.append((int(r), int(s)))
                    one, two = (members.pop(root[x], [x]) for x in (r, s))
                    few, many = sorted((one, two), key=len)
                    to = root[many[0]]
                    root[few] = to
                    many.extend(few)
                    members[to] = many
                    if len(many) > most:
                        largest, most = to, len(many)
        todo = [r for r in put_off if root[r] != largest]
    return edges


def _over_hashes(docs: DataFrame, key: str, text: str, make, schema: str) -> DataFrame:
    """Run ``make(key column, list of word-hash arrays, set that lasts for a task)`` over batches of whole texts."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = set()
        with np.errstate(over="ignore"):
            for batch in it:
                lists = batch.column(1)
                offsets = np.asarray(lists.offsets)
                flat = np.asarray(lists.values)
                yield from make(batch.column(0), [flat[a:b] for a, b in zip(offsets[:-1], offsets[1:])], met)

    return docs.select(F.col(key).alias("key"), word_hashes(F.col(text)).alias("h")).mapInArrow(batches, schema)


def _bitmap(keys: DataFrame, key: str, log2_bits: int) -> np.ndarray:
    """A bitmap of hashed keys on the driver: 2 ** log2_bits bits, whatever the number of keys."""
    rows = bits_table(keys, key, log2_bits).toArrow()
    out = np.zeros(1 << (log2_bits - 6), np.int64)
    out[rows["_slot"].to_numpy()] = rows["_bits"].to_numpy()
    return out.view(np.uint8)


def _hits(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys & ((len(bitmap) * 8) - 1)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def outer_stars(stars: DataFrame) -> DataFrame:
    """The rows (center, c) without the stars whose sets another star holds, too, where all their pairs are compared.

    A star is held against that of its center's smallest center. As that one is smaller, the last of a chain of such stars stays.
    """
    outer = stars.groupBy(F.col("c").alias("center")).agg(F.min("center").alias("_outer"))
    held = stars.select(F.col("center").alias("_outer"), "c", F.lit(1).alias("_held"))
    inside = (stars.join(outer, "center").join(held, ["_outer", "c"], "left").groupBy("center")
              .agg(F.count("_held").alias("_n_held"), F.count("*").alias("_n")).where("_n_held = _n").select("center"))
    return stars.join(inside, "center", "left_anti")


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 4, percent: int = 85) -> DataFrame:
    """(key, n_shingles, component_id, set_class) of every row.

    component_id is the smallest key reachable by links, the row's own
    included. Texts without words (NULL or empty too) have no shingles and link with nothing. Equal sets are
    one class from the start, so copies are neither compared nor joined; a repeated key counts for each of its rows.
    A NULL key takes no part in finding the smallest, and stays NULL only where nothing else is linked.
    """
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()

    def facts(keys, texts, met):
        for some in chunks(texts):
            sets = batch_shingles([texts[i] for i in some], width)
            names = [set_class(s) if len(s) else None for s in sets]
            if len(met) > REMEMBERED:
                met.clear()
            # a copy of a set that was met is the same set
            held = [s.tobytes() if c is not None and not (c in met or met.add(c)) else None for s, c in zip(sets, names)]
            yield pa.RecordBatch.from_arrays([keys.slice(some[0], len(some)), pa.array([len(s) for s in sets], pa.int64()), pa.array(names, pa.int64()),
                                              pa.array([round(sum(x.expected() for x in schemes_of(len(s), percent))) if h else 0 for s, h in zip(sets, held)], pa.int64()),
                                              pa.array(held, pa.binary())], ["key", "n_shingles", "set_class", "n_keys", "tokens"])

    with small_batches(spark):
        stored_sets = cut_lineage(_over_hashes(docs, key, text, facts, f"key {kind}, n_shingles long, set_class long, n_keys long, tokens binary"), "shingle-sets")
    rows = stored_sets.select("key", "n_shingles", "set_class")
    held_sets = stored_sets.where("tokens is not null").select(F.col("set_class").alias("c"), "tokens")
    n_keys, n_tokens = stored_sets.where("tokens is not null").agg(F.sum("n_keys"), F.sum("n_shingles")).first()
    passes = max(1, math.ceil((n_keys or 0) * KEY_BYTES / (PASS_SHARE * 8 * (n_tokens or 1))))

    def emitted(number, bitmap=None):
        def make(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            with np.errstate(over="ignore"):
                for batch in it:
                    classes = batch.column(0).to_numpy()
                    sets = [np.frombuffer(x, np.uint64) for x in batch.column(1).to_pylist()]
                    for some in chunks(sets):
                        k, at = signatures([sets[i] for i in some], percent)
                        mine = (k.view(np.uint64) >> np.uint64(40)) % np.uint64(passes) == number
                        k, at = k[mine], at[mine]
                        if bitmap is not None:
                            hit = _hits(bitmap.value, k)
                            k, at = k[hit], at[hit]
                        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(classes[some][at])], ["k", "c"])

        return held_sets.mapInArrow(make, "k long, c long")

    stars = None
    for number in range(passes):  # as many as keys for each shingle ask for, whatever the number of rows
        with small_batches(spark):
            shared, path = stored(emitted(number).groupBy("k").agg(F.min("c").alias("center"), F.max("c").alias("_other"))
                                  .where("center <> _other").select("k", "center"), "shared-keys")
        some_keys = spark.sparkContext.broadcast(_bitmap(shared, "k", KEY_BITS))
        met = emitted(number, some_keys).join(shared, "k").select("center", "c").where("center <> c").distinct()
        with small_batches(spark):
            some_stars = cut_lineage(met, "stars")
        stars = some_stars if stars is None else stars.union(some_stars)
        some_keys.destroy()
        discard(spark, path)
    stars = cut_lineage(outer_stars(stars.distinct() if passes > 1 else stars), "stars")
    members = stars.union(stars.select("center", F.col("center").alias("c")).distinct())
    held = members.join(rows.where("set_class is not null").groupBy(F.col("set_class").alias("c")).agg(F.max("n_shingles").alias("n")), "c")
    weight = held.groupBy("center").agg(F.greatest(F.lit(1), F.ceil(F.sum("n") / BLOCK)).cast("int").alias("blocks"))
    placed = cut_lineage(held.join(weight, "center").withColumn("_own", F.pmod(F.xxhash64("c"), F.col("blocks")).cast("int"))
                         .withColumn("_with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                         .select("center", "c", F.least("_own", "_with").alias("i"), F.greatest("_own", "_with").alias("j"), "n").distinct(), "placed-sets")
    rounds = max(1, math.ceil((placed.agg(F.sum("n")).first()[0] or 0) / (PASS_SHARE * (n_tokens or 1))))

    def compare(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, names, sets_held = None, [], []

        def done():
            if len(names) > 1:
                edges = linked(sets_held, percent)
                if edges:
                    yield pa.RecordBatch.from_arrays([pa.array([names[a] for a, _ in edges], pa.int64()), pa.array([names[b] for _, b in edges], pa.int64())], ["a", "b"])

        for batch in it:
            for center, i, j, c, tokens in zip(*(x.to_pylist() for x in batch.columns)):
                if (center, i, j) != group:
                    yield from done()
                    group, names, sets_held = (center, i, j), [], []
                names.append(c)
                sets_held.append(np.frombuffer(tokens, np.uint64))
        yield from done()

    links = None
    for number in range(rounds):  # so many that the shingles shuffled in one are about half of those stored
        some = placed.where(F.pmod(F.xxhash64("center", "i", "j"), F.lit(rounds)) == number).drop("n")
        classes = spark.sparkContext.broadcast(_bitmap(some.select("c").distinct(), "c", CLASS_BITS))

        def wanted(it: Iterator[pa.RecordBatch], bitmap=classes) -> Iterator[pa.RecordBatch]:
            for batch in it:
                yield batch.filter(pa.array(_hits(bitmap.value, batch.column(0).to_numpy())))

        sets = held_sets.mapInArrow(wanted, "c long, tokens binary").groupBy("c").agg(F.first("tokens").alias("tokens"))
        grouped = (some.join(sets, "c").repartition("center", "i", "j")
                   .sortWithinPartitions("center", "i", "j", "c").select("center", "i", "j", "c", "tokens"))
        with small_batches(spark):
            found = cut_lineage(grouped.mapInArrow(compare, "a long, b long"), "links")
        links = found if links is None else links.union(found)
        classes.destroy()
    roots = components(links)
    least = rows.where("set_class is not null").groupBy("set_class").agg(F.min("key").alias("_least"))
    rooted = least.join(roots, F.col("set_class") == F.col("node"), "left").select("set_class", "_least", F.coalesce("root", "set_class").alias("_root"))
    smallest = rooted.groupBy("_root").agg(F.min("_least").alias("component_id"))
    named = rooted.join(smallest, "_root").select(F.col("set_class").alias("_class"), "component_id")
    return (rows.join(named, F.col("set_class") == F.col("_class"), "left")
            .select(F.col("key").alias(key), "n_shingles", F.coalesce("component_id", "key").alias("component_id"), "set_class"))
