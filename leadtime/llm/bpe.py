"""BPE encoding with a lexicon of frequent words in a minimal acyclic automaton.

The corpus' frequent words are compiled into an automaton that shares prefixes
and suffixes. Every edge carries the number of words that sort before it, so that
the sum along a path is the word's number, and a table gives the ids of that
number. The file is shipped to all executors once and memory-mapped by their
Python workers. Words outside the lexicon are merged by the tokenizer's
own rules, so that the lexicon decides the speed and never the result.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, functions as F

from leadtime.llm.common import cut_lineage, scratch_path
from leadtime.llm.files import write_whole

#: How the tokenizer cuts a text into words (a fixed pattern of its file format). The JVM form only counts words for the lexicon.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
#: The same for ASCII texts, in the standard library's faster engine.
ASCII_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\x20\x09-\x0DA-Za-z0-9]+|[\x20\x09-\x0D]+(?![^\x20\x09-\x0D])|[\x20\x09-\x0D]+"
JVM_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
LEXICON_WORDS = 150_000
#: The rank of a pair that is never joined.
NEVER = 1 << 30
#: Longer words are merged with a heap.
LONG = 100
#: Words that a worker remembers between batches.
REMEMBERED = 400_000
#: Characters of texts whose words a worker holds at the same time.
TOGETHER = 1 << 20


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the rest from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Rules:
    """Vocabulary and merges of one tokenizer file."""

    def __init__(self, text: str):
        spec = json.loads(text)
        letters = byte_letters()
        plain = {t: bytes(letters[c] for c in t) for t in spec["model"]["vocab"]}
        self.ids = {plain[t]: i for t, i in spec["model"]["vocab"].items()}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        self.ranks = {(plain[a], plain[b]): r for r, (a, b) in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        known = {i: b for b, i in self.ids.items()} | {i: t.encode() for t, i in self.special.items()}
        self.bytes = [known.get(i) for i in range(max(known) + 1)]
        # the pairs once more as sorted numbers, with the rank and the id of what they are joined to
        self.size = len(self.bytes)
        pairs, ids = list(self.ranks), self.ids.__getitem__
        first, second, joined = (np.array([*map(ids, n)], np.int64) for n in ((a for a, _ in pairs), (b for _, b in pairs), (a + b for a, b in pairs)))
        order = np.argsort(first * self.size + second)
        self.pair, self.rank, self.joined = (first * self.size + second)[order], np.array([*self.ranks.values()], np.int64)[order], joined[order]
        self.single = np.array([self.ids.get(bytes([b]), -1) for b in range(256)], np.int64)

    def merge(self, word: bytes) -> list[int]:
        """The ids of one word: the best-ranked pair is joined, everywhere, until no pair has a rank."""
        if word in self.ids and len(word) == 1:
            return [self.ids[word]]
        if len(word) > LONG:
            return self.merge_long(word)
        parts = [word[i:i + 1] for i in range(len(word))]
        rank = self.ranks.get
        scores = [rank(p, NEVER) for p in zip(parts, parts[1:])]
        while scores and (best := min(scores)) != NEVER:
            i = scores.index(best)
            a, b = parts[i], parts[i + 1]
            while i < len(scores):  # every place of this pair, from the left
                if scores[i] == best and parts[i] == a and parts[i + 1] == b:
                    parts[i:i + 2] = [a + b]
                    del scores[i]
                    if i:
                        scores[i - 1] = rank((parts[i - 1], parts[i]), NEVER)
                    if i < len(scores):
                        scores[i] = rank((parts[i], parts[i + 1]), NEVER)
                i += 1
        return [self.ids[p] for p in parts]

    def look(self, flat: np.ndarray, owner: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and joined id of the pairs that begin at these places; NEVER where the word ends or the pair is not joined."""
        after = np.minimum(at + 1, len(flat) - 1)
        key = flat[at] * self.size + flat[after]
        place = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        hit = (self.pair[place] == key) & (owner[at] == owner[after]) & (after > at)
        return np.where(hit, self.rank[place], NEVER), self.joined[place]

    def merge_many(self, words: list[bytes]) -> list[bytes]:
        """``merge`` of each word, as little-endian 32-bit numbers. Words of up to LONG bytes go together: a step joins the best pair of each, at all its places."""
        out = [b""] * len(words)
        short = []
        for i, w in enumerate(words):
            if len(w) > LONG or not len(self.pair):
                out[i] = np.array(self.merge(w), "<u4").tobytes()
            elif w:
                short.append(i)
        if not short:
            return out
        flat = self.single[np.frombuffer(b"".join(words[i] for i in short), np.uint8)]
        if (flat < 0).any():
            raise KeyError("a byte is not in the vocabulary")
        owner = np.repeat(np.arange(len(short)), [len(words[i]) for i in short])
        ranks, joined = self.look(flat, owner, np.arange(len(flat)))
        owners, ids = [], []
        while len(flat):
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            best = np.repeat(np.minimum.reduceat(ranks, starts), np.diff(starts, append=len(flat)))
            going = best != NEVER
            if not going.all():
                owners.append(owner[~going])
                ids.append(flat[~going])
                flat, owner, ranks, joined, best = flat[going], owner[going], ranks[going], joined[going], best[going]
            at = np.flatnonzero(ranks == best)
            if not len(at):
                break
            # a pair of equal parts may overlap itself: from the left, every other one is joined
            first = np.diff(at, prepend=-2) != 1
            nth = np.arange(len(at))
            at = at[(nth - np.maximum.accumulate(np.where(first, nth, 0))) % 2 == 0]
            flat[at] = joined[at]
            left = np.ones(len(flat), bool)
            left[at + 1] = False
            flat, owner, ranks, joined = flat[left], owner[left], ranks[left], joined[left]
            at -= np.arange(len(at))
            changed = np.concatenate([at, at[at > 0] - 1])
            ranks[changed], joined[changed] = self.look(flat, owner, changed)
        owner, flat = np.concatenate(owners), np.concatenate(ids)
        order = np.argsort(owner, kind="stable")
        raw, ends = flat[order].astype("<u4").tobytes(), (4 * np.cumsum(np.bincount(owner, minlength=len(short)))).tolist()
        for i, begin, end in zip(short, [0, *ends], ends):
            out[i] = raw[begin:end]
        return out

    def merge_long(self, word: bytes) -> list[int]:
        """The same for words of any length, with a heap of pairs instead of a scan for each merge."""
        n = len(word)
        parts: list[bytes | None] = [word[i:i + 1] for i in range(n)]
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        rank = self.ranks.get
        heap = [(r, i) for i in range(n - 1) if (r := rank((parts[i], parts[i + 1]), NEVER)) != NEVER]
        heapify(heap)
        while heap:
            r, i = heappop(heap)
            j = right[i]
            if parts[i] is None or j < 0 or rank((parts[i], parts[j]), NEVER) != r:
                continue  # one of the two was joined meanwhile
            parts[i], parts[j] = parts[i] + parts[j], None
            right[i] = right[j]
            if right[j] >= 0:
                left[right[j]] = i
            for a, b in ((left[i], i), (i, right[i])):
                if a >= 0 and b >= 0 and (r := rank((parts[a], parts[b]), NEVER)) != NEVER:
                    heappush(heap, (r, a))
        return [self.ids[p] for p in parts if p is not None]


def compile_words(words: list[bytes], outputs: list[list[int]]) -> dict[str, np.ndarray]:
    """The minimal automaton of sorted, distinct words, and their outputs, as flat arrays.

    States that accept the same endings are one state. Edge arrays are sorted by
    (state, byte); ``ahead`` of an edge is the number of words below the state that
    sort before the edge's words.
    """
    known: dict[tuple, int] = {}
    finals: list[bool] = []
    edges: list[tuple] = []
    counts: list[int] = []

    def state(final: bool, out: list[tuple[int, int]]) -> int:
        signature = (final, *out)
        if signature not in known:
            known[signature] = len(finals)
            finals.append(final)
            edges.append(tuple(out))
            counts.append(final + sum(counts[t] for _, t in out))
        return known[signature]

    path: list[list] = [[False, []]]  # open states of the last word: final, finished edges
    last = b""

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            final, out = path.pop()
            path[-1][1].append((last[len(path) - 1], state(final, out)))

    for word in words:
        same = 0
        while same < min(len(word), len(last)) and word[same] == last[same]:
            same += 1
        close(same)
        path.extend([False, []] for _ in range(len(word) - same))
        path[-1][0] = True
        last = word
    close(0)
    root = state(*path[0])
    keys, targets, ahead = [], [], []
    for s, out in enumerate(edges):
        before = int(finals[s])
        for byte, t in out:
            keys.append(s * 256 + byte)
            targets.append(t)
            ahead.append(before)
            before += counts[t]
    lengths = np.array([len(o) for o in outputs], np.int64)
    return {"keys": np.array(keys, np.int64), "targets": np.array(targets, np.int64), "ahead": np.array(ahead, np.int64),
            "finals": np.array(finals, np.int64), "root": np.array([root], np.int64), "starts": np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64),
            "ids": np.array([i for o in outputs for i in o], np.int64)}


def pack(arrays: dict[str, np.ndarray]) -> bytes:
    """One block of 64-bit numbers: the lengths of all parts, then the parts."""
    names = sorted(arrays)
    return np.concatenate([np.array([len(arrays[n]) for n in names], np.int64), *[arrays[n] for n in names]]).astype("<i8").tobytes()


class Lexicon:
    """A memory-mapped automaton."""

    NAMES = ("ahead", "finals", "ids", "keys", "root", "starts", "targets")

    def __init__(self, path: str):
        whole = np.memmap(path, "<i8", "r")
        at = len(self.NAMES)
        for name, n in zip(self.NAMES, whole[:at].tolist()):
            setattr(self, name, whole[at:at + n])
            at += n

    def find(self, words: list[bytes]) -> np.ndarray:
        """Numbers of the words in sorted order of the lexicon, -1 for others; all words walk together, byte by byte."""
        lengths = np.array([len(w) for w in words], np.int64)
        number, state = np.zeros(len(words), np.int64), np.full(len(words), self.root[0])
        if not len(words) or not len(self.keys):
            return np.full(len(words), -1)
        flat = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum(lengths) - lengths
        alive = np.flatnonzero(lengths > 0)
        lost = lengths == 0
        depth = 0
        while len(alive):
            key = state[alive] * 256 + flat[starts[alive] + depth]
            edge = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[edge] == key
            lost[alive[~hit]] = True
            alive, edge = alive[hit], edge[hit]
            number[alive] += self.ahead[edge]
            state[alive] = self.targets[edge]
            depth += 1
            alive = alive[lengths[alive] > depth]
        return np.where(lost | (self.finals[state] == 0), -1, number)

    def output(self, number: int) -> np.ndarray:
        return self.ids[self.starts[number]:self.starts[number + 1]]


class Encoder:
    """Encodes texts in one Python worker."""

    def __init__(self, rules: Rules, lexicon: Lexicon | None):
        self.rules, self.lexicon, self.known = rules, lexicon, {}
        self.cut_any, self.cut_ascii = regex.compile(PATTERN, regex.V1).findall, re.compile(ASCII_PATTERN).findall
        special = "|".join(regex.escape(s) for s in sorted(rules.special, key=len, reverse=True))
        self.special = regex.compile(f"({special})") if special else None

    def cut(self, text: str) -> list[str]:
        return self.cut_ascii(text) if text.isascii() else self.cut_any(text)

    def pieces(self, text: str) -> list[str]:
        """Words of a text; special tokens stand alone."""
        if self.special is None or not any(s in text for s in self.rules.special):
            return self.cut(text)
        return [w for part in self.special.split(text) for w in ([part] if part in self.rules.special else self.cut(part))]

    def learn(self, words: set[str]) -> None:
        """Ids of words not met before, as little-endian 32-bit numbers: from the automaton, else by merging."""
        fresh = sorted(words - self.known.keys())
        plain = [w.encode() for w in fresh]
        numbers = self.lexicon.find(plain) if self.lexicon else np.full(len(fresh), -1)
        rest = []
        for word, raw, number in zip(fresh, plain, numbers.tolist()):
            if word in self.rules.special:
                self.known[word] = np.asarray([self.rules.special[word]], "<u4").tobytes()
            elif number >= 0:
                self.known[word] = self.lexicon.output(number).astype("<u4").tobytes()
            else:
                rest.append((word, raw))
        self.known.update(zip([word for word, _ in rest], self.rules.merge_many([raw for _, raw in rest])))

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text; new words of some texts at a time are looked up together."""
        some, size = [], 0
        for text in texts:
            some.append(text)
            size += len(text)
            if size >= TOGETHER:
                yield from self.encode_some(some)
                some, size = [], 0
        yield from self.encode_some(some)

    def encode_some(self, texts: list[str]) -> Iterator[bytes]:
        cuts = [self.pieces(t) for t in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        self.learn(set().union(*cuts))
        for cut in cuts:
            yield b"".join(map(self.known.__getitem__, cut))

    def decode(self, ids: bytes) -> str:
        table = self.rules.bytes
        return b"".join(map(table.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def frequent_words(docs: DataFrame, text: str = "text", n: int = LEXICON_WORDS) -> list[str]:
    """The most frequent words of all texts, ``n`` at most: those at least as frequent as a threshold.

    A histogram of counts gives the threshold, so that no more than ``n`` words
    leave the executors, however many partitions there are.
    """
    cut = docs.select(F.explode(F.regexp_extract_all(F.col(text), F.lit(JVM_PATTERN), F.lit(0))).alias("word"))
    counted = cut_lineage(cut.groupBy("word").count().where("count > 1"), "word-counts")
    step = F.floor(F.log2("count") * 16)
    total, least = 0, None
    for r in counted.groupBy(step.alias("step")).agg(F.count("*").alias("words"), F.min("count").alias("least")).orderBy(F.desc("step")).collect():
        total += r["words"]
        if total > n:
            break
        least = r["least"]
    return [] if least is None else [r["word"] for r in counted.where(F.col("count") >= least).select("word").collect()]


def build_lexicon(docs: DataFrame, rules: Rules, text: str = "text", n: int = LEXICON_WORDS) -> str:
    """Compile the frequent words, store the file in the shared folder and ship it; returns its name on the executors."""
    spark = docs.sparkSession
    words = sorted({w.encode() for w in frequent_words(docs, text, n)})
    data = pack(compile_words(words, [np.frombuffer(ids, "<u4").tolist() for ids in rules.merge_many(words)]))
    path = scratch_path(spark, "lexicon")
    write_whole(path, data)
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[1]


def encode(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", lexicon: str | None = None, ids: bool = True) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of every row, and with ``ids`` the ids and the decoded text.

    NULL counts as an empty text and has no ids. Special tokens in a text are encoded as
    such. ``tokenizer`` is the driver's path of a byte-level BPE file. Texts are handled one by one, whole.
    """
    with open(tokenizer, encoding="utf-8") as f:
        spec = f.read()
    spark = docs.sparkSession
    name = lexicon or build_lexicon(docs, Rules(spec), text)
    held = spark.sparkContext.broadcast(spec)  # the tokenizer file, of a fixed size
    kind = docs.schema[key].dataType.simpleString()
    more = ", ids array<int>, decoded string" if ids else ""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Rules(held.value), Lexicon(SparkFiles.get(name)))
        for batch in it:
            texts = ["" if t is None else t for t in batch.column(1).to_pylist()]
            n, digests, back, all_ids, decoded = [], [], [], [], []
            for raw in encoder.encode(texts):
                plain = encoder.decode(raw)
                n.append(len(raw) // 4)
                digests.append(hashlib.sha256(raw).hexdigest())
                back.append(hashlib.sha256(plain.encode()).hexdigest())
                if ids:
                    all_ids.append(np.frombuffer(raw, "<u4").astype(np.int32))
                    decoded.append(plain)
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(digests, pa.string()), pa.array(back, pa.string())]
            if ids:
                columns += [pa.array(all_ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"][:len(columns)])

    schema = f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string{more}"
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(batches, schema).withColumnRenamed("key", key)
