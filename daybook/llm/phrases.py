"""Collocations of two and three words, counted in HAT-tries.

Every task numbers its words and counts word triples (a piece's last pair without a third word) per
language in a shallow trie of word numbers whose leaves are hash containers over a range of words. A
container that grows too large is split between two words; one that holds a single word is burst into a
node over the words that follow it. When a task holds too many entries, whole subtrees, the ones whose
entries recur least, are spilled as runs sorted by phrase. Runs are dealt by the phrase's first
two words and merged part by part as they stream in; a pair's count is the sum over its subtree.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.shared import materialise, text_batches

BREAKS, BLANKS = b".,;:!?\n\x0b\x0c\r", b"\x20\t"
KINDS = np.zeros(256, np.uint8)
KINDS[list(BLANKS)], KINDS[list(BREAKS)] = 1, 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
WORD_BITS = 21
WORD_MASK = (1 << WORD_BITS) - 1
CONTAINER = 16_384  # entries before it is split or burst
ENTRIES = 1_000_000  # a task holds; beyond that it spills half of them
WORDS = 1 << 20  # a task numbers; beyond that it spills everything and starts anew
CHARS_AT_ONCE = 4_000_000
MERGE_AT_ONCE = 1_000_000
PART_BYTES = 32 << 20  # of texts for each part that is merged by itself
MIN_PARTS = 64
SHARES = 64


def split_words(texts: list[str]) -> tuple[pa.StringArray, np.ndarray]:
    """All words of the texts, lower-cased (A to Z), and which of them begin a piece."""
    data = np.frombuffer("\n".join(texts).encode(), np.uint8)
    kind = KINDS[data]
    inside = kind == 0
    border = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]])))
    starts, ends = border[::2], border[1::2]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(LOWER[data[inside]]))
    breaks = np.cumsum(kind == 2)[starts] if len(starts) else np.zeros(0, np.int64)
    return words, np.diff(breaks, prepend=-1) != 0


class Run(NamedTuple):
    """Sorted phrases with counts: distinct prefixes, how many entries each has, their last words ('': none)."""

    prefixes: pa.StringArray
    sizes: np.ndarray
    lasts: pa.StringArray
    counts: np.ndarray

    def pack(self) -> bytes:
        raw = b"".join([*map(_string_bytes, (self.prefixes, self.lasts)), self.sizes.astype(np.int32).tobytes(),
                        self.counts.astype(np.int64).tobytes()])
        return np.array([len(self.prefixes), len(self.lasts), len(raw)], np.int64).tobytes() + pa.Codec("zstd").compress(raw, asbytes=True)

    @staticmethod
    def unpack(packed: bytes) -> Run:
        n_prefixes, n, size = np.frombuffer(packed[:24], np.int64).tolist()
        raw = pa.Codec("zstd").decompress(packed[24:], size, asbytes=True)
        prefixes, at = _strings(raw, 0, n_prefixes)
        lasts, at = _strings(raw, at, n)
        sizes = np.frombuffer(raw, np.int32, n_prefixes, at)
        return Run(prefixes, sizes, lasts, np.frombuffer(raw, np.int64, n, at + 4 * n_prefixes))


def _string_bytes(words: pa.StringArray) -> bytes:
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1]
    data = words.buffers()[2]
    return np.diff(ends).astype(np.int32).tobytes() + (data.slice(int(ends[0]), int(ends[-1] - ends[0])).to_pybytes() if data else b"")


def _strings(raw: bytes, at: int, n: int) -> tuple[pa.StringArray, int]:
    ends = np.concatenate([[0], np.cumsum(np.frombuffer(raw, np.int32, n, at))]).astype(np.int32)
    at += 4 * n
    return pa.StringArray.from_buffers(n, pa.py_buffer(ends), pa.py_buffer(raw[at:at + int(ends[-1])])), at + int(ends[-1])


def _ranked(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Place of every word among the distinct ones by byte order, and those."""
    coded = words.dictionary_encode()
    order = pc.sort_indices(coded.dictionary)
    rank = np.empty(len(order), np.int64)
    rank[order.to_numpy()] = np.arange(len(order))
    return rank[coded.indices.to_numpy()], coded.dictionary.take(order)


def merge(runs: list[Run]) -> Run:
    """One run with the sums of the counts. The keys of each run ascend, so the stable sort merges them."""
    prefix, prefixes = _ranked(pa.concat_arrays([r.prefixes for r in runs]))
    last, lasts = _ranked(pa.concat_arrays([r.lasts for r in runs]))
    key = np.repeat(prefix, np.concatenate([r.sizes for r in runs])) * len(lasts) + last
    order = np.argsort(key, kind="stable")
    key = key[order]
    starts = np.flatnonzero(np.diff(key, prepend=-1))
    owner, last = np.divmod(key[starts], len(lasts))
    return Run(prefixes, np.bincount(owner, minlength=len(prefixes)), lasts.take(pa.array(last)),
               np.add.reduceat(np.concatenate([r.counts for r in runs])[order], starts))


class Node:
    """Children over ascending ranges of keys, told apart by the first (depth 0) or second (depth 1)
    word: hash containers (key to count) or, below a single first word, a node."""

    def __init__(self, depth: int, low: int, first: dict[int, int]) -> None:
        self.lows, self.children, self.depth = np.array([low], np.int64), [first], depth

    def add(self, keys: np.ndarray, counts: np.ndarray) -> int:
        """Add sorted distinct keys; how many entries are new."""
        ends = [*np.searchsorted(keys, self.lows[1:]).tolist(), len(keys)]
        new, lo, full = 0, 0, []
        for n, hi in enumerate(ends):
            if hi > lo:
                child = self.children[n]
                if isinstance(child, Node):
                    new += child.add(keys[lo:hi], counts[lo:hi])
                else:
                    before = len(child)
                    for k, c in zip(keys[lo:hi].tolist(), counts[lo:hi].tolist(), strict=True):
                        child[k] = child.get(k, 0) + c
                    new += len(child) - before
                    if len(child) > CONTAINER:
                        full.append(n)
                lo = hi
        for n in reversed(full):
            self._burst(n)
        return new

    def _burst(self, n: int) -> None:
        """Split a container between two words until its parts are small enough; burst that of one word."""
        keys = np.array(sorted(self.children[n]), np.int64)
        word = keys >> np.int64(WORD_BITS * (2 - self.depth))
        borders, lo = [], 0
        while lo < len(keys):  # whole words, about half a container together
            borders.append(lo)
            lo = int(np.searchsorted(word, word[min(lo + CONTAINER // 2, len(keys)) - 1], "right"))
        parts, lows = [], []
        for lo, hi in zip(borders, [*borders[1:], len(keys)], strict=True):
            part = {k: self.children[n][k] for k in keys[lo:hi].tolist()}
            low = int(self.lows[n]) if lo == 0 else int(word[lo]) << WORD_BITS * (2 - self.depth)
            one_word = self.depth == 0 and hi - lo > CONTAINER and word[lo] == word[hi - 1]
            lows.append(low)
            parts.append(Node(1, low, part) if one_word else part)
        self.children[n:n + 1] = parts
        self.lows = np.concatenate([self.lows[:n], np.array(lows, np.int64), self.lows[n + 1:]])

    def subtrees(self) -> Iterator[dict[int, int]]:
        for child in self.children:
            if isinstance(child, Node):
                yield from child.subtrees()
            else:
                yield child


class Trie:
    """Counts of one language in one task."""

    def __init__(self) -> None:
        self.numbers: dict[str, int] = {}
        self.names, self.hashes = [""], [0]  # number 0: no word
        self.single = np.zeros(1024, np.int64)
        self.root, self.entries = Node(0, 0, {}), 0

    def _number(self, word: str) -> int:
        n = self.numbers[word] = len(self.names)
        self.names.append(word)
        self.hashes.append(zlib.crc32(word.encode()))
        return n

    def add(self, texts: list[str]) -> None:
        words, first = split_words(texts)
        if not len(words):
            return
        coded, known = words.dictionary_encode(), self.numbers
        here = np.array([known.get(w) or self._number(w) for w in coded.dictionary.to_pylist()], np.int64)
        indices = coded.indices.to_numpy()
        if len(self.names) > len(self.single):
            self.single = np.concatenate([self.single, np.zeros(len(self.names), np.int64)])
        self.single[here] += np.bincount(indices, minlength=len(here))
        w = np.concatenate([here[indices], [0, 0]])
        goes_on = np.concatenate([~first[1:], [False, False]])  # the next word is of the same piece
        second = np.where(goes_on[:-1], w[1:-1], 0)
        third = np.where(goes_on[:-1] & goes_on[1:], w[2:], 0)
        keys = (w[:-2] << 2 * WORD_BITS | second << WORD_BITS | third)[second > 0]
        keys, counts = np.unique(keys, return_counts=True)
        self.entries += self.root.add(keys, counts)

    def spill(self, parts: int, share: float) -> Iterator[tuple[int, int, Run]]:
        """Runs (words, part, run) of the subtrees whose entries recur least, ``share`` of the entries; of
        everything, the single words included, at 1."""
        trees = sorted(self.root.subtrees(), key=lambda t: sum(t.values()) / max(1, len(t)))
        keys, counts, left = [], [], share * self.entries
        for tree in trees:
            if left <= 0:
                break
            keys.append(np.fromiter(tree.keys(), np.int64, len(tree)))
            counts.append(np.fromiter(tree.values(), np.int64, len(tree)))
            left -= len(tree)
            self.entries -= len(tree)
            tree.clear()
        if keys:
            key, count = np.concatenate(keys), np.concatenate(counts)
            yield from self._runs(3, key >> 2 * WORD_BITS, key >> WORD_BITS & WORD_MASK, key & WORD_MASK, count, parts)
        if share >= 1:
            word = np.flatnonzero(self.single)
            none = np.zeros(len(word), np.int64)
            yield from self._runs(1, word, none, none, self.single[word], parts)

    def _runs(self, words: int, w1: np.ndarray, w2: np.ndarray, w3: np.ndarray, counts: np.ndarray, parts: int) -> Iterator[tuple[int, int, Run]]:
        if not len(w1):
            return
        hashes = np.array(self.hashes, np.uint64)
        mixed = (hashes[w1] * np.uint64(0x9E3779B97F4A7C15) + hashes[w2]) * np.uint64(0xC2B2AE3D27D4EB4F)
        part = ((mixed >> np.uint64(33)) % np.uint64(parts)).astype(np.int64)
        used = np.unique(np.concatenate([w1, w2, w3]))
        rank = np.zeros(len(self.names), np.int64)
        names = pa.array([self.names[i] for i in used.tolist()], pa.string())
        rank[used[pc.sort_indices(names).to_numpy()]] = np.arange(len(used))
        order = np.lexsort((rank[w1] << 2 * WORD_BITS | rank[w2] << WORD_BITS | rank[w3], part))
        w1, w2, w3, counts, part = w1[order], w2[order], w3[order], counts[order], part[order]
        head = np.flatnonzero(np.diff(w1, prepend=-1) | np.diff(w2, prepend=-1) | np.diff(part, prepend=-1))
        at = np.searchsorted(used, w1[head]), np.searchsorted(used, w2[head])
        prefixes = names.take(pa.array(at[0]))
        if words > 1:
            prefixes = pc.binary_join_element_wise(prefixes, names.take(pa.array(at[1])), " ")
        none = pa.nulls(1, pa.string()).fill_null("")
        lasts = names.take(pa.array(np.searchsorted(used, w3))) if words > 1 else none.take(pa.array(np.zeros(len(w3), np.int64)))
        sizes = np.diff(np.append(head, len(w1)))
        here, first = np.unique(part, return_index=True)
        for p, lo, hi in zip(here.tolist(), first.tolist(), [*first[1:].tolist(), len(part)], strict=True):
            a, b = np.searchsorted(head, (lo, hi)).tolist()
            yield words, p, Run(prefixes.slice(a, b - a), sizes[a:b], lasts.slice(lo, hi - lo), counts[lo:hi])


def _count(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    tries: dict[str, Trie] = {}

    def spilled(share: float) -> Iterator[pa.RecordBatch]:
        for lang, trie in tries.items():
            rows = [(lang, words, part, run.pack()) for words, part, run in trie.spill(parts, share)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (
                    pa.string(), pa.int32(), pa.int32(), pa.binary()), strict=True)], ["lang", "words", "part", "run"])

    for b in batches:
        by_lang: dict[str, list[str]] = {}
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist(), strict=True):
            by_lang.setdefault(lang, []).append(text)
        for lang, texts in by_lang.items():
            ends = np.cumsum([len(t) for t in texts]) // CHARS_AT_ONCE
            for n in np.unique(ends):
                tries.setdefault(lang, Trie()).add([texts[i] for i in np.flatnonzero(ends == n)])
                if sum(t.entries for t in tries.values()) > ENTRIES:
                    yield from spilled(0.5)
        if sum(len(t.names) for t in tries.values()) > WORDS:
            yield from spilled(1)
            tries.clear()
    yield from spilled(1)


def _merge(batches: Iterator[pa.RecordBatch], min_count: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by language, number of words and part; runs are folded into one as they come."""
    group, pending, size = None, [], 0

    def finished() -> Iterator[pa.RecordBatch]:
        (lang, words, _), run = group, merge(pending)
        found = []
        if words == 1:
            found = [(0, pa.array([""]), np.array([run.counts.sum()])), (1, run.prefixes, run.counts)]
        else:
            starts = np.concatenate([[0], np.cumsum(run.sizes)[:-1]])
            found = [(2, run.prefixes, np.add.reduceat(run.counts, starts))]
            often = np.flatnonzero((run.counts >= min_count) & (pc.binary_length(run.lasts).to_numpy() > 0))
            owner = np.repeat(np.arange(len(run.sizes)), run.sizes)[often]
            found.append((3, pc.binary_join_element_wise(run.prefixes.take(pa.array(owner)), run.lasts.take(pa.array(often)), " "), run.counts[often]))
        for n, phrases, counts in found:
            keep = np.flatnonzero((counts >= min_count) | (n == 0))
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keep), pa.string()), pa.array(np.full(len(keep), n, np.int32)),
                                              phrases.take(pa.array(keep)), pa.array(counts[keep], pa.int64())], ["lang", "words", "phrase", "f"])

    for b in batches:
        for key, packed in zip(zip(*[b.column(c).to_pylist() for c in ("lang", "words", "part")], strict=True),
                               b.column("run").to_pylist(), strict=True):
            if key != group:
                if group is not None:
                    yield from finished()
                group, pending, size = key, [], 0
            pending.append(Run.unpack(packed))
            size += len(pending[-1].counts)
            if size > MERGE_AT_ONCE + 2 * len(pending[0].counts):
                pending, size = [merge(pending)], 0
                size = len(pending[0].counts)
    if group is not None:
        yield from finished()


def phrase_counts(docs: DataFrame, *, min_count: int = 10, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang, words, phrase, f``: occurrences of every phrase of one to three words that occurs ``min_count``
    times or more in its language (null: ``und``), a written table; rows with ``words`` 0 add up to the language's words.

    A part's phrases share their first two words' hash; what is held of it at once is its distinct phrases.
    """
    text_batches(docs.sparkSession)
    src = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text")).where("text <> ''")
    n_bytes = src.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    parts = min(max(MIN_PARTS, n_bytes // PART_BYTES), (1 << 31) - 1)
    runs = src.mapInArrow(lambda batches: _count(batches, parts), "lang string, words int, part int, run binary")
    dealt = runs.repartition("lang", "words", "part").sortWithinPartitions("lang", "words", "part")
    return materialise(dealt.mapInArrow(lambda batches: _merge(batches, min_count), "lang string, words int, phrase string, f long"), "phrases")


def collocations(counted: DataFrame, *, min_count: int = 10, covered: int = 50) -> DataFrame:
    """``lang, phrase, words, a, l, r, score`` of the phrases of two and three words that no longer one covers.

    l and r are the counts of the two parts of the lowest-scoring cut (of equal ones the shortest first part),
    score = floor(1000000 a a / (l r)). A pair goes if a triple that holds it occurs at least ``covered``
    percent as often. Counts up to 10^15 are exact.
    """
    words = F.split("phrase", " ")
    found = counted.where((F.col("words") >= 2) & (F.col("f") >= min_count)).select("lang", "phrase", "words", F.col("f").alias("a"))
    inside = found.where("words = 3").select("lang", "a", F.explode(F.array_distinct(F.array(
        F.concat_ws(" ", F.slice(words, 1, 2)), F.concat_ws(" ", F.slice(words, 2, 2))))).alias("phrase"))
    longer = inside.groupBy("lang", "phrase").agg(F.max("a").alias("longest"))
    left = found.join(longer, ["lang", "phrase"], "left").where(
        F.col("longest").isNull() | (F.lit(100) * F.col("longest") < F.lit(covered) * F.col("a"))).drop("longest")
    cut = F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    cuts = left.select("lang", "phrase", "words", "a", cut).select(
        "lang", "phrase", "words", "a", "k", F.concat_ws(" ", F.slice(words, 1, F.col("k"))).alias("head"),
        F.concat_ws(" ", F.slice(words, F.col("k") + 1, F.col("words") - F.col("k"))).alias("tail"))
    part = counted.where("words > 0")
    cuts = (cuts.join(part.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
            .join(part.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r")), ["lang", "tail"]))
    a, ln, rn = (F.col(c).cast("decimal(15,0)") for c in ("a", "l", "r"))
    scored = cuts.withColumn("square", a * a * F.lit(1_000_000).cast("decimal(7,0)")).withColumn("product", ln * rn)
    best = scored.withColumn("score", F.expr("square div product")).groupBy("lang", "phrase", "words", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("best"))
    return best.select("lang", "phrase", "words", "a", "best.l", "best.r", "best.score")


def top_collocations(docs: DataFrame, *, top: int = 2000, min_count: int = 10, covered: int = 50, text_col: str = "text",
                     lang_col: str = "lang") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``top`` phrases by score, then count, then bytes.

    Null and empty texts have no words; repeated rows count again; an empty table gives no rows.
    """
    counted = phrase_counts(docs, min_count=min_count, text_col=text_col, lang_col=lang_col)
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    found = collocations(counted, min_count=min_count, covered=covered).withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(SHARES)))
    # a language's head is that of the heads of its shares, so no task ranks all of a language
    heads = found.withColumn("n", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).where(F.col("n") <= top).drop("n", "share")
    ranked = heads.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    n = counted.where("words = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    return ranked.join(n, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
