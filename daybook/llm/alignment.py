"""Alignment of two tokenizers' tokens by galloping intersection of their byte offsets.

Each text is encoded by a byte-level BPE (A) and by a SentencePiece model (B). The byte offsets where
their tokens end are two ascending lists: the shorter one drives an exponential, then binary search into
the longer. Offsets in both cut the tokens into groups; the differences of the ranks in each list are
the group's ranges of tokens, and its last two tokens are linked.

A blank that stands alone before a visible character begins a token of either tokenizer, whatever is
around it, and so does a line feed between visible characters. Texts are therefore cut there, each distinct
segment is encoded and intersected once by a worker, and a text's alignment is that of its segments in order.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.shared import text_batches

BYTE_FILE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_FILE = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Where a segment begins: at a blank after anything but a blank and before a visible character, at a line
#: feed between visible characters.
CUT = re.compile(r"(?<=[^ ])(?= [^\s])|(?<=[^\s])(?=\n[^\s])")
#: A text whose every blank and line feed is such a place.
UNEVEN = re.compile(r"\s\s|[^\S \n]|\A\s|\s\Z")
#: Segments that are encoded alone: with white space or a blank's piece after their beginning.
ALONE = re.compile(rf"\A |.\s|{MARK}", re.DOTALL)
KNOWN_SEGMENTS = 200_000  # in each of the two generations that a worker remembers
KNOWN_LENGTH = 200  # of a remembered segment


def gallop(short: np.ndarray, long: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each ``short[i]`` the first place in ``long[low[i]:high[i]]`` (ascending) that isn't below it, else
    ``high[i]``. All advance together: from ``low`` on the steps double until they reach the value, then the last
    step is searched by halves."""
    low, high = low.copy(), high.copy()
    live, step = np.flatnonzero(low < high), 1
    while len(live):
        at = np.minimum(low[live] + step, high[live]) - 1
        below = long[at] < short[live]
        high[live[~below]] = at[~below]
        live, at = live[below], at[below]
        low[live] = at + 1
        live, step = live[low[live] < high[live]], step * 2
    live = np.flatnonzero(low < high)
    while len(live):
        middle = (low[live] + high[live]) // 2
        below = long[middle] < short[live]
        low[live[below]], high[live[~below]] = middle[below] + 1, middle[~below]
        live = live[low[live] < high[live]]
    return low


def intersect(a: np.ndarray, a_sizes: np.ndarray, b: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and ``b`` of the values common to their lists n, for all n. Both hold their lists one
    after the other, ascending strictly; of each two the shorter drives the search in the longer."""
    ends = np.cumsum(a_sizes), np.cumsum(b_sizes)
    owner = np.repeat(np.arange(len(a_sizes)), a_sizes), np.repeat(np.arange(len(b_sizes)), b_sizes)
    sizes, values, found = (a_sizes, b_sizes), (a, b), []
    for short, drives in ((0, a_sizes <= b_sizes), (1, a_sizes > b_sizes)):
        long = 1 - short
        driver = np.flatnonzero(drives[owner[short]])
        n = owner[short][driver]
        at = gallop(values[short][driver], values[long], (ends[long] - sizes[long])[n], ends[long][n])
        hit = np.flatnonzero(at < ends[long][n])
        hit = hit[values[long][at[hit]] == values[short][driver[hit]]]
        found.append((driver[hit], at[hit]) if short == 0 else (at[hit], driver[hit]))
    i, j = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(i, kind="stable")
    return i[order], j[order]


#: A segment's numbers of A and B tokens and of groups, the groups as text, the links as 64-bit integers (A id
#: above B id).
Aligned = tuple[int, int, int, str, bytes]


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 stands for
    itself, the rest is numbered from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Aligner:
    """Two tokenizers and the segments met. Sent to the executors once, as the files' content; a worker
    builds the tokenizers on first use and keeps them and the segments from task to task."""

    def __init__(self, byte_file: str = BYTE_FILE, piece_file: str = PIECE_FILE) -> None:
        with open(byte_file, encoding="utf-8") as f:
            self.byte_model = f.read()
        with open(piece_file, "rb") as f:
            self.piece_model = f.read()
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, Aligned] = {}
        self.older: dict[str, Aligned] = {}
        self.unspelled: set[str] = set()  # segments that either tokenizer doesn't spell exactly
        self.a = self.b = None

    def __getstate__(self) -> dict:
        return {"byte_model": self.byte_model, "piece_model": self.piece_model}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._forget()

    def _build(self) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(self.byte_model)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_proto=self.piece_model)
        alphabet = byte_alphabet()
        special = {i for i, t in self.a.get_added_tokens_decoder().items() if t.special}
        vocabulary = {i: t for t, i in self.a.get_vocab().items() if i not in special}
        self.a_bytes = [bytes([alphabet[c] for c in vocabulary[i]]) if i in vocabulary else b"" for i in range(max(vocabulary) + 1)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        self.a_lengths, self.b_lengths = (np.array([len(t) for t in x]) for x in (self.a_bytes, self.b_bytes))
        self.a_spelling, self.b_spelling = (pa.array(x, pa.binary()) for x in (self.a_bytes, self.b_bytes))
        self.a_names, self.b_names = (pa.array([str(i) for i in range(len(x))]) for x in (self.a_bytes, self.b_bytes))
        normal = [p for i, p in enumerate(pieces) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))]
        if any(MARK in p.lstrip(MARK) or "\n" in p for p in normal) or self.b.encode("\n", out_type=str)[:1] != [MARK]:
            raise ValueError("a piece crosses the places where texts are cut")

    def _learn(self, segments: list[str]) -> None:
        """Align new segments: those that stand for themselves in one text, the others one by one."""
        together, alone = [], []
        for s in segments:
            (alone if ALONE.search(s) else together).append(s)
        if together:
            text = " x" + "".join([s if s[0] == "\n" else " " + s for s in together])
            a, b = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.b.encode(text[1:])
            if not self._align(["x", *together], a, b):
                alone = segments
        for s in alone:
            text = s if s[0] in " \n" else " " + s
            a = self.a.encode(text, add_special_tokens=False).ids
            # B adds a blank of its own; before a line feed it is a token, which isn't the segment's
            b = self.b.encode(text[1:]) if text[0] == " " else self.b.encode(text)[1:]
            if not self._align([s], a, b):
                self.unspelled.add(s)
                self.known[s] = (0, 0, 0, "", b"")

    def _align(self, segments: list[str], ids_a: list[int], ids_b: list[int]) -> bool:
        """Align the tokens of segments that follow one another; False if either's bytes are not theirs."""
        whole = "".join([s if s[0] in " \n" else " " + s for s in segments]).encode()
        a, b = np.array(ids_a, np.int64), np.array(ids_b, np.int64)
        for ids, spelling in ((a, self.a_spelling), (b, self.b_spelling)):
            spelled = spelling.take(pa.array(ids)).buffers()[2]
            if not spelled or spelled.to_pybytes() != whole:
                return False
        sizes = pc.binary_length(pa.array(segments)).to_numpy() + np.array([s[0] not in " \n" for s in segments])
        borders, a_ends, b_ends = np.cumsum(sizes), np.cumsum(self.a_lengths[a]), np.cumsum(self.b_lengths[b])
        cuts = [np.searchsorted(ends, borders) for ends in (a_ends, b_ends)]
        if any((ends[cut] != borders).any() for ends, cut in zip((a_ends, b_ends), cuts, strict=True)):
            return False  # a token crosses a border
        a_sizes, b_sizes = (np.diff(cut, prepend=-1) for cut in cuts)
        i, j = intersect(a_ends, a_sizes, b_ends, b_sizes)
        n_groups = np.diff(np.searchsorted(i, np.concatenate([[0], np.cumsum(a_sizes)])))
        groups = _joined([_joined([names.take(pa.array(ids))], np.diff(at, prepend=-1), ",")
                          for names, ids, at in ((self.a_names, a, i), (self.b_names, b, j))], n_groups, ";").to_pylist()
        links = (a[i] << 32 | b[j]).tobytes()
        ends = (8 * np.cumsum(np.concatenate([[0], n_groups]))).tolist()
        self.known.update(zip(segments, zip(a_sizes.tolist(), b_sizes.tolist(), n_groups.tolist(), groups,
                                            [links[x:y] for x, y in zip(ends[:-1], ends[1:], strict=True)], strict=True), strict=True))
        return True

    def texts(self, texts: list[str | None]) -> list[list[Aligned] | None]:
        """The aligned segments of each text; None where it has no tokens. A segment is named by what
        follows its blank, or by all of it where that wouldn't be clear."""
        if self.a is None:
            self._build()
        split = []
        for t in texts:
            if not t:
                split.append([])
            elif UNEVEN.search(t):
                split.append([s[1:] if s[0] == " " and s[1] not in " \n" else s for s in CUT.split(" " + t)])
            else:
                split.append(t.replace("\n", " \n").split(" "))
        new = set().union(*split).difference(self.known)
        again = new.intersection(self.older)
        self.known.update((s, self.older[s]) for s in again)
        if new := sorted(new - again):
            self._learn(new)
        known, bad = self.known, self.unspelled
        out = [[known[s] for s in segments] if segments and bad.isdisjoint(segments) else None for segments in split]
        for s in [s for s in new if len(s) > KNOWN_LENGTH]:
            del known[s]
        if len(known) > KNOWN_SEGMENTS:
            self.known, self.older = {}, known
        if len(bad) > KNOWN_SEGMENTS:
            self._forget()
        return out


def _joined(parts: list[pa.Array], sizes: np.ndarray, separator: str) -> pa.Array:
    """Texts of ``sizes`` consecutive strings each; those are ``parts`` side by side, with a bar between."""
    strings = parts[0] if len(parts) == 1 else pc.binary_join_element_wise(*parts, "|")
    ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(ends, strings), separator)


SCHEMA = "n_a long, n_b long, n_groups long, n_links long, groups string, links array<struct<a: int, b: int, times: int>>"


def align(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", byte_file: str = BYTE_FILE,
          piece_file: str = PIECE_FILE) -> DataFrame:
    """``row, id, n_a, n_b, n_groups, n_links, groups, links`` of every record.

    Both encode a blank and the text; strings of special tokens in it are plain text. groups:
    ``a1,a2|b1;a3|b2,b3``. links: the pairs of tokens that end at one byte, with how often the text holds
    each. Null and empty texts, and those that either tokenizer doesn't spell exactly (U+2581 is a blank
    to B), have no tokens: zeros, empty groups and links. ``row`` numbers the records, as ids may be null or
    repeated: write the result before it is read twice. The files are read by the driver and sent as they are.
    """
    text_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(Aligner(byte_file, piece_file))  # a vocabulary: bounded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = sent.value
        for b in batches:
            for lo in range(0, b.num_rows, 128):
                part = b.slice(lo, 128)
                yield _records(part, aligner.texts(part.column("text").to_pylist()))

    src = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return src.mapInArrow(run, f"row long, id {src.schema['id'].dataType.simpleString()}, {SCHEMA}")


def _records(part: pa.RecordBatch, aligned: list[list[Aligned] | None]) -> pa.RecordBatch:
    n_a, n_b, n_groups, groups, ids, times = [], [], [], [], [], []
    for parts in aligned:
        a, b, n, text, links = zip(*parts, strict=True) if parts else ((),) * 5
        n_a.append(sum(a))
        n_b.append(sum(b))
        n_groups.append(sum(n))
        groups.append(";".join(text))
        pairs, count = np.unique(np.frombuffer(b"".join(links), np.int64), return_counts=True)
        ids.append(pairs)
        times.append(count)
    flat, ends = np.concatenate(ids), np.cumsum([0, *map(len, ids)])
    links = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
        [pa.array((flat >> 32).astype(np.int32)), pa.array((flat & 0xFFFFFFFF).astype(np.int32)),
         pa.array(np.concatenate(times).astype(np.int32))], ["a", "b", "times"]))
    numbers = [pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups, [int(t.sum()) for t in times])]
    return pa.RecordBatch.from_arrays([part.column("row"), part.column("id"), *numbers, pa.array(groups, pa.string()), links],
                                      ["row", "id", "n_a", "n_b", "n_groups", "n_links", "groups", "links"])


def link_counts(aligned: DataFrame) -> DataFrame:
    """``a, b, count, best`` of every pair of ids linked anywhere; best: no other A id is linked with this
    B id more often.

    One of two linked tokens ends with the other, so there are at most as many pairs as both
    vocabularies have bytes (some 600,000 for the public ones), however many texts there are.
    """
    counted = aligned.select(F.explode("links").alias("l")).groupBy("l.a", "l.b").agg(F.sum("l.times").alias("count"))
    return counted.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy("b")))


def score(aligned: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """The records of ``aligned`` (read twice, so give a written table) with ``n_best`` (links that are the
    best of their B id) and ``count_sum`` (the counts of all links) in place of ``links``."""
    counts = link_counts(aligned) if counts is None else counts
    links = aligned.select("row", F.explode("links").alias("l")).select("row", "l.*")
    sums = (links.join(F.broadcast(counts), ["a", "b"])  # bounded by the vocabularies, see link_counts
            .groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).cast("long").alias("n_best"),
                                F.sum(F.col("times") * F.col("count")).cast("long").alias("count_sum")))
    return aligned.drop("links").join(sums, "row", "left").fillna(0, ["n_best", "count_sum"])
