"""SentencePiece encoding and decoding by a batched numpy Viterbi.

The vocabulary and its scores come from a SentencePiece model file. The text's segments (a run of
word marks and what follows up to the next one) are encoded once per distinct segment: segments of equal length
form one matrix of code points, whose rows advance together from left to right. At every position
the hashes of all substrings that end there probe the sorted keys of the pieces, and the maximum over
the starts is stored with its piece as a backpointer. The few segments of more than ``LONE_LENGTH`` characters have no
others of their length: they advance one by one, in time proportional to their length.

In a unigram model a path's score is the sum of its pieces' scores. In a BPE model the scores only
order the merges, so the sum means nothing; there a path scores 0 if merging in that order leads to it and
minus infinity if not. That is decided pair by pair: a sequence is what BPE makes of its text exactly
if each pair of neighbours is what BPE makes of theirs. Both give SentencePiece's own ids.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.shared import text_batches

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"  # stands for a space in pieces
#: A mark in the text itself, which must not become a space. Lone surrogates do not occur in texts.
TEXT_MARK = "\ud800"
UNKNOWN_PENALTY = 10.0
BASE = np.uint64(0x9E3779B97F4A7C15)
FILTER_BITS = 20
CELLS_AT_ONCE = 1 << 15
KNOWN_SEGMENTS = 150_000  # remembered by a worker
KNOWN_LENGTH = 200  # of a remembered segment
KNOWN_PAIRS = 100_000
PAIR_BITS = 20
LONE_LENGTH = 40
CHARS_AT_ONCE = 3_000_000


@dataclass
class Merges:
    """Per piece of a BPE model: when it is merged (0: a character), of which two pieces, and whether
    BPE makes it of its own text at all."""

    rank: np.ndarray
    left: np.ndarray
    right: np.ndarray
    reachable: np.ndarray

    @staticmethod
    def of(texts: list[str], scores: np.ndarray) -> Merges:
        at = {t: i for i, t in enumerate(texts)}
        order = {s: r for r, s in enumerate(sorted({s for t, s in zip(texts, scores, strict=True) if len(t) > 1}, reverse=True), 1)}
        rank = np.array([order[s] if len(t) > 1 else 0 for t, s in zip(texts, scores, strict=True)])
        left, right, reachable = (np.full(len(texts), -1), np.full(len(texts), -1), np.ones(len(texts), bool))
        for i, t in enumerate(texts):
            parts = list(t)
            while len(parts) > 1:
                joins = [(rank[j], n) for n in range(len(parts) - 1) if (j := at.get(parts[n] + parts[n + 1])) is not None]
                if not joins:
                    reachable[i] = False
                    break
                n = min(joins)[1]  # the earliest merge, the leftmost of equal ones
                if len(parts) == 2:
                    if parts[0] not in at or parts[1] not in at:
                        raise ValueError(f"piece {t!r} is merged of characters that are no pieces")
                    left[i], right[i] = at[parts[0]], at[parts[1]]
                parts[n:n + 2] = [parts[n] + parts[n + 1]]
        return Merges(rank, left, right, reachable)


def model_type(path: str) -> int:
    """1 unigram, 2 BPE: field 3 of the trainer settings, field 2 of the file (protocol buffer)."""

    def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
        at = 0

        def number() -> int:
            nonlocal at
            value = shift = 0
            while True:
                value, shift, at = value | (data[at] & 127) << shift, shift + 7, at + 1
                if data[at - 1] < 128:
                    return value

        while at < len(data):
            tag = number()
            if tag & 7 == 0:
                yield tag >> 3, number()
            else:
                size = {1: 8, 5: 4}.get(tag & 7) or number()
                yield tag >> 3, data[at:at + size]
                at += size

    with open(path, "rb") as f:
        trainer = next((v for k, v in fields(f.read()) if k == 2), b"")
    return next((v for k, v in fields(trainer) if k == 3), 1)


@dataclass
class Pieces:
    """A vocabulary as arrays: sorted hashes of the pieces, their ids, scores and code points."""

    keys: np.ndarray
    ids: np.ndarray
    scores: np.ndarray
    codes: np.ndarray
    lengths: np.ndarray
    unknown_score: float
    unknown_id: int
    byte_ids: list[int]  # empty without byte fallback
    out_bytes: list[bytes]  # what each id decodes to
    dummy_prefix: bool
    pattern: str
    filter: np.ndarray  # which leading bits the keys have: most substrings are no pieces
    merges: Merges | None  # of a BPE model
    power: np.ndarray  # of the hashes' base
    texts: list[str]  # of the pieces, by key
    places: dict[str, int]  # of the texts
    known: dict[str, bytes] = field(default_factory=dict)  # ids of the segments met, as 32-bit integers
    asked: np.ndarray | None = None  # pairs of pieces met, by slot, and whether BPE leaves them apart
    answered: np.ndarray | None = None
    spelling: pa.Array | None = None  # out_bytes, for gathering
    parted: dict[int, bool] = field(default_factory=dict)  # the same for lone words

    @staticmethod
    def load(path: str = MODEL_FILE) -> Pieces:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        if sp.encode("a  bａ", out_type=str) != sp.encode("a", out_type=str) + sp.encode("a  bａ", out_type=str)[1:] \
                or sp.decode(sp.encode("a  bａ")) != "a  bａ":
            raise ValueError("models that normalise their text are not supported: decoding could not be exact")
        n = sp.get_piece_size()
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i) for i in range(n)]
        text = {sp.id_to_piece(i): i for i in range(n) if not special[i]}
        length = np.array([len(p) for p in text])
        codes = np.zeros((len(text), length.max()), np.int64)
        for row, p in enumerate(text):
            codes[row, :len(p)] = [ord(c) for c in p]
        key = np.zeros(len(text), np.uint64)
        for row, p in enumerate(text):
            key[row] = _hashes(codes[row:row + 1, :len(p)])[0, -1]
        order = np.argsort(key)
        if (np.diff(key[order]) == 0).any():
            raise ValueError("two pieces share a hash")
        ids = np.array(list(text.values()))[order]
        scores = np.array([sp.get_score(int(i)) for i in ids], np.float64)
        byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        byte_ids = byte_ids if all(sp.is_byte(i) for i in byte_ids) else []
        out = [b"" if special[i] else sp.id_to_piece(i).replace(MARK, " ").encode() for i in range(n)]
        out[sp.unk_id()] = " ⁇ ".encode()
        for b, i in enumerate(byte_ids):
            out[i] = bytes([b])
        # no piece may cross the places where a text is cut into segments
        pattern = "[^\n]+|\n" if any(MARK in p.lstrip(MARK) for p in text) else f"\n|{MARK}*[^{MARK}\n]+|{MARK}+"
        if any("\n" in p for p in text):
            pattern = "(?s).+"
        kind = model_type(path)
        if kind not in (1, 2):
            raise ValueError("only unigram and BPE models have scored pieces")
        by_row = list(text)
        by_key = [by_row[i] for i in order]
        merges = Merges.of(by_key, scores) if kind == 2 else None
        leading = np.zeros(1 << FILTER_BITS, bool)
        leading[key >> np.uint64(64 - FILTER_BITS)] = True
        return Pieces(key[order], ids, scores, codes[order], length[order], float(scores.min()) - UNKNOWN_PENALTY, sp.unk_id(),
                      byte_ids, out, sp.encode("a", out_type=str) == [MARK + "a"], pattern,
                      leading, merges,
                      np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(int(length.max()), BASE)]), dtype=np.uint64),
                      by_key, {t: i for i, t in enumerate(by_key)})

    def encode(self, texts: list[str | None]) -> list[list[int] | None]:
        """The ids of each text (null: null, empty: none)."""
        return [None if t is None else np.frombuffer(raw, np.int32).tolist() for t, raw in zip(texts, self.encode_raw(texts), strict=True)]

    def encode_raw(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as 32-bit integers in one string of bytes (null: none)."""
        find = re.compile(self.pattern).findall
        split = []
        for t in texts:
            s = (t.replace(MARK, TEXT_MARK).replace(" ", MARK) if t else "")
            split.append(find(MARK + s if s and self.dummy_prefix else s))
        if len(self.known) > KNOWN_SEGMENTS:
            self.known.clear()
        known = self.known
        new = set().union(*split).difference(known)
        self._learn(new)
        out = [b"".join([known[seg] for seg in segs]) for segs in split]
        for seg in [seg for seg in new if len(seg) > KNOWN_LENGTH]:
            del known[seg]
        return out

    def _learn(self, segments: set[str]) -> None:
        by_length: dict[int, list[str]] = {}
        for s in segments:
            by_length.setdefault(len(s), []).append(s)
        for n, words in by_length.items():
            if n > LONE_LENGTH:
                self.known.update((w, self._alone(w)) for w in words)
                continue
            step = max(1, CELLS_AT_ONCE // n)
            for lo in range(0, len(words), step):
                part = words[lo:lo + step]
                codes = np.frombuffer("".join(part).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(part), n)
                encoded = self._viterbi(codes.astype(np.int64))
                self.known.update(zip(part, encoded if encoded is not None else map(self._alone, part), strict=True))

    def _alone(self, word: str) -> bytes:
        """The same of a single word, which nothing advances with; no hashes."""
        places, longest, n = self.places, self.codes.shape[1], len(word)
        back, last = list(range(-1, n)), [-1] * (n + 1)
        if self.merges:
            known, size = self.parted, len(self.texts)
            for end in range(1, n + 1):
                for start in range(max(0, end - longest), end):
                    piece = places.get(word[start:end], -1)
                    if piece < 0 or not self.merges.reachable[piece]:
                        continue
                    before = last[start]
                    if before >= 0:
                        pair = before * size + piece
                        apart = known.get(pair)
                        if apart is None:
                            if len(known) > KNOWN_PAIRS:
                                known.clear()
                            apart = known[pair] = self._leaves_apart(before, piece)
                        if not apart:
                            continue
                    back[end], last[end] = start, piece
                    break
        else:
            best = [0.0] * (n + 1)
            for end in range(1, n + 1):
                best[end] = best[end - 1] + self.unknown_score
                for start in range(max(0, end - longest), end):  # of equal sums the longest last piece wins
                    piece = places.get(word[start:end], -1)
                    if piece >= 0 and (total := best[start] + self.scores[piece]) > best[end]:
                        best[end], back[end], last[end] = total, start, piece
        out, end = [], n
        while end:
            out += (int(self.ids[last[end]]),) if last[end] >= 0 else self._unknown(ord(word[end - 1]))[::-1]
            end = back[end]
        return np.array(out[::-1], np.int32).tobytes()

    def _leaves_apart(self, a: int, b: int) -> bool:
        """``_compatible`` of one pair."""
        rank, limit = self.merges.rank, np.iinfo(np.int64).max
        while True:
            joined = self.places.get(self.texts[a] + self.texts[b], -1)
            if joined >= 0 and rank[joined] < limit:
                return False
            if not rank[a] and not rank[b]:
                return True
            if rank[a] > rank[b]:
                limit, a = rank[a], int(self.merges.right[a])
            else:
                limit, b = rank[b] + 1, int(self.merges.left[b])

    def _probe(self, found: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Flat places of the hashes that are a piece's of this length, and the pieces."""
        flat = found.ravel()
        maybe = np.nonzero(self.filter[flat >> np.uint64(64 - FILTER_BITS)])[0]
        at = np.minimum(np.searchsorted(self.keys, flat[maybe]), len(self.keys) - 1)
        hit = (self.keys[at] == flat[maybe]) & (self.lengths[at] == length)
        return maybe[hit], at[hit]

    def _viterbi(self, codes: np.ndarray) -> list[bytes] | None:
        """Ids of the words (rows); None if a text shares the hash of another piece on its way."""
        words, n = codes.shape
        longest = min(n, self.codes.shape[1])
        upto = np.concatenate([np.zeros((words, 1), np.uint64), _hashes(codes)], axis=1)
        power = self.power
        back = (self._by_merges if self.merges else self._by_scores)(words, n, longest, upto, power)
        # all words walk back together; the pieces on their ways are checked character by character
        owners, ids, chars = [], [], []
        alive, end = np.arange(words), np.full(words, n)
        column = np.arange(longest)
        while len(alive):
            start = back[alive, end]
            size = end - start
            found = upto[alive, end] - upto[alive, start] * power[size]
            at = np.minimum(np.searchsorted(self.keys, found), len(self.keys) - 1)
            piece = (self.keys[at] == found) & (self.lengths[at] == size)
            text = codes[alive[:, None], np.minimum(start[:, None] + column, n - 1)]
            if (piece[:, None] & (column < size[:, None]) & (text != self.codes[at, :longest])).any():
                return None  # a winning false hit cannot pass
            owners.append(alive)
            ids.append(np.where(piece, self.ids[at], -1))
            chars.append(text[:, 0])
            alive, end = alive[start > 0], start[start > 0]
        # from the last step to the first, word by word
        owner, flat, char = np.concatenate(owners[::-1]), np.concatenate(ids[::-1]), np.concatenate(chars[::-1])
        order = np.argsort(owner, kind="stable")
        owner, flat, char = owner[order], flat[order], char[order]
        strange = np.nonzero(flat < 0)[0]
        if len(strange):
            spelled = [self._unknown(int(c)) for c in char[strange]]
            flat = np.delete(np.insert(flat, np.repeat(strange, [len(x) for x in spelled]), [i for x in spelled for i in x]),
                             strange + np.cumsum([len(x) for x in spelled]))
            owner = np.delete(np.insert(owner, np.repeat(strange, [len(x) for x in spelled]), np.repeat(owner[strange], [len(x) for x in spelled])),
                              strange + np.cumsum([len(x) for x in spelled]))
        raw = flat.astype(np.int32).tobytes()
        ends = (np.searchsorted(owner, np.arange(words + 1)) * 4).tolist()
        return [raw[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def _by_scores(self, words: int, n: int, longest: int, upto: np.ndarray, power: np.ndarray) -> np.ndarray:
        """Start of the last piece of the best path to each end, by the sum of scores."""
        # score[w, end, k]: of the piece from end - longest + k to end
        score = np.full((words, n + 1, longest), -np.inf)
        score[:, :, longest - 1] = self.unknown_score
        for size in range(1, longest + 1):
            place, at = self._probe(upto[:, size:] - upto[:, :-size] * power[size], size)
            w, start = np.divmod(place, n + 1 - size)
            score[w, start + size, longest - size] = self.scores[at]
        best = np.full((words, longest + n + 1), -np.inf)
        best[:, longest] = 0
        back = np.zeros((words, n + 1), np.int64)
        row = np.arange(words)
        for end in range(1, n + 1):
            total = best[:, end:end + longest] + score[:, end]
            take = total.argmax(1)  # of equal sums the longest last piece wins
            best[:, longest + end] = total[row, take]
            back[:, end] = end - longest + take
        return back

    def _by_merges(self, words: int, n: int, longest: int, upto: np.ndarray, power: np.ndarray) -> np.ndarray:
        """The same where a path counts only if every two neighbours are what BPE makes of their text.
        One path to each end does, so the maximum is its only start; an unknown character is a piece
        that never merges."""
        piece = np.full((n + 1, words, longest), -1, np.int32)
        for size in range(1, longest + 1):
            place, at = self._probe(upto[:, size:] - upto[:, :-size] * power[size], size)
            w, start = np.divmod(place, n + 1 - size)
            piece[start + size, w, longest - size] = np.where(self.merges.reachable[at], at, -1)
        last = np.full((words, n + 1), -1, np.int64)  # last piece of the path; -1: none or unknown
        back = np.zeros((words, n + 1), np.int64)
        row = np.arange(words)
        for end in range(1, n + 1):
            w, k = np.nonzero(piece[end] >= 0)
            start, p = end - longest + k, piece[end, w, k].astype(np.int64)
            before = last[w, start]
            fits = before < 0
            ask = np.nonzero(~fits)[0]
            fits[ask] = self._apart(before[ask], p[ask])
            possible = np.full((words, longest), -np.inf)
            possible[:, longest - 1] = -1.0  # an unknown character, if nothing else leads here
            possible[w[fits], k[fits]] = 0.0
            take = possible.argmax(1)
            back[:, end] = end - longest + take
            last[:, end] = np.where(possible[row, take] == 0, piece[end, row, take], -1)
        return back

    def _apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``_compatible`` with a memory: the last pair that fell into each of 2^PAIR_BITS slots."""
        if self.asked is None:
            self.asked, self.answered = np.full(1 << PAIR_BITS, -1, np.int64), np.zeros(1 << PAIR_BITS, bool)
        pair = a * len(self.keys) + b
        slot = (pair.astype(np.uint64) * BASE) >> np.uint64(64 - PAIR_BITS)
        out = self.answered[slot]
        new = np.nonzero(self.asked[slot] != pair)[0]
        if len(new):
            pairs, first, inverse = np.unique(pair[new], return_index=True, return_inverse=True)
            answer = self._compatible(a[new[first]], b[new[first]])
            out[new] = answer[inverse]
            where = slot[new[first]]
            self.asked[where], self.answered[where] = pairs, answer
        return out

    def _compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether BPE leaves the pieces ``a`` and ``b`` apart in their joined text.

        Both are taken apart, the later merge first. A merge across the border that is due before the
        merge just undone would have come first. Of equal merges the left one comes first.
        """
        rank, left, right = self.merges.rank, self.merges.left, self.merges.right
        apart = np.ones(len(a), bool)
        live, limit = np.arange(len(a)), np.full(len(a), np.iinfo(np.int64).max)
        longest = self.codes.shape[1]
        while len(live):
            size = self.lengths[a] + self.lengths[b]
            short = size <= longest
            joined = self.keys[a] * self.power[np.minimum(self.lengths[b], longest)] + self.keys[b]
            at, found = np.zeros(len(a), np.int64), np.zeros(len(a), bool)
            maybe = np.nonzero(short & self.filter[joined >> np.uint64(64 - FILTER_BITS)])[0]
            at[maybe] = np.minimum(np.searchsorted(self.keys, joined[maybe]), len(self.keys) - 1)
            found[maybe] = (self.keys[at[maybe]] == joined[maybe]) & (self.lengths[at[maybe]] == size[maybe])
            crossed = found & (rank[at] < limit)
            apart[live[crossed]] = False
            ra, rb = rank[a], rank[b]
            go = ~crossed & ((ra > 0) | (rb > 0))
            live, a, b, ra, rb = live[go], a[go], b[go], ra[go], rb[go]
            undo_a = ra > rb
            limit = np.where(undo_a, ra, rb + 1)
            a, b = np.where(undo_a, right[a], a), np.where(undo_a, b, left[b])
        return apart

    def _unknown(self, code: int) -> tuple[int, ...]:
        char = MARK if chr(code) == TEXT_MARK else chr(code)
        return tuple(self.byte_ids[b] for b in char.encode()) if self.byte_ids else (self.unknown_id,)

    def decode(self, ids: list[int]) -> str:
        raw = b"".join([self.out_bytes[i] for i in ids])
        return raw[self.dummy_prefix and raw.startswith(b" "):].decode("utf-8", "replace")

    def decode_raw(self, raw: list[bytes]) -> list[bytes]:
        """The bytes that each text's ids (as ``encode_raw`` gives them) stand for, all gathered at once."""
        ids = np.frombuffer(b"".join(raw), np.int32)
        if self.spelling is None:
            self.spelling = pa.array(self.out_bytes, pa.binary())
        spelled = self.spelling.take(pa.array(ids))
        ends = np.frombuffer(spelled.buffers()[1], np.int32)[np.cumsum([0, *map(len, raw)]) // 4].tolist()
        data = spelled.buffers()[2].to_pybytes() if len(ids) else b""
        return [data[a + (self.dummy_prefix and data[a:a + 1] == b" " and a < z):z] for a, z in zip(ends[:-1], ends[1:], strict=True)]


def _hashes(codes: np.ndarray) -> np.ndarray:
    """Polynomial hashes (modulo 2^64) of every prefix of every row."""
    out = np.zeros(codes.shape, np.uint64)
    h = np.zeros(len(codes), np.uint64)
    for i in range(codes.shape[1]):
        h = h * BASE + codes[:, i].astype(np.uint64) + np.uint64(1)
        out[:, i] = h
    return out


def encode(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", model_file: str = MODEL_FILE) -> DataFrame:
    """``id, token_ids array<int>, round_trip boolean`` of every record; round_trip: the ids decode to
    exactly the text.

    The ids are SentencePiece's own for the model (unigram or BPE), with its dummy prefix and its byte
    pieces for unknown characters. Only a word mark (U+2581) in the text itself is encoded by its bytes,
    so that it decodes to itself and not to a space. Null: null ids and
    round_trip, empty: no ids. The model is read by the driver and its vocabulary is broadcast once: a worker keeps it, with the
    segments that it met, from task to task.
    """
    sent = docs.sparkSession.sparkContext.broadcast(Pieces.load(model_file))  # a vocabulary: bounded
    text_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = sent.value
        for b in batches:
            chunk = np.cumsum([len(t) if t else 0 for t in b.column("text").to_pylist()]) // CHARS_AT_ONCE
            starts = np.flatnonzero(np.diff(chunk, prepend=-1)).tolist()
            for lo, hi in zip(starts, [*starts[1:], b.num_rows], strict=True):
                part = b.slice(lo, hi - lo)
                texts = part.column("text").to_pylist()
                raw = vocabulary.encode_raw(texts)
                same = [None if t is None else d == t.encode() for t, d in zip(texts, vocabulary.decode_raw(raw), strict=True)]
                ends = np.cumsum([0, *map(len, raw)]) // 4
                tokens = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(raw), np.int32)),
                                                  mask=pa.array([t is None for t in texts]))
                yield pa.RecordBatch.from_arrays([part.column("id"), tokens, pa.array(same, pa.bool_())], ["id", "token_ids", "round_trip"])

    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, token_ids array<int>, round_trip boolean")


def decode(tokens: DataFrame, *, id_col: str = "id", ids_col: str = "token_ids", model_file: str = MODEL_FILE) -> DataFrame:
    """``id, text`` of every record of ids (null: null; numbers that the model doesn't have raise)."""
    vocabulary = Pieces.load(model_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [None if i is None else vocabulary.decode(i) for i in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(texts, pa.string())], ["id", "text"])

    src = tokens.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, text string")
