"""Personal data in texts: patterns, and a character-level bidirectional LSTM with CRF transitions.

The patterns give the base spans (e-mail addresses, IP addresses, card and phone numbers). The network,
written in numpy, is trained from labelled spans: windows of the table with the patterns' spans as labels,
and the same windows with spans set in that are written in other ways, which the patterns miss. Texts are read
in overlapping windows, each decoded by Viterbi; the spans of all windows of a text are then
reconciled globally (the non-overlapping choice of largest total confidence) and added to the base spans.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.shared import materialise, text_batches

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Every span holds one of these: where there is none, neither patterns nor network find anything.
ANCHOR = re.compile(r"[0-9@]|[(\[{] ?[aA][tT] ?[)\]}]")
WINDOW, STRIDE = 128, 64
WINDOWS_AT_ONCE = 256
TAGS = 1 + 2 * len(KINDS)  # outside; begin and inside of each kind
#: 0 beyond the text, 1 other letters, 2 other characters, then ASCII
SYMBOLS = 3 + 128
#: tag b may not follow tag a
FORBIDDEN = np.array([[b > 0 and b % 2 == 0 and a not in (b - 1, b) for b in range(TAGS)] for a in range(TAGS)])
NEVER = -1e4

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for n, d in enumerate(reversed(digits)):
        x = int(d) * (1 + n % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join([c for c in text if c in "0123456789"])


def _part(number: str) -> bool:
    number = number.lstrip("0")
    return len(number) <= 3 and int(number or 0) <= 255


def base_spans(text: str | None) -> list[Span]:
    """The patterns' spans, kind by kind from left to right. Linear in the text's length."""
    if not text or not ANCHOR.search(text):
        return []
    out: list[Span] = []
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            out.append(("email", start, end))
        at = text.find("@", max(at + 1, end))
    for m in IP.finditer(text):
        if all(map(_part, m.group().split("."))):
            out.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := _digits(m.group())) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 8 <= len(_digits(m.group())) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def plausible(kind: str, text: str, start: int, end: int) -> bool:
    """Whether a span of the network's can be of its kind: what characters alone don't tell it."""
    found = text[start:end]
    if (start and text[start - 1].isalnum()) or (end < len(text) and text[end].isalnum()) or not ANCHOR.search(found):
        return False
    numbers = re.findall("[0-9]+", found)
    n = sum(map(len, numbers))
    letters = any(c.isalpha() for c in found)
    if kind == "email":
        return len(re.findall(r"[A-Za-z0-9]+", found)) >= 3 and letters
    if kind == "ip":
        return len(numbers) == 4 and all(map(_part, numbers)) and not letters
    if kind == "card":
        return 13 <= n <= 19 and luhn("".join(numbers)) and not letters
    return 7 <= n <= 15 and not letters


def symbols(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.where(codes < 128, codes + 3, 2).astype(np.int64)
    strange = np.flatnonzero(codes >= 128)
    out[strange] = [1 if text[i].isalpha() else 2 for i in strange.tolist()]
    return out


def tags_of(spans: list[Span], length: int) -> np.ndarray:
    out = np.zeros(length, np.int64)
    for kind, start, end in spans:
        k = KINDS.index(kind)
        out[start:end] = 2 + 2 * k
        out[start] = 1 + 2 * k
    return out


# --- the network ------------------------------------------------------------------------------------------


def initial(hidden: int, seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    p = {}
    for way in "fb":
        p["w" + way] = rng.normal(0, 0.3, (SYMBOLS, 4 * hidden))
        p["u" + way] = rng.normal(0, hidden ** -0.5, (hidden, 4 * hidden))
        p["b" + way] = np.zeros(4 * hidden)
        p["b" + way][hidden:2 * hidden] = 1.0  # remember at first
    p["out"], p["bias"] = rng.normal(0, 0.2, (2 * hidden, TAGS)), np.zeros(TAGS)
    p["move"], p["first"], p["last"] = np.zeros((TAGS, TAGS)), np.zeros(TAGS), np.zeros(TAGS)
    return {k: v.astype(np.float32) for k, v in p.items()}


def _lstm(p: dict, way: str, chars: np.ndarray) -> tuple[np.ndarray, list]:
    """States (time, window, hidden) of one direction, and what its gradient needs. Gates: input, forget,
    output, candidate."""
    w, u = p["w" + way], p["u" + way]
    n = u.shape[0]
    half = np.concatenate([np.full(3 * n, 0.5), np.ones(n)]).astype(w.dtype)  # sigmoid(x) = (1 + tanh(x / 2)) / 2
    given = (w + p["b" + way])[chars] * half
    u = u * half
    h = c = np.zeros((chars.shape[1], n), w.dtype)
    out, kept = np.empty((*chars.shape, n), w.dtype), []
    for t in (range(len(chars)) if way == "f" else range(len(chars) - 1, -1, -1)):
        z = np.tanh(given[t] + h @ u)
        z[:, :3 * n] = 0.5 + 0.5 * z[:, :3 * n]
        before_h, before_c = h, c
        c = z[:, n:2 * n] * c + z[:, :n] * z[:, 3 * n:]
        squeezed = np.tanh(c)
        h = z[:, 2 * n:3 * n] * squeezed
        out[t] = h
        kept.append((t, z, before_h, before_c, squeezed))
    return out, kept


def _lstm_gradient(p: dict, way: str, chars: np.ndarray, kept: list, d_out: np.ndarray, grad: dict) -> None:
    u = p["u" + way]
    n = u.shape[0]
    d_h = d_c = np.zeros(d_out.shape[1:], u.dtype)
    d_z = np.empty((*chars.shape, 4 * n), u.dtype)
    d_u = np.zeros_like(u)
    for t, z, before_h, before_c, squeezed in reversed(kept):
        i, f, o, g = z[:, :n], z[:, n:2 * n], z[:, 2 * n:3 * n], z[:, 3 * n:]
        d_h = d_h + d_out[t]
        d_c = d_c + d_h * o * (1 - squeezed ** 2)
        dz = d_z[t]
        dz[:, :n] = d_c * g * i * (1 - i)
        dz[:, n:2 * n] = d_c * before_c * f * (1 - f)
        dz[:, 2 * n:3 * n] = d_h * squeezed * o * (1 - o)
        dz[:, 3 * n:] = d_c * i * (1 - g ** 2)
        d_u += before_h.T @ dz
        d_h, d_c = dz @ u.T, d_c * f
    flat = d_z.reshape(-1, 4 * n)
    order = np.argsort(chars, axis=None, kind="stable")
    symbol = chars.ravel()[order]
    starts = np.flatnonzero(np.diff(symbol, prepend=-1))
    d_w = np.zeros_like(p["w" + way])
    d_w[symbol[starts]] = np.add.reduceat(flat[order], starts, axis=0)
    grad["w" + way], grad["u" + way], grad["b" + way] = d_w, d_u, flat.sum(0)


def _emissions(p: dict, chars: np.ndarray) -> tuple[np.ndarray, tuple]:
    forward, kept_f = _lstm(p, "f", chars)
    backward, kept_b = _lstm(p, "b", chars)
    both = np.concatenate([forward, backward], axis=2)
    return both @ p["out"] + p["bias"], (both, kept_f, kept_b)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + np.squeeze(top, axis)


def _moves(p: dict) -> tuple[np.ndarray, np.ndarray]:
    first = np.where(FORBIDDEN[0], NEVER, p["first"].astype(np.float64))  # as after an outside tag
    return np.where(FORBIDDEN, NEVER, p["move"].astype(np.float64)), first


def _forward_backward(p: dict, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log sums of the paths up to each tag and from it on, and of all paths of each window."""
    move, first = _moves(p)
    alpha, beta = np.empty(e.shape), np.empty(e.shape)
    alpha[0] = first + e[0]
    for t in range(1, len(e)):
        alpha[t] = _log_sum(alpha[t - 1][:, :, None] + move, 1) + e[t]
    beta[-1] = p["last"]
    for t in range(len(e) - 2, -1, -1):
        beta[t] = _log_sum(move + (e[t + 1] + beta[t + 1])[:, None, :], 2)
    return alpha, beta, _log_sum(alpha[-1] + p["last"], 1)


def loss_and_gradient(p: dict, chars: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
    """Mean negative log-likelihood of the tags (time, window), and its gradient."""
    e, (both, kept_f, kept_b) = _emissions(p, chars)
    e = e.astype(np.float64)
    steps, n = tags.shape
    alpha, beta, total = _forward_backward(p, e)
    move, first = _moves(p)
    window = np.arange(n)
    gold = first[tags[0]] + e[0, window, tags[0]] + p["last"][tags[-1]]
    d_e = np.exp(alpha + beta - total[:, None])
    d_first, d_last = d_e[0].sum(0), d_e[-1].sum(0)
    d_move = np.zeros_like(move)
    for t in range(1, steps):
        gold = gold + move[tags[t - 1], tags[t]] + e[t, window, tags[t]]
        d_move += np.exp(alpha[t - 1][:, :, None] + move + (e[t] + beta[t] - total[:, None])[:, None, :]).sum(0)
    np.subtract.at(d_move, (tags[:-1].ravel(), tags[1:].ravel()), 1.0)
    np.subtract.at(d_first, tags[0], 1.0)
    np.subtract.at(d_last, tags[-1], 1.0)
    np.subtract.at(d_e, (np.repeat(np.arange(steps), n), np.tile(window, steps), tags.ravel()), 1.0)
    scale = 1.0 / n
    d_e = (d_e * scale).astype(both.dtype)
    grad = {"first": np.where(FORBIDDEN[0], 0, d_first) * scale, "last": d_last * scale, "move": np.where(FORBIDDEN, 0, d_move) * scale,
            "out": both.reshape(-1, both.shape[2]).T @ d_e.reshape(-1, TAGS), "bias": d_e.sum((0, 1))}
    d_both = d_e @ p["out"].T
    h = d_both.shape[2] // 2
    _lstm_gradient(p, "f", chars, kept_f, d_both[:, :, :h], grad)
    _lstm_gradient(p, "b", chars, kept_b, d_both[:, :, h:], grad)
    return float((total - gold).mean()), grad


def train(chars: np.ndarray, tags: np.ndarray, *, hidden: int = 24, steps: int = 500, batch: int = 64, rate: float = 0.012,
          seed: int = 17) -> dict[str, np.ndarray]:
    """Parameters after ``steps`` of Adam over windows (window, time) in seeded order."""
    p = initial(hidden, seed)
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    rng = np.random.default_rng(seed)
    order = np.concatenate([rng.permutation(len(chars)) for _ in range(steps * batch // len(chars) + 1)])
    for s in range(1, steps + 1):
        part = order[(s - 1) * batch:s * batch]
        _, grad = loss_and_gradient(p, chars[part].T, tags[part].T)
        size = np.sqrt(sum(float((g ** 2).sum()) for g in grad.values()))
        here = rate * min(1.0, 2.0 * (1 - (s - 1) / steps))  # falls over the second half
        for k, g in grad.items():
            g = (g * min(1.0, 5.0 / max(size, 1e-9))).astype(np.float32)
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g ** 2
            p[k] = p[k] - here * (m[k] / (1 - 0.9 ** s)) / (np.sqrt(v[k] / (1 - 0.999 ** s)) + 1e-8)
    return {k: x.astype(np.float32) for k, x in p.items()}


def viterbi(p: dict, e: np.ndarray) -> np.ndarray:
    """Best tags (time, window) of the emissions."""
    move, first = _moves(p)
    best = first + e[0]
    back = np.empty(e.shape, np.int8)
    for t in range(1, len(e)):
        ways = best[:, :, None] + move
        back[t] = ways.argmax(1)
        best = ways.max(1) + e[t]
    tags = np.empty(e.shape[:2], np.int64)
    tags[-1] = (best + p["last"]).argmax(1)
    row = np.arange(e.shape[1])
    for t in range(len(e) - 1, 0, -1):
        tags[t - 1] = back[t, row, tags[t]]
    return tags


@dataclass
class Model:
    """Parameters; none: only the patterns speak."""

    parameters: dict[str, np.ndarray] = field(default_factory=dict)
    confidence: float = 0.9

    def windows(self, texts: list[str]) -> list[list[tuple[str, int, int, float]]]:
        """Spans with confidence (the least probability of a tag in it) that each window finds, in places of
        its text; all windows of all texts advance together."""
        out: list[list] = [[] for _ in texts]
        if not self.parameters:
            return out
        where, rows = [], []
        for n, text in enumerate(texts):
            at = np.array([m.start() for m in ANCHOR.finditer(text)], np.int64) // STRIDE
            if not len(at):
                continue
            starts = np.unique(np.concatenate([at, at - 1]))
            starts = starts[(starts >= 0) & ((starts == 0) | ((starts - 1) * STRIDE + WINDOW < len(text)))] * STRIDE
            code = np.concatenate([symbols(text), np.zeros(WINDOW, np.int64)])
            rows.append(code[starts[:, None] + np.arange(WINDOW)])
            where += [(n, s) for s in starts.tolist()]
        if not where:
            return out
        chars = np.concatenate(rows)
        for lo in range(0, len(chars), WINDOWS_AT_ONCE):
            e = _emissions(self.parameters, chars[lo:lo + WINDOWS_AT_ONCE].T)[0].astype(np.float64)
            tags = viterbi(self.parameters, e)
            some = np.flatnonzero(tags.any(0))
            if not len(some):
                continue
            alpha, beta, total = _forward_backward(self.parameters, e[:, some])
            for i, w in enumerate(some.tolist()):
                n, start = where[lo + w]
                sure = np.exp(alpha[np.arange(WINDOW), i, tags[:, w]] + beta[np.arange(WINDOW), i, tags[:, w]] - total[i])
                for kind, a, b in spans_of(tags[:, w]):
                    b = min(b, len(texts[n]) - start)
                    if a < b:
                        out[n].append((kind, start + a, start + b, float(sure[a:b].min())))
        return out

    def spans(self, texts: list[str | None]) -> list[list[tuple[str, int, int, bool]]]:
        """All spans of each text (kind, start, end, whether of the patterns), by kind, then start."""
        given = [t or "" for t in texts]
        out = []
        for text, found in zip(given, self.windows(given), strict=True):
            base = base_spans(text)
            all_spans = [(*s, True) for s in base]
            for kind, a, b, sure in reconcile(found):
                if sure >= self.confidence and not any(a < y and x < b for _, x, y in base) and plausible(kind, text, a, b):
                    all_spans.append((kind, a, b, False))
            out.append(sorted(all_spans, key=lambda s: (KINDS.index(s[0]), s[1])))
        return out


def spans_of(tags: np.ndarray) -> list[Span]:
    out: list[Span] = []
    for t in np.flatnonzero(tags).tolist():
        tag = int(tags[t])
        if tag % 2:
            out.append((KINDS[tag // 2], t, t + 1))
        else:
            out[-1] = (*out[-1][:2], t + 1)
    return out


def reconcile(found: list[tuple[str, int, int, float]]) -> list[tuple[str, int, int, float]]:
    """One set of spans from those of all overlapping windows of a text.

    A span that a window's border cuts lies on that border: spans of one kind that overlap where one
    begins or ends on a border become one. Equal spans of several windows add their weights;
    among the rest the non-overlapping choice of the largest total weight is kept.
    """
    merged: list[list] = []
    for kind, a, b, sure in sorted(found, key=lambda s: (KINDS.index(s[0]), s[1], s[2])):
        last = merged[-1] if merged else None
        if last and last[0] == kind and a < last[2] and (a, b) != (last[1], last[2]) and any(x % STRIDE == 0 for x in (a, b, last[1], last[2])):
            last[2], last[3], last[4] = max(b, last[2]), max(sure, last[3]), last[4] + sure
        elif last and last[:3] == [kind, a, b]:
            last[3], last[4] = max(sure, last[3]), last[4] + sure
        else:
            merged.append([kind, a, b, sure, sure])
    merged.sort(key=lambda s: (s[2], s[1]))
    ends = [s[2] for s in merged]
    best: list[tuple[float, tuple | None, int]] = [(0.0, None, 0)]  # of the first n: weight, last span taken, where it goes on
    for n, s in enumerate(merged):
        before = bisect_right(ends, s[1], 0, n)
        take = best[before][0] + s[4]
        best.append((take, (s[0], s[1], s[2], s[3]), before) if take > best[n][0] else (best[n][0], None, n))
    out, n = [], len(merged)
    while n:
        _, span, before = best[n]
        if span:
            out.append(span)
        n = before
    return out[::-1]


# --- labelled spans -----------------------------------------------------------------------------------------


def written(kind: str, rng: np.random.Generator) -> str:
    """A span of the kind written in a way that people use and the patterns may not know."""
    def pick(*options: str) -> str:
        return options[int(rng.integers(len(options)))]

    def digits(n: int) -> str:
        return "".join(map(str, rng.integers(0, 10, n)))

    def word(low: int = 2, high: int = 9) -> str:
        return "".join("abcdefghijklmnopqrstuvwxyz"[i] for i in rng.integers(0, 26, int(rng.integers(low, high))))

    if kind == "email":
        name = pick(word(), f"{word()}.{word()}", f"{word()}.{digits(2)}", f"{word()}_{word()}", word() + digits(2))
        host = pick(word(), f"{word()}{digits(1)}.{word()}", f"{word()}-{word()}")
        at = pick("@", "@", " @ ", " (at) ", "(at)", " [at] ", "[at]", "[AT]", " {at} ")
        dot = "." if "t" not in at.lower() else pick(".", " (dot) ", " [dot] ", "[dot]")
        return f"{name}{at}{host.replace('.', dot)}{dot}{pick('com', 'org', 'net', 'de', 'fr', 'es', 'example', 'io')}"
    if kind == "ip":
        return pick(".", ".", "[.]", " . ", "(.)").join(str(x) for x in rng.integers(0, 256, 4))
    if kind == "card":
        size = int(pick("16", "16", "16", "15", "14", "13"))
        body = pick("4", "5", "3", "6") + digits(size - 2)
        number = next(body + str(d) for d in range(10) if luhn(body + str(d)))
        gap = pick("", "", " ", "-", ".", "  ", "_", "/")
        sizes = (4, 6, 5) if size == 15 else (4, 4, 4, 4)
        ends = np.cumsum(sizes).tolist()
        return gap.join(number[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True) if number[a:b])
    area, one, two = digits(3), digits(3), digits(4)
    return pick(f"+1 ({area}) {one}-{two}", f"({area}) {one}-{two}", f"({area}) {one} {two}", f"{area}-{one}-{two}", f"{area}.{one}.{two}",
                f"+{digits(2)} {area} {one}{two}", f"00{digits(2)} {area} {one}{two}", f"0{digits(2)} {one} {two}", f"0{area}/{one}{two}",
                f"+1/{area}/{one}-{two}", f"+{digits(2)}-{area}-{one}-{two}")


def unlabelled(rng: np.random.Generator) -> str:
    """What holds digits or signs and is no personal data."""
    def digits(n: int) -> str:
        return "".join(map(str, rng.integers(0, 10, n)))

    def mixed(n: int, alphabet: str) -> str:
        return "".join(alphabet[i] for i in rng.integers(0, len(alphabet), n))

    options = [digits(int(rng.integers(1, 7))), f"{digits(1)}.{digits(1)}", f"{digits(1)}.{digits(1)}.{digits(1)}", f"20{digits(2)}-0{digits(1)}-1{digits(1)}",
               f"1{digits(1)}:{digits(2)}", f"{digits(2)},{digits(2)}", f"{digits(3)} {digits(2)}", f"{digits(1)}-{digits(2)}", f"19{digits(2)}-20{digits(2)}",
               mixed(40, "0123456789abcdef"), "AKIA" + mixed(16, "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"), "password=" + mixed(18, "0123456789abcdef"),
               f'token = "{mixed(40, "0123456789abcdef")}"', f"@{mixed(6, 'abcdefghij')}", f"{mixed(3, 'abcdef')} @ {digits(2)}", f"{digits(3)},{digits(3)},{digits(3)}",
               f"#{digits(5)}", f"v{digits(1)}.{digits(2)}.{digits(1)}", f"${digits(4)}.{digits(2)}", f"({digits(2)})", f"[{digits(2)}]", f"{digits(2)}%", f"{digits(3)}.{digits(3)}.{digits(3)}"]
    return options[int(rng.integers(len(options)))]


def with_written(window: str, spans: list[Span], rng: np.random.Generator) -> tuple[str, list[Span]]:
    """The window with a span or a harmless number in place of a blank, cut to its length."""
    blanks = [m.start() for m in re.finditer(r"[ \n]", window) if not any(a <= m.start() < b for _, a, b in spans)]
    if not blanks:
        return window, spans
    at = blanks[int(rng.integers(len(blanks)))]
    kind = KINDS[int(rng.integers(len(KINDS)))] if rng.random() < 0.65 else ""
    new = written(kind, rng) if kind else unlabelled(rng)
    lead, tail = (" ", "(", '"', ": ", " <")[int(rng.choice(5, p=[0.8, 0.05, 0.05, 0.05, 0.05]))], (" ", ". ", ", ", "\n", ") ")[
        int(rng.choice(5, p=[0.7, 0.1, 0.1, 0.05, 0.05]))]
    put = lead + new + tail
    moved = [s if s[2] <= at else (s[0], s[1] + len(put) - 1, s[2] + len(put) - 1) for s in spans]
    if kind:
        moved.append((kind, at + len(lead), at + len(lead) + len(new)))
    text = window[:at] + put + window[at + 1:]
    return text[:WINDOW], [(k, a, min(b, WINDOW)) for k, a, b in moved if a < WINDOW]


def examples(windows: list[tuple[str, list[Span]]], copies: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and tags (window, time) of the labelled windows and of ``copies`` of each with a span set in."""
    rng = np.random.default_rng(seed)
    chars, tags = [], []
    for window, spans in windows:
        for given, labelled in [(window, spans), *(with_written(window, spans, rng) for _ in range(copies))]:
            code, tag = np.zeros(WINDOW, np.int64), np.zeros(WINDOW, np.int64)
            code[:len(given)] = symbols(given)
            tag[:len(given)] = tags_of(labelled, len(given))
            chars.append(code)
            tags.append(tag)
    return np.array(chars).reshape(-1, WINDOW), np.array(tags).reshape(-1, WINDOW)


def fold(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string")) % 5


def _labelled_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of the grid that holds an anchor, with the patterns' spans in it, and one more from each text."""
    for b in batches:
        rows = []
        for text in b.column("text").to_pylist():
            spans = base_spans(text)
            at = {m.start() // STRIDE * STRIDE for m in ANCHOR.finditer(text)} | {len(text) // 2 // STRIDE * STRIDE}
            for start in at:
                end = start + WINDOW
                if not any(a < start < z or a < end < z for _, a, z in spans):
                    inside = [f"{k}:{a - start}:{z - start}" for k, a, z in spans if start <= a < z <= end]
                    rows.append((text[start:end], ",".join(inside)))
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)], ["window", "spans"])


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", max_windows: int = 1024, copies: int = 4,
        sample: int = 50_000, steps: int = 500, seed: int = 17) -> Model:
    """Trained from the patterns' spans in at most ``max_windows`` distinct windows with spans and as many
    without, drawn by seeded hashes from about ``sample`` documents, none with ``fold`` 0, and ``copies`` of each
    window with a span written otherwise, or a harmless number, set in. The driver holds these windows only.
    Without any text nothing is learned and the patterns speak alone."""
    text_batches(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text <> ''").where(F.coalesce(fold(F.col("id")) != 0, F.lit(True)))
    chance = min(1.0, sample / max(1, src.count()))
    drawn = F.pmod(F.xxhash64(F.lit(seed), "id", "text"), F.lit(1 << 53)) / F.lit(float(1 << 53)) < chance
    found = src.where(drawn).select("text").mapInArrow(_labelled_windows, "window string, spans string").groupBy("window").agg(F.min("spans").alias("spans"))
    found = materialise(found, "windows")
    order = [F.xxhash64(F.lit(seed), "window"), F.col("window")]
    drawn = [r for some in (F.col("spans") != "", F.col("spans") == "") for r in found.where(some).orderBy(*order).limit(max_windows).collect()]
    windows = [(r["window"], [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in r["spans"].split(",") if s)])
               for r in sorted(drawn, key=lambda r: r["window"])]
    if not windows:
        return Model()
    chars, tags = examples(windows, copies, seed)
    return Model(train(chars, tags, steps=steps, seed=seed))


SCHEMA = "spans array<struct<kind: string, start: int, end: int, base: boolean>>"


def find(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, spans`` of every record: kind, start and end (code points, end exclusive) by kind, then start;
    base: of the patterns. Null and empty texts have none. Whole texts are read: a window without an anchor
    (``ANCHOR``) cannot hold a span of either and is passed by."""
    text_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for lo in range(0, b.num_rows, 128):
                found += model.spans(b.column("text").slice(lo, 128).to_pylist())
            flat = [s for spans in found for s in spans]
            fields = [pa.array([s[i] for s in flat], t) for i, t in enumerate((pa.string(), pa.int32(), pa.int32(), pa.bool_()))]
            ends = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(
                fields, ["kind", "start", "end", "base"]))], ["id", "spans"])

    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, {SCHEMA}")
