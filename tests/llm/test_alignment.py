import hashlib
import random
from collections import Counter

import numpy as np
import sentencepiece
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from daybook.llm import alignment, queries

SF = "/root/testdata/sf0.001"
ODD = ["", " ", "  a ", "x\n\ny\t", "日本 \U0001f600 é\x00", "a" * 3000, "﻿ ok", " \n ", "    " * 9 + "x", "a   日  b", " " * 40, "▁ a", "a▁",
       "<|endoftext|> and <s> </s>", "it's I'll 'tis '", "a  b  c", "tab\t x \t y", "  lead", "trail  ", "a \x1c b", "  em", "x " * 50]


lists = st.lists(st.tuples(st.sets(st.integers(0, 60)), st.sets(st.integers(0, 60))), max_size=6)


@given(lists)
def test_intersect(pairs):
    a, b = ([sorted(p[i]) for p in pairs] for i in (0, 1))
    flat = [np.array([v for x in side for v in x], np.int64) for side in (a, b)]
    i, j = alignment.intersect(flat[0], np.array(list(map(len, a)), np.int64), flat[1], np.array(list(map(len, b)), np.int64))
    want = [(n, v) for n, (x, y) in enumerate(pairs) for v in sorted(x & y)]
    owner = [n for n, x in enumerate(a) for _ in x], [n for n, x in enumerate(b) for _ in x]
    assert [(owner[0][k], flat[0][k]) for k in i] == want == [(owner[1][k], flat[1][k]) for k in j]


def test_gallop_far():
    long = np.arange(0, 3_000_000, 3)
    short = np.array([0, 5, 299_997, 2_999_997, 9_000_000])
    every = np.zeros(5, np.int64)
    assert alignment.gallop(short, long, every, every + len(long)).tolist() == [0, 2, 99_999, 999_999, 1_000_000]
    assert alignment.gallop(short, long, every + 3, every + 4).tolist() == [3, 3, 4, 4, 4]


def brute(texts):
    """Whole texts, sets of offsets, no galloping and no segments."""
    a = Tokenizer.from_file(alignment.BYTE_FILE)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=alignment.PIECE_FILE)
    spell = {c: v for c, v in alignment.byte_alphabet().items()}
    rows, counts = [], Counter()
    for t in texts:
        rows.append(None)
        if not t:
            continue
        x = a.encode(" " + t, add_special_tokens=False).ids
        y = b.encode(t)
        xb = [bytes(spell[c] for c in a.id_to_token(i)) for i in x]
        yb = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in y for p in [b.id_to_piece(i)]]
        if b"".join(xb) != (" " + t).encode() or b"".join(yb) != (" " + t).encode():
            continue
        ends = [{sum(map(len, z[:n + 1])): n for n in range(len(z))} if len(z) < 500 else dict(zip(cumulative(z), range(len(z)))) for z in (xb, yb)]
        groups, links, i, j = [], [], 0, 0
        for e in sorted(ends[0].keys() & ends[1].keys()):
            p, q = ends[0][e], ends[1][e]
            groups.append(f"{','.join(map(str, x[i:p + 1]))}|{','.join(map(str, y[j:q + 1]))}")
            links.append((x[p], y[q]))
            i, j = p + 1, q + 1
        counts.update(links)
        rows[-1] = (len(x), len(y), groups, links)
    top = {}
    for (_, q), n in counts.items():
        top[q] = max(top.get(q, 0), n)
    out = []
    for r in rows:
        if r is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            n_a, n_b, groups, links = r
            out.append((n_a, n_b, len(groups), len(links), sum(counts[k] == top[k[1]] for k in links), sum(counts[k] for k in links),
                        hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return out


def cumulative(parts):
    n = 0
    for p in parts:
        n += len(p)
        yield n


def same(spark, docs):
    rows = docs.collect()
    want = dict(zip([r["doc_id"] for r in rows], brute([r["text"] for r in rows]), strict=True))
    got = {r[0]: tuple(r[1:]) for r in queries.alignment_digest(docs).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()}
    assert got == want


def test_query_equals_brute_force(spark):
    same(spark, spark.read.parquet(f"{SF}/documents.parquet"))


def test_odd_texts_equal_brute_force(spark):
    rng = random.Random(5)
    texts = ODD + [None] + ["".join(rng.choice(" ab日e thn\n.x'\t▁") for _ in range(rng.randint(1, 40))) for _ in range(1500)]
    same(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_odd_rows(odd_documents, no_documents):
    rows = queries.alignment_digest(odd_documents).collect()
    assert len(rows) == 11
    assert all(r["n_links"] > 0 for r in rows if r["doc_id"] in (1, 2, 5, 6, 8)) and sum(r["groups_sha256"] == "" for r in rows) == 4
    assert all(r["n_b"] == r["n_a"] == r["count_sum"] == 0 for r in rows if r["groups_sha256"] == "")
    assert queries.alignment_digest(no_documents).collect() == []


def test_pairs_are_bounded_by_the_vocabularies(spark):
    aligned = alignment.align(spark.read.parquet(f"{SF}/documents.parquet"))
    aligner = alignment.Aligner()
    aligner.texts(["x"])
    for r in alignment.link_counts(aligned).collect():
        x, y = aligner.a_bytes[r["a"]], aligner.b_bytes[r["b"]]
        assert x.endswith(y) or y.endswith(x)
