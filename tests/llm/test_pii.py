import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from daybook.llm import pii, queries

SF = "/root/testdata/sf0.01"


def luhn_by_sum(digits):
    double = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(double)) % 10 == 0


def brute_base(text):
    """The patterns as they are stated, by the regular expression engine."""
    text = text or ""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m.group().split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
            if 16 <= len(d := re.sub("[^0-9]", "", m.group())) <= 19 and luhn_by_sum(d)]
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return out


@settings(max_examples=1500, deadline=None)
@given(st.text(st.sampled_from("a@.-+0 19(x_é25"), max_size=40) | st.text(st.sampled_from("0123456789 -.+"), max_size=60))
def test_patterns(text):
    assert pii.base_spans(text) == brute_base(text)


@pytest.mark.parametrize("text", ["a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "256.1.1.1", "0000255.1.1.1", "4111 1111-1111 1111", "4111111111111112", "4111111111111111",
                                  "+1 (234) 555-1234", "+1234567 (", "+12+345678901", "a@b", "@b.c", "x@@b.c", "4" * 50, "+" * 5 + "1234567890", "日本 a@b.de 日"])
def test_patterns_on_given_texts(text):
    assert pii.base_spans(text) == brute_base(text)


def test_very_long_runs_are_linear():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 100_000, "+1 " + "(" * 200_000, "a" * 200_000 + "@b"):
        pii.base_spans(text)


def test_gradient():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in pii.initial(3, 1).items()}
    chars, tags = rng.integers(0, pii.SYMBOLS, (7, 4)), np.zeros((7, 4), int)
    tags[2:4, 0], tags[1:4, 2] = [1, 2], [3, 4, 4]
    grad = pii.loss_and_gradient(p, chars, tags)[1]
    for name, values in p.items():
        for _ in range(5):
            at = (int(chars[rng.integers(7), rng.integers(4)]), int(rng.integers(12))) if name[0] == "w" else tuple(rng.integers(0, s) for s in values.shape)
            ends = []
            for step in (1e-5, -1e-5):
                q = {k: v.copy() for k, v in p.items()}
                q[name][at] += step
                ends.append(pii.loss_and_gradient(q, chars, tags)[0])
            assert (ends[0] - ends[1]) / 2e-5 == pytest.approx(grad[name][at], abs=1e-5)


def test_viterbi_and_sums_equal_all_paths():
    import itertools

    rng = np.random.default_rng(2)
    p = {"move": rng.normal(size=(pii.TAGS, pii.TAGS)), "first": rng.normal(size=pii.TAGS), "last": rng.normal(size=pii.TAGS)}
    e = rng.normal(size=(4, 1, pii.TAGS))
    move, first = pii._moves(p)
    paths = {t: first[t[0]] + p["last"][t[-1]] + sum(e[i, 0, x] for i, x in enumerate(t)) + sum(move[a, b] for a, b in zip(t, t[1:], strict=False))
             for t in itertools.product(range(pii.TAGS), repeat=4)}
    assert tuple(pii.viterbi(p, e)[:, 0]) == max(paths, key=paths.get)
    alpha, beta, total = pii._forward_backward(p, e)
    assert total[0] == pytest.approx(np.logaddexp.reduce(list(paths.values())))
    for t in range(4):
        share = [np.exp(np.logaddexp.reduce([s for q, s in paths.items() if q[t] == x]) - total[0]) for x in range(pii.TAGS)]
        assert np.exp(alpha[t, 0] + beta[t, 0] - total[0]) == pytest.approx(share)


def test_reconcile():
    whole = ("email", 60, 140, 0.95)
    # both windows' borders cut the span: one span again
    assert pii.reconcile([("email", 60, 128, 0.9), ("email", 64, 140, 0.95)]) == [whole]
    # two windows agree against one
    assert pii.reconcile([("ip", 10, 20, 0.5), ("ip", 10, 20, 0.6), ("phone", 15, 30, 0.9)]) == [("ip", 10, 20, 0.6)]
    assert pii.reconcile([("card", 5, 25, 0.9), ("phone", 3, 8, 0.5), ("phone", 22, 30, 0.5)]) == [("phone", 3, 8, 0.5), ("phone", 22, 30, 0.5)]
    assert pii.reconcile([]) == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(pii.KINDS), st.integers(1, 9), st.integers(1, 5), st.floats(0.1, 1)), max_size=7))
def test_reconcile_takes_the_best_choice(found):
    import itertools

    spans = list({(k, 2 * a + 1, 2 * a + 1 + n): (k, 2 * a + 1, 2 * a + 1 + n, w) for k, a, n, w in found if (2 * a + 1 + n) % 64}.values())
    best = max(sum(s[3] for s in c) for n in range(len(spans) + 1) for c in itertools.combinations(spans, n)
               if all(x[2] <= y[1] or y[2] <= x[1] for x, y in itertools.combinations(c, 2)))
    got = pii.reconcile(spans)
    assert sum(s[3] for s in got) == pytest.approx(best) and all(x[2] <= y[1] for x, y in zip(got, got[1:], strict=False))


@pytest.fixture(scope="module")
def model(spark):
    return pii.fit(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))


def held_out(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    return [r["text"] for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]


def test_network_finds_held_out_base_spans(spark, model):
    texts = held_out(spark, "/root/testdata/sf0.1")
    want = found = extra = 0
    for text, spans in zip(texts, model.windows(texts), strict=True):
        base = set(brute_base(text))
        got = {s[:3] for s in pii.reconcile(spans) if s[3] >= model.confidence and pii.plausible(s[0], text, s[1], s[2])}
        want, found, extra = want + len(base), found + len(base & got), extra + len(got - base)
    assert want > 40 and found >= 0.9 * want and extra <= 0.05 * want


def test_network_adds_spans_the_patterns_miss(spark, model):
    rng = np.random.default_rng(99)
    windows = [t[i:i + 100] for t in held_out(spark, SF) for i in range(0, min(len(t), 2000), 700) if not pii.ANCHOR.search(t[i:i + 100])]
    want = found = added = 0
    for w in windows[:600]:
        text, spans = pii.with_written(w, [], rng)
        got = {s[:3] for s in model.spans([text])[0]}
        if spans and len(text) < pii.WINDOW:
            want, found, added = want + 1, found + (spans[0] in got), added + (spans[0] in got and spans[0] not in brute_base(text))
        elif not spans:
            assert not [s for s in model.spans([text])[0] if not s[3]], text
    assert want > 200 and found >= 0.8 * want and added >= 50


def test_clean_documents_are_left_alone(spark, model):
    texts = [t for t in held_out(spark, "/root/testdata/sf0.1") if not brute_base(t)]
    assert sum(bool(s) for s in model.spans(texts)) <= 0.002 * len(texts)


def test_spans_beyond_any_window(model):
    texts = ["x" * 100 + " " + "abc." * 40 + "def@example.com and 10[.]20[.]30[.]40 " + "y" * 300 + " +1 (234) 555-1234"]
    spans = model.spans(texts)[0]
    assert {s[:3] for s in spans if s[3]} == set(brute_base(texts[0])) and all(a[2] <= b[1] or a[0] != b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_query_equals_brute_force_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = queries.op12_pii(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = brute_base(texts[r["doc_id"]])
        digest = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r["base_sha256"] == hashlib.sha256(digest.encode()).hexdigest()
        assert tuple(r[f"n_{k}"] for k in pii.KINDS) == tuple(sum(s[0] == k for s in base) for k in pii.KINDS)
        spans = r["spans"].split(",") if r["spans"] else []
        assert set(digest.split(",") if digest else []) <= set(spans)
        assert spans == sorted(spans, key=lambda s: (pii.KINDS.index(s.split(":")[0]), int(s.split(":")[1])))


def test_training_does_not_depend_on_partitions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    one, two = (pii.fit(d, steps=5).parameters for d in (docs.repartition(1), docs.repartition(7)))
    assert all(np.array_equal(one[k], two[k]) for k in one)


def test_odd_rows(odd_documents, no_documents):
    model = pii.fit(odd_documents, steps=3)
    rows = queries.pii_digest(pii.find(odd_documents, model)).collect()
    assert len(rows) == 11 and all(r["base_sha256"] == hashlib.sha256(b"").hexdigest() and r["spans"] == "" for r in rows)
    assert pii.fit(no_documents).parameters == {} and pii.find(no_documents, pii.Model()).collect() == []
