import random
import time

import numpy as np
import pytest
import sentencepiece

from daybook.llm import pieces

ODD = ["", " ", "  a ", "x\n\ny\t", "日本 \U0001f600 é\x00", "a" * 3000, "﻿ ok", " \n ", "    " * 9 + "x", "a   日  b", " " * 40]


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Pieces.load()


def texts():
    random.seed(0)
    return ODD + ["".join(random.choice(" ab日e thn\n.x") for _ in range(random.randint(1, 40))) for _ in range(2000)]


def test_same_ids_as_the_library(spark, vocabulary):
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL_FILE)
    docs = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    for batch in (texts(), docs):
        ids = vocabulary.encode(batch)
        assert ids == library.encode(batch)
        assert [vocabulary.decode(i) for i in ids] == batch


def test_lone_words(vocabulary, monkeypatch):
    """Words of their own length go one by one, with the same ids; time is in proportion to their length."""
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL_FILE)
    rng = random.Random(7)
    base64 = "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=1_000_000))
    start = time.process_time()
    ids = vocabulary.encode([base64])[0]
    assert time.process_time() - start < 30
    assert ids == library.encode(base64) and vocabulary.decode(ids) == base64
    words = ["a" * 100_001, "ab-" * 9_999, base64[:5_000], "日本" * 500 + "\ud7ff" + "é" * 99, "▁x" * 300, "the" * 400]
    assert [vocabulary.decode(i) for i in vocabulary.encode(words)] == words
    assert vocabulary.encode(words[:4]) == library.encode(words[:4])
    assert not any(len(w) > pieces.KNOWN_LENGTH for w in vocabulary.known)
    monkeypatch.setattr(pieces, "LONE_LENGTH", 0)
    fresh = pieces.Pieces(**{**vocabulary.__dict__, "known": {}})
    assert fresh.encode(texts()) == library.encode(texts())


def test_lone_words_of_a_unigram_model(vocabulary, monkeypatch):
    v = pieces.Pieces(**{**vocabulary.__dict__, "merges": None, "known": {}})
    words = [pieces.MARK + "".join(random.Random(n).choices("thenadior日", k=n % 30 + 1)) for n in range(300)]
    v._learn(set(words))
    assert all(v._alone(w) == v.known[w] for w in words)


def test_hash_collision_goes_the_other_way(vocabulary):
    codes = vocabulary.codes.copy()
    codes[:, 0] += 1  # every piece on a way looks like another text of the same hash
    v = pieces.Pieces(**{**vocabulary.__dict__, "codes": codes, "known": {}})
    assert v.encode(["the end"]) == vocabulary.encode(["the end"])


def brute_unigram(v, word):
    """Best sum of scores over all segmentations."""
    score = {"".join(map(chr, c[:n])): s for c, n, s in zip(v.codes, v.lengths, v.scores, strict=True)}
    best = [0.0] + [None] * len(word)
    for end in range(1, len(word) + 1):
        best[end] = max(best[s] + score.get(word[s:end], v.unknown_score if end - s == 1 else -1e300) for s in range(end))
    return best[-1]


def test_unigram_paths_are_of_largest_score(vocabulary):
    v = pieces.Pieces(**{**vocabulary.__dict__, "merges": None, "known": {}})
    score = dict(zip(v.ids.tolist(), v.scores.tolist(), strict=True))
    rng = random.Random(4)
    words = [pieces.MARK + "".join(rng.choice("thenadior") for _ in range(rng.randint(1, 14))) for _ in range(300)]
    v._learn(set(words))
    for w in words:
        assert sum(score[i] for i in np.frombuffer(v.known[w], np.int32).tolist()) == pytest.approx(brute_unigram(v, w))


def test_word_marks_in_the_text_survive(vocabulary):
    for t in ("▁", "▁a▁ b", "a▁b", " ▁ "):
        assert vocabulary.decode(vocabulary.encode([t])[0]) == t


def test_odd_rows(odd_documents, no_documents):
    rows = pieces.encode(odd_documents).collect()
    assert len(rows) == 11
    assert all(r["round_trip"] for r in rows if r["token_ids"] is not None)
    assert sum(r["token_ids"] is None for r in rows) == 2 and sum(r["token_ids"] == [] for r in rows) == 1
    assert pieces.encode(no_documents).collect() == []


def test_decode_frame(odd_documents):
    back = pieces.decode(pieces.encode(odd_documents)).collect()
    assert sorted(((r["id"], r["text"]) for r in back), key=str) == sorted(((r["doc_id"], r["text"]) for r in odd_documents.collect()), key=str)
