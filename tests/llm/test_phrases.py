import random
import re
from collections import Counter, defaultdict

import duckdb
import pyarrow as pa
import pytest

from daybook.llm import oracles, phrases

SF = "/root/testdata/sf0.001"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_counts(rows):
    f = defaultdict(Counter)
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for n in (1, 2, 3):
                f[lang or "und"].update(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
    return f


def brute(rows, top=2000, least=10):
    out = set()
    for lang, f in brute_counts(rows).items():
        candidates = [p for p, a in f.items() if len(p) > 1 and a >= least]
        triples = [p for p in candidates if len(p) == 3]
        longest = Counter()
        for t in triples:
            for s in (t[:2], t[1:]):
                longest[s] = max(longest[s], f[t])
        scored = []
        for p in candidates:
            if len(p) == 2 and 100 * longest[p] >= 50 * f[p] and longest[p]:
                continue
            a = f[p]
            score, _, left, right = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), left, right))
        n = sum(c for p, c in f.items() if len(p) == 1)
        out |= {(lang, i, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1)}
    return out


def random_rows(n, seed):
    rng = random.Random(seed)
    pool = ["the", "of", "a", "New", "york", "é", "\xa0x", "日本", "x\x00y", *[f"w{i}" for i in range(40)]]
    return [(rng.choice(["en", "de", None]), "".join(rng.choice(pool[:12] if rng.random() < 0.8 else pool) + rng.choice([" ", " ", " ", "\t ", ". ", "\n", "\r\n"])
                                                     for _ in range(rng.randint(0, 60)))) for _ in range(n)]


@pytest.mark.parametrize("limits", [(16_384, 1_000_000, 1 << 20, 1_000_000), (8, 1_000_000, 1 << 20, 50), (5, 60, 1 << 20, 10), (20, 200, 30, 7)])
def test_tries_and_merge(monkeypatch, limits):
    """Bursts, spills, new dictionaries and folded runs change no count."""
    for name, value in zip(("CONTAINER", "ENTRIES", "WORDS", "MERGE_AT_ONCE"), limits, strict=True):
        monkeypatch.setattr(phrases, name, value)
    rows = [(lang or "und", t) for lang, t in random_rows(400, 3) if t]
    batches = [pa.RecordBatch.from_pylist([{"lang": lang, "text": t} for lang, t in rows[i:i + 50]]) for i in range(0, len(rows), 50)]
    runs = [r for task in (batches[::2], batches[1::2]) for b in phrases._count(iter(task), 5) for r in b.to_pylist()]
    if limits[1] < 1000:
        assert len(runs) > 60
    for r in runs:
        run = phrases.Run.unpack(r["run"])
        assert run.prefixes.to_pylist() == sorted(run.prefixes.to_pylist(), key=str.encode) and run.sizes.sum() == len(run.counts)
    runs.sort(key=lambda r: (r["lang"], r["words"], r["part"]))
    merged = [m for b in phrases._merge(iter([pa.RecordBatch.from_pylist(runs)]), 3) for m in b.to_pylist()]
    want = {(lang, p): n for lang, f in brute_counts(rows).items() for p, n in f.items() if n >= 3}
    assert {(m["lang"], tuple(m["phrase"].split(" "))): m["f"] for m in merged if m["words"]} == want
    assert sum(m["words"] > 0 for m in merged) == len(want)
    total = sum(len(re.findall(r"[^ \t.,;:!?\n\x0b\x0c\r]+", t)) for _, t in rows)
    assert sum(m["f"] for m in merged if not m["words"]) == total


def test_bursts_make_a_tree():
    trie = phrases.Trie()
    trie.add([" ".join(f"the w{i % 150} v{i}" for i in range(60_000))])
    assert any(isinstance(c, phrases.Node) for c in trie.root.children) and len(trie.root.children) > 3
    assert sum(len(t) for t in trie.root.subtrees()) == trie.entries


def as_rows(df):
    return {tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect()}


def test_random_texts_equal_brute_force(spark):
    rows = random_rows(600, 8)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    for top in (2000, 7):
        assert as_rows(phrases.top_collocations(docs, top=top)) == brute(rows, top)


def test_sql_equals_brute_force_and_query(spark):
    from daybook.llm.queries import op13_phrases

    rows = [(r["lang"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    found = con.execute(oracles.ORACLE["op13_phrases"])
    names = [d[0] for d in found.description]
    sql = {tuple(r[names.index(c)] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in found.fetchall()}
    assert sql == brute(rows) == as_rows(op13_phrases(spark, SF))


def test_large_counts_are_exact(spark):
    big = 987_654_321_012_345
    counted = spark.createDataFrame([("en", 1, "a", big), ("en", 1, "b", big - 1), ("en", 2, "a b", big - 2)], "lang string, words int, phrase string, f long")
    r = phrases.collocations(counted).first()
    assert r["score"] == 1_000_000 * (big - 2) ** 2 // (big * (big - 1))


def test_odd_rows(spark, odd_documents, no_documents):
    found = phrases.top_collocations(odd_documents).collect()
    assert {(r["phrase"], r["a"], r["n"]) for r in found} == {("word word word", 59_998, 60_016)}
    assert found[0]["score"] == 1_000_000 * 59_998 ** 2 // (60_000 * 59_999)
    assert phrases.top_collocations(no_documents).collect() == []
    assert phrases.top_collocations(odd_documents.where("text = ''")).collect() == []
