import random
import re

import numpy as np
import xxhash

from daybook.llm.shared import connected_components
from daybook.llm.simhash import fingerprints_of, keep_one, near_duplicates, near_links, segment_counts


def brute_fingerprint(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + k]).encode(), 42) for i in range(max(1, len(words) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, max_bits=4):
    """{id: fingerprint} -> {id: smallest id reachable}"""
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if (prints[a] ^ prints[b]).bit_count() <= max_bits:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def test_fingerprints():
    random.seed(3)
    texts = [None, "", " \n\t", "one", "ONE two", "Straße ÄÖ Éa x", "a b c\x0bd e f", "x " * 1000]
    texts += [" ".join(random.choice("abcdefgh") * random.randint(1, 3) for _ in range(random.randint(1, 600))) for _ in range(60)]
    assert fingerprints_of(texts, 4).tolist() == [brute_fingerprint(t) for t in texts]


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = near_duplicates(docs).collect()
    prints = {r["doc_id"]: brute_fingerprint(r["text"]) for r in docs.collect()}
    assert {r["id"]: r["fp"] % (1 << 64) for r in rows} == prints
    assert {r["id"]: r["component"] for r in rows} == brute_groups(prints)


def linked(spark, prints, block_rows):
    df = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)),) for p in prints], "fp long")
    found = connected_components(near_links(df, 4, block_rows)).collect()
    named = {r["node"] % (1 << 64): r["component"] % (1 << 64) for r in found}
    groups = {}
    for p in prints:
        groups.setdefault(named.get(p, p), set()).add(p)
    return sorted(map(sorted, groups.values()))


def test_links_at_every_distance_and_in_hot_cells(spark):
    random.seed(5)
    prints = {0, (1 << 64) - 1}
    for _ in range(60):
        p = random.getrandbits(64)
        prints.add(p)
        for bits in range(1, 7):
            prints.add(p ^ sum(1 << b for b in random.sample(range(64), bits)))
    dense = random.getrandbits(64)  # a hot group of close fingerprints
    prints |= {dense ^ sum(1 << b for b in random.sample(range(64), random.randint(0, 3))) for _ in range(300)}
    prints = sorted(prints)
    groups = {}
    for i, root in brute_groups(dict(enumerate(prints))).items():
        groups.setdefault(root, []).append(prints[i])
    want = sorted(map(sorted, groups.values()))
    assert linked(spark, prints, 4096) == want
    assert linked(spark, prints, 16) == want  # cells cut into blocks


def test_lower_bound():
    rng = np.random.default_rng(0)
    a, b = (rng.integers(0, 1 << 63, 1000, dtype=np.uint64) for _ in range(2))
    manhattan = np.abs(segment_counts(a).astype(int) - segment_counts(b)).sum(1)
    assert (manhattan <= np.bitwise_count(a ^ b)).all()


def test_odd_rows(odd_documents, no_documents):
    rows = near_duplicates(odd_documents).collect()
    assert len(rows) == 11
    got = {(r["id"], r["fp"] == 0): r["component"] for r in rows}
    assert got[3, True] == got[4, True] == got[5, True] == got[None, True] == 3
    assert got[1, False] == got[2, False] == 1
    assert near_duplicates(no_documents).collect() == []
    kept = keep_one(odd_documents, near_duplicates(odd_documents))
    assert kept.columns == odd_documents.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([1, 3, 6, 7, 8, None, None], key=str)


def test_components(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(200, i) for i in range(201, 260)] + [(7, 3), (3, 9), (9, 7), (5, 5)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {i: 100 for i in range(100, 141)} | {i: 200 for i in range(200, 260)} | {3: 3, 7: 3, 9: 3}
    assert got == want
    assert connected_components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_one_id_with_several_texts(spark):
    words = {c: " ".join(f"{c}{i}" for i in range(60)) for c in "abcd"}
    rows = [(1, words["a"]), (5, words["a"]), (5, words["b"]), (6, words["b"]), (5, words["c"]), (5, words["c"]), (5, words["c"].upper()),
            (7, words["c"]), (8, words["d"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(map(tuple, keep_one(docs, near_duplicates(docs)).collect()))
    # every group leaves one: a by id 1, b and c by id 5 (c in either case), d by id 8
    assert sorted((i, t.lower()) for i, t in kept) == [(1, words["a"]), (5, words["b"]), (5, words["c"]), (8, words["d"])]
