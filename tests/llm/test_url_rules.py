import re

import pytest
from pyspark.sql import functions as F

from daybook.llm import url_rules
from daybook.llm.queries import URL_RULES

URLS = [None, "", "no scheme", "http://", "http://A.COM", "http://a.com/", "http://www.Example.com/en/x?q#f", "https://b.example.com/en/", "https://b.example.com/EN/",
        "http://x.net/es/1", "http://net/es/1", "http://xnet/es/1", "http://x.net/fr", "ftp://u@x.net:80/fr/", "a://b://c.com/d", "http://x.com?/en/", "http://ÄA.com/é",
        "x\ny://h.net/fr/1", "http://example.com/en/" + "p/" * 30_000, "http://example.com/en/../com/"]


def plain(url):
    m = re.match(r".*?://([^/?#]*)([^?#]*)", url or "", re.S)
    host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = [(len(h + p), h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits)[1] if fits else None, max(fits)[2] if fits else None


def test_given_rules(spark):
    df = spark.createDataFrame([(i, u, "x", "y", 1) for i, u in enumerate(URLS)], "page_id long, url string, host string, rule string, label int")
    rows = {r["id"]: r for r in url_rules.judge(df, URL_RULES).collect()}
    assert len(rows) == len(URLS)
    for i, u in enumerate(URLS):
        host, path, rule, verdict = plain(u)
        assert (rows[i]["host"], rows[i]["path"], rows[i]["rule"]) == (host, path, rule)
        assert rows[i]["verdict"] == (verdict or "allow") and not rows[i]["learned"]
    assert url_rules.judge(df.limit(0), URL_RULES).collect() == []


def test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = {r["id"]: r for r in url_rules.judge(pages, URL_RULES).collect()}
    for p in pages.select("page_id", "url").collect():
        assert (rows[p["page_id"]]["host"], rows[p["page_id"]]["path"], rows[p["page_id"]]["rule"]) == plain(p["url"])[:3]


def brute_rules(labelled, support, confidence, size):
    from itertools import combinations
    tokens = {u: frozenset(t) for u, t, _ in labelled}
    label = {u: v for u, _, v in labelled}
    counts, hits = {}, {}
    for u, items in tokens.items():
        for n in range(1, size + 1):
            for c in combinations(sorted(items), n):
                counts[c] = counts.get(c, 0) + 1
                if label[u]:
                    hits[c, label[u]] = hits.get((c, label[u]), 0) + 1
    return {(c, v): n / counts[c] for (c, v), n in hits.items() if n >= support and n / counts[c] >= confidence}


def test_mined_rules_and_inverted_index(spark):
    rows = [(f"http://h{i}.org/{a}/{b}/{i}", "block" if (a, b) == ("x", "y") else "allow" if a == "w" else None)
            for i in range(300) for a, b in [(("x", "w", "v")[i % 3], ("y", "z")[i // 3 % 2])]]
    df = spark.createDataFrame(rows + rows[:50], "url string, label string")
    index = url_rules.mine_rules(df, min_support=0.1, min_count=10)
    tokens = df.distinct().select("url", url_rules.url_tokens(F.col("url")).alias("t"), "label").collect()
    assert all("host:org" in r["t"] for r in tokens)
    want = brute_rules([(r["url"], r["t"], r["label"]) for r in tokens], 30, 0.9, 6)
    got = {}
    for r in index.collect():
        got.setdefault((r["rule"], r["label"]), []).append((r["token"], r["need"], r["confidence"]))
    # without the rules that a shorter one of the same label and no less confidence always precedes
    want = {(c, v): n for (c, v), n in want.items()
            if not any(want.get((tuple(x for x in c if x != t), v), 0) >= n for t in c)}
    assert {(tuple(sorted(t for t, _, _ in v)), k[1]) for k, v in got.items()} == set(want)
    assert all(c == pytest.approx(want[tuple(sorted(t for t, _, _ in v)), k[1]]) and n == len(v) for k, v in got.items() for _, n, c in v)
    asked = spark.createDataFrame([("http://new.org/x/y/q",), ("http://new.org/x/z/q",), ("http://new.org/w/z/",), ("http://b/y/x/",), ("none",)], "url string")
    assert {r["url"]: r["label"] for r in url_rules.judge_by_rules(asked, index).collect()} == {
        "http://new.org/x/y/q": "block", "http://b/y/x/": "block", "http://new.org/w/z/": "allow"}


def test_nothing_labelled(spark):
    assert url_rules.mine_rules(spark.createDataFrame([("http://a.org/", None)], "url string, label string")) is None


def test_open_pages_are_judged_by_rules_of_the_labelled(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    tokens = {r["url"]: r["t"] for r in pages.select("url", url_rules.url_tokens(F.col("url")).alias("t")).distinct().collect()}
    labelled = [(u, t, plain(u)[3]) for u, t in tokens.items() if plain(u)[3]]
    n = len(labelled)
    rules = brute_rules(labelled, max(20, 0.002 * n), 0.9, 20)
    rules = {(c, v): p for (c, v), p in rules.items() if not any(rules.get((tuple(x for x in c if x != t), v), 0) >= p for t in c)}
    hits = {(c, v): sum(set(c) <= set(t) and v == label for _, t, label in labelled) for c, v in rules}

    def decided(url):
        fires = [(-rules[c, v], -hits[c, v], -len(c), " ".join([*c, v]), v) for c, v in rules if set(c) <= set(tokens[url])]
        return min(fires)[-1] if fires else None

    rows = {r["id"]: r for r in url_rules.judge(pages, URL_RULES).collect()}
    asked = [p for p in pages.select("page_id", "url").collect() if not plain(p["url"])[3]]
    want = {p["page_id"]: decided(p["url"]) for p in asked}
    assert {i: (rows[i]["verdict"], rows[i]["learned"]) for i in want} == {i: (v or "allow", v is not None) for i, v in want.items()}
    assert any(v is not None for v in want.values()) and any(v is None for v in want.values())
    assert not any(r["learned"] for i, r in rows.items() if i not in want)
