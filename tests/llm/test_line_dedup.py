import random
import re

from pyspark.sql import functions as F

from daybook.llm.line_dedup import dedup_lines, selected_windows


def strip(line):
    return line.strip(" \t\r\x0b\x0c")


def brute(docs, run_lines, run_words):
    """docs: sorted [(id, text)] -> {id: (removed, text)} by comparing every window with all before it."""
    seen, out = set(), {}
    split = {i: [x for x in map(strip, (t or "").split("\n")) if x] for i, t in docs}
    gone = {i: set() for i, _ in docs}
    for i, lines in split.items():
        for p in range(len(lines)):
            for n in {run_lines, 1, 2}:
                words = [len(re.findall(r"[^\x20\x09-\x0D]+", x)) for x in lines[p:p + n]]
                heavy = n == 1 and words[0] >= run_words or n == 2 < run_lines and max(words) < run_words <= sum(words)
                if p + n <= len(lines) and (n == run_lines or heavy):
                    key = (n, *lines[p:p + n])
                    if key in seen:
                        gone[i] |= set(range(p, p + n))
                    seen.add(key)
    for i, t in docs:
        if not gone[i]:
            out[i] = (0, t)
            continue
        kept, at = [], -1
        for line in t.split("\n"):
            at += bool(strip(line))
            if not strip(line) or at not in gone[i]:
                kept.append(line)
        out[i] = (len(gone[i]), "\n".join(kept) if any(map(strip, kept)) else "")
    return out


def check(spark, docs, **options):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: (r["lines_removed"], r["text"]) for r in dedup_lines(df, **options).collect()}
    want = brute(sorted(docs, key=lambda d: d[0]), options.get("run_lines", 3), options.get("run_words", 50))
    assert got == want
    return got


def test_every_window_has_its_smallest_hash():
    random.seed(1)
    for _ in range(200):
        h = [random.randint(0, 5) for _ in range(random.randint(0, 20))]
        w = random.randint(1, 5)
        found = selected_windows(h, [0] * len(h), w, 50)
        spans = sorted(s for wins in found.values() for s in wins)
        assert spans == [(i, w) for i in range(len(h) - w + 1)]
        assert all(h[at] == min(h[s:s + w]) for at, wins in found.items() for s, _ in wins)


def test_random_documents(spark):
    random.seed(2)
    lines = [f"line {i}" for i in range(12)] + ["", "  ", " ".join(["long"] * 55), "line 3 ", *(" ".join([w] * 27) for w in ("half", "wrapped", "line"))]
    docs = [(i, "\n".join(random.choice(lines) for _ in range(random.randint(0, 15)))) for i in range(80)]
    got = check(spark, docs)
    assert sum(n for n, _ in got.values()) > 100
    check(spark, docs, run_lines=1)
    check(spark, docs, run_lines=5, run_words=2)


def test_passage_shared_by_many_documents(spark):
    random.seed(3)
    passage = "\n".join(f"shared sentence number {i} of the passage" for i in range(6))
    docs = [(i, f"own {i} a\nown {i} b\n{passage}\nown {i} c") for i in range(200)]
    got = check(spark, docs)
    assert got[0] == (0, docs[0][1])
    assert all(got[i] == (6, f"own {i} a\nown {i} b\nown {i} c") for i in range(1, 200))


def test_overlapping_runs_of_different_documents(spark):
    # the run of 3 shares its selected line with an earlier document, but its neighbours with another
    check(spark, [(1, "x\ny\nz"), (2, "q\ny\nr"), (3, "a\ny\nb"), (4, "q\ny\nr\ns"), (5, "y"), (6, "b\na\ny\nb\nx\ny\nz")])


def test_odd_rows(odd_documents, no_documents):
    rows = dedup_lines(odd_documents.withColumn("lines_removed", F.lit("clash"))).collect()
    text = {(r["doc_id"], r["text"]) for r in odd_documents.collect()}
    assert len(rows) == 11 and {(r["doc_id"], r["text"]) for r in rows} == text and {r["lines_removed"] for r in rows} == {0}
    assert dedup_lines(no_documents).collect() == []


def test_repeated_row_counts_once_and_a_copy_is_emptied(spark):
    text = "a b\nc d\ne f"
    df = spark.createDataFrame([(1, text), (1, text), (2, text + "\n")], "doc_id long, text string")
    assert sorted(map(tuple, dedup_lines(df).select("doc_id", "lines_removed", "text").collect())) == [(1, 0, text), (1, 0, text), (2, 3, "")]


def test_passage_wrapped_into_two_lines(spark):
    first, second = (" ".join(f"{c}{i}" for i in range(30)) for c in "ab")
    passage = f"{first}\n\n{second}"
    docs = [(1, f"x\n{passage}\ny"), (2, passage), (3, f"p\n {second}\n{first}\nq"), (4, f"p\nq\n{first} \n{second}\nr"),
            (5, f"{first}\nz"), (6, f"{first}\nw\n{second}"), (7, f"few words\nof no weight\n{passage}\n{passage}"), (8, "few words\nof no weight")]
    got = {r["doc_id"]: (r["lines_removed"], r["text"]) for r in dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[1] == (0, docs[0][1]) and got[2] == (2, "") and got[4] == (2, "p\nq\nr")
    assert all(got[i] == (0, t) for i, t in docs if i in (3, 5, 6, 8))  # other order, one half, halves apart, few words
    assert got == brute(docs, 3, 50)
    # 49 words stay, 50 go
    short = [(i, " ".join(["a"] * n) + "\n" + " ".join(["b"] * 25)) for i, n in enumerate((24, 24, 25, 25))]
    got = dedup_lines(spark.createDataFrame(short, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["lines_removed"] for r in got} == {0: 0, 1: 0, 2: 0, 3: 2}


def test_wrapped_passages_of_the_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute(sorted((r["doc_id"], r["text"]) for r in docs.collect()), 3, 50)
    assert all(want[i][0] == 2 for i in (278, 615, 773, 830, 991))
    assert {r["doc_id"]: (r["lines_removed"], r["text"]) for r in dedup_lines(docs).collect()} == want
