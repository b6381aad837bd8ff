import numpy as np
from pyspark.sql import functions as F

from daybook.llm.cell_dedup import near_duplicates


def brute(rows, threshold):
    """rows: {id: (label, vec)} -> {id: (links, component)}"""
    ids = sorted(rows)
    links = {i: set() for i in ids}
    for a in ids:
        for b in ids:
            la, x = rows[a]
            lb, y = rows[b]
            if a < b and la is not None and la == lb and np.dot(x, y) / (np.sqrt(np.dot(x, x)) * np.sqrt(np.dot(y, y))) >= threshold:
                links[a].add(b)
                links[b].add(a)
    out = {}
    for i in ids:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out[i] = (len(links[i]), min(seen))
    return out


def check(df, rows, **options):
    got = {r["id"]: (r["n_links"], r["component"]) for r in near_duplicates(df, 0.93, **options).collect()}
    assert got == brute(rows, 0.93)


def test_planted_groups_over_many_cells_and_blocks(spark):
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(12, 8))
    vecs = [centre[i % 12] + rng.normal(size=8) * 0.25 for i in range(400)]
    rows = {i: (i % 3 if i % 17 else None, v) for i, v in enumerate(vecs)}
    for i in range(300, 360):
        rows[i] = rows[299][0], rows[299][1]  # copies
    df = spark.createDataFrame([(i, v.tolist(), label) for i, (label, v) in rows.items()], "vec_id long, embedding array<double>, label int")
    check(df, rows, cell_rows=20, block_rows=16)
    check(df, rows)


def test_chain_is_one_group(spark):
    angle = np.arange(0, 60) * 0.3  # neighbours link, others do not
    vecs = {i: (1, np.array([np.cos(a), np.sin(a)]) * (1 + i)) for i, a in enumerate(angle[:20])}
    df = spark.createDataFrame([(i, v.tolist(), label) for i, (label, v) in vecs.items()], "vec_id long, embedding array<double>, label int")
    check(df, vecs, cell_rows=4, block_rows=3)


def test_threshold_is_inclusive(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 1), (2, [3.0, 4.0], 1)], "vec_id long, embedding array<double>, label int")
    assert {r["n_links"] for r in near_duplicates(df, 0.6).collect()} == {1}
    assert {r["n_links"] for r in near_duplicates(df, 0.6000001).collect()} == {0}


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0], 1), (2, [2.0, 4.0], 1), (2, [2.0, 4.0], 1), (3, None, 1), (4, [0.0, 0.0], 1), (5, [nan, 1.0], 1), (6, [inf, 1.0], 1),
            (7, [None, 1.0], 1), (8, [1.0, 2.0], None), (9, [1.0, 2.0], 2), (10, [1.0, 2.0, 0.0], 1), (None, [1.0, 2.0], 1), (11, [1e200, 2e200], 1), (12, [], 1)]
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], "vec_id long, embedding array<double>, label int, links int, cls string")
    got = sorted(((r["id"], r["n_links"], r["component"], r["kept"]) for r in near_duplicates(df).collect()), key=str)
    want = [(1, 2, 1, True), (2, 2, 1, False), (2, 2, 1, False), (11, 2, 1, False), (None, 0, None, True)]
    want += [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 12)]
    assert got == sorted(want, key=str)
    assert near_duplicates(df.limit(0)).collect() == []
    floats = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").withColumn("label", F.lit("one"))
    assert near_duplicates(floats).count() == floats.count()
