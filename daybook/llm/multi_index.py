"""Approximate nearest neighbours with an inverted multi-index.

Both halves of the vectors are quantised by k-means; a row's cell is its pair of centroids. A query
walks the centroid pairs by summed distance with a heap until the cells it has seen hold the wanted
share of the index, and the rows of these cells are reranked by the exact inner product.

Nearness is the inner product, so a row gets one more component, ``sqrt(M^2 - |x|^2)`` with M the largest length,
and a query a zero: among rows of equal length M the nearest are those of the largest product.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.shared import materialise
from daybook.llm.vectors import k_means, matrix, nearest, sample_rows, usable


@dataclass
class MultiIndex:
    """``rows(id, vec, cell int)`` plus the codebooks and, per cell, its number of distinct vectors and
    the blocks its rows are dealt to (``first`` and ``blocks``)."""

    rows: DataFrame
    books: tuple[np.ndarray, np.ndarray]
    distinct: np.ndarray
    first: np.ndarray
    blocks: np.ndarray
    unit: float  # the components are divided by it, so that no square overflows
    longest: float  # of the rows, in that unit


def lengthened(x: np.ndarray, unit: float, longest: float) -> np.ndarray:
    """Rows with the component that makes their lengths equal."""
    x = x / unit
    return np.concatenate([x, np.sqrt(np.maximum(0, longest ** 2 - (x * x).sum(1)))[:, None]], axis=1)


def as_query(x: np.ndarray, unit: float, longest: float) -> np.ndarray:
    """Queries of the rows' length; theirs doesn't change the order of the products."""
    x = x / np.abs(x).max(1, keepdims=True)
    x = x * (longest / np.sqrt((x * x).sum(1, keepdims=True)))
    return np.concatenate([x, np.zeros((len(x), 1))], axis=1)


def deal(counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First block of each cell and how many it has: neighbouring cells share a block of about ``size`` rows; a larger
    cell has several of its own."""
    first, blocks, at, filled = np.zeros(len(counts), np.int64), np.ones(len(counts), np.int64), 0, 0
    for c, n in enumerate(counts.tolist()):
        if filled and filled + n > size:
            at, filled = at + 1, 0
        first[c], blocks[c] = at, max(1, -(-n // size))
        filled += n
        if blocks[c] > 1:
            at, filled = at + blocks[c], 0
    return first, blocks


def build(vectors: DataFrame, *, cell_rows: int = 50, max_centroids: int = 256, sample: int = 16_384,
          block_rows: int = 16_384, rounds: int = 12, seed: int = 3) -> MultiIndex | None:
    """Index every row of ``vectors(id, vec)`` (usable vectors of one length; null if there is none).

    The codebooks are fitted on a hash sample of about ``sample`` rows; the driver holds it and per
    cell (``max_centroids`` squared at most) two counts.
    """
    total = vectors.count()
    if not total:
        return None
    k = max(1, min(max_centroids, round(math.sqrt(total / cell_rows))))
    drawn = sample_rows(vectors, sample, total, seed, "id", "vec") or vectors.limit(1).collect()
    unit = vectors.agg(F.max(F.array_max(F.transform("vec", lambda v: F.abs(v.cast("double")))))).first()[0]
    squares = F.aggregate("vec", F.lit(0.0), lambda a, v: a + (v / F.lit(unit)) * (v / F.lit(unit)))
    longest = math.sqrt(vectors.agg(F.max(squares)).first()[0])
    points = lengthened(np.array([r["vec"] for r in drawn], np.float64), unit, longest)
    half = points.shape[1] // 2
    books = tuple(k_means(points[:, part], k, rounds, seed) if points[:, part].shape[1] else np.zeros((1, 0))
                  for part in (slice(0, half), slice(half, None)))
    width = len(books[1])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = lengthened(matrix(b.column("vec")), unit, longest)
                cell = nearest(x[:, :half], books[0], False)[0] * width + nearest(x[:, half:], books[1], False)[0]
                yield b.append_column("cell", pa.array(cell.astype(np.int32)))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vectors.schema)
    rows = materialise(vectors.mapInArrow(assign, f"{schema}, cell int"), "cells")
    counts = rows.groupBy("cell").agg(F.count("*").alias("n"), F.countDistinct(F.xxhash64("vec")).alias("d")).collect()
    cells = len(books[0]) * width
    distinct, n = np.zeros(cells, np.int64), np.zeros(cells, np.int64)
    for r in counts:
        distinct[r["cell"]], n[r["cell"]] = r["d"], r["n"]
    return MultiIndex(rows, books, distinct, *deal(n, block_rows), unit, longest)


def visited_cells(query: np.ndarray, books: tuple[np.ndarray, np.ndarray], distinct: np.ndarray, wanted: float) -> list[int]:
    """Non-empty cells by summed distance of their two centroids, until they hold ``wanted`` vectors.

    A pair enters the heap when both pairs before it (one step nearer in either half) were taken.
    """
    half, width = books[0].shape[1], len(books[1])
    d1 = nearest(query[None, :half], books[0], False)[1][0]
    d2 = nearest(query[None, half:], books[1], False)[1][0]
    o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
    d1, d2, o1, o2 = d1[o1].tolist(), d2[o2].tolist(), o1.tolist(), o2.tolist()
    heap, taken_to, seen, cells = [(d1[0] + d2[0], 0, 0)], [0] * (len(o1) + 1), 0, []
    while heap and seen < wanted:
        _, i, j = heapq.heappop(heap)
        taken_to[i] = j + 1
        cell = o1[i] * width + o2[j]
        if distinct[cell]:
            cells.append(cell)
            seen += distinct[cell]
        if i + 1 < len(o1) and taken_to[i + 1] == j:
            heapq.heappush(heap, (d1[i + 1] + d2[j], i + 1, j))
        if j + 1 < len(o2) and (i == 0 or taken_to[i - 1] > j + 1):
            heapq.heappush(heap, (d1[i] + d2[j + 1], i, j + 1))
    return cells


def search(rows: DataFrame, queries: DataFrame, k: int = 20, *, id_col: str = "vec_id", vec_col: str = "embedding",
           visit: float = 0.7, least_visited: int = 2000, query_rows: int = 2048, **index_options) -> DataFrame:
    """The ``k`` largest inner products of each query among ``rows`` but the query's own id.

    Returns ``query_id, rank int, vec_id, score double``, nearest first, ties to the smaller id; fewer
    rows where there are fewer candidates. The score is the sum of the components' products in double
    precision, added from the first to the last. Vectors that are null, zero or hold null or
    non-finite components, rows with a null id and vectors whose length is not the most frequent one
    take no part. A row repeated as it is counts once; a query id that comes with several vectors
    asks with the smallest of them.

    ``visit`` is the share of the distinct vectors a query sees, ``least_visited`` a number it sees at
    least: vectors without structure need a large share for a recall of 0.9, clustered ones a small
    one. Copies do not count, so a hot group does not use a query's share up. A task compares one
    block of rows with one chunk of queries; both are bounded. Queries of neighbouring cells share a chunk, and a
    block goes only to the chunks that have a query which sees it.
    """
    def fit(df: DataFrame) -> DataFrame:
        df = df.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"))
        return df.where(F.col("id").isNotNull() & usable(F.col("vec")))

    spark = rows.sparkSession
    id_type = rows.schema[id_col].dataType.simpleString()
    empty = spark.createDataFrame([], f"query_id {id_type}, rank int, vec_id {id_type}, score double")
    known = materialise(fit(rows).distinct(), "vectors")
    dim = known.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if dim is None:
        return empty
    index = build(known.where(F.size("vec") == dim["dim"]), **index_options)
    asked = fit(queries).where(F.size("vec") == dim["dim"]).groupBy("id").agg(F.min("vec").alias("vec"))
    asked = materialise(asked, "queries")
    books, distinct, first, blocks, unit, longest = index.books, index.distinct, index.first, index.blocks, index.unit, index.longest
    width = len(books[1])
    half = books[0].shape[1]

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = as_query(matrix(b.column("vec")), unit, longest)
                cell = nearest(x[:, :half], books[0], False)[0] * width + nearest(x[:, half:], books[1], False)[0]
                yield b.append_column("home", pa.array(cell.astype(np.int32)))

    vec_type = known.schema["vec"].dataType.simpleString()
    asked = materialise(asked.mapInArrow(home, f"id {id_type}, vec {vec_type}, home int"), "homes")
    homes = np.zeros(len(distinct), np.int64)
    for r in asked.groupBy("home").count().collect():  # one number for each cell at most
        homes[r["home"]] = r["count"]
    first_chunk, own_chunks = deal(homes, query_rows)
    wanted = max(least_visited, visit * int(distinct.sum())) + 1  # the query's own vector may be among them

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                row, block, cells = [], [], []
                for i, q in enumerate(as_query(matrix(part.column("vec")), unit, longest)):
                    at: dict[int, list[int]] = {}
                    for c in visited_cells(q, books, distinct, wanted):
                        for n in range(first[c], first[c] + blocks[c]):
                            at.setdefault(n, []).append(c)
                    row += [i] * len(at)
                    block += at
                    cells += at.values()
                at_home, spread = part.column("home").to_numpy(), part.column("spread").to_numpy()
                chunk = (first_chunk[at_home] + spread % own_chunks[at_home]).astype(np.int32)
                out = part.take(pa.array(row, pa.int32()))
                yield pa.RecordBatch.from_arrays([out.column("id"), out.column("vec"), pa.array(block, pa.int32()),
                                                  pa.array(cells, pa.list_(pa.int32())), pa.array(chunk[np.array(row, np.int64)])],
                                                 ["id", "vec", "block", "cells", "chunk"])

    tasks = max(-(-int(homes.sum()) // query_rows), spark.sparkContext.defaultParallelism)
    walks = asked.withColumn("spread", F.xxhash64("id")).repartition(tasks, "id").mapInArrow(
        walk, f"id {id_type}, vec {vec_type}, block int, cells array<int>, chunk int")
    walks = materialise(walks, "walks")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cell = b.column("cell").to_numpy()
            spread = b.column("spread").to_numpy()
            yield b.append_column("block", pa.array((first[cell] + spread % blocks[cell]).astype(np.int32))).drop_columns(["spread"])

    placed = index.rows.withColumn("spread", F.xxhash64("id")).mapInArrow(place, f"id {id_type}, vec {vec_type}, cell int, block int")
    placed = placed.join(materialise(walks.select("block", "chunk").distinct(), "pairs"), "block")

    def rerank(queries: pa.Table, rows: pa.Table) -> pa.Table:
        ids, x, cell = rows.column("id").to_numpy(), matrix(rows.column("vec")), rows.column("cell").to_numpy()
        asked_by, q = queries.column("id").to_numpy(), matrix(queries.column("vec"))
        local, at = np.unique(cell, return_inverse=True)
        out: list[tuple] = [(asked_by[:0], ids[:0], np.zeros(0))]
        cells_of = queries.column("cells").to_pylist()
        for lo in range(0, len(q) if len(ids) else 0, 256):
            part = q[lo:lo + 256]
            sees = np.stack([np.isin(local, c) for c in cells_of[lo:lo + 256]])
            dots = part @ x.T
            slack = 1e-9 * np.abs(dots).max(initial=1e-300)
            dots[~sees[:, at] | (asked_by[lo:lo + 256, None] == ids[None, :])] = -np.inf
            kth = -np.partition(-dots, min(k, len(ids)) - 1, axis=1)[:, min(k, len(ids)) - 1]
            i, j = np.nonzero((dots >= kth[:, None] - slack) & np.isfinite(dots))
            for a in range(0, len(i), 100_000):  # the exact measure, summed in order
                bi, bj = i[a:a + 100_000], j[a:a + 100_000]
                score = np.cumsum(part[bi] * x[bj], axis=1)[:, -1]
                out.append((asked_by[lo + bi], ids[bj], score))
        query, vec, score = (np.concatenate(c) for c in zip(*out, strict=True))
        order = np.lexsort((vec, -score, query))
        query, vec, score = query[order], vec[order], score[order]
        start = np.searchsorted(query, query)
        top = np.arange(len(query)) - start < k
        return pa.table({"query_id": pa.array(query[top]), "vec_id": pa.array(vec[top]), "score": pa.array(score[top])})

    found = walks.groupBy("block", "chunk").cogroup(placed.groupBy("block", "chunk")).applyInArrow(
        rerank, f"query_id {id_type}, vec_id {id_type}, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
