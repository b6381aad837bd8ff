"""Embedding near-duplicates: spherical k-means cells, blocked cosine products, one vector per group."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.shared import connected_components, local_components, materialise
from daybook.llm.vectors import k_means, matrix, nearest, sample_rows, usable


def _unit(x: np.ndarray) -> np.ndarray:
    big = np.abs(x).max(1, keepdims=True)  # so that squares neither overflow nor vanish
    x = x / big
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _cells(classes: DataFrame, threshold: float, cell_rows: int, max_cells: int, sample: int, seed: int) -> DataFrame:
    """Each class at its home cell and, as a guest, at every cell that could hold a partner of it.

    x has its home where its cosine is largest. If y is homed at c and its partner x at d, then x lies on
    d's side of the plane between c and d, so the angle of y to that plane is at most the angle of the
    pair: ``y.c - y.d <= |c - d| * sin(angle)``. Guests are sent to all such d, so no pair is lost.
    """
    sizes = classes.groupBy("label", "dim").count().where(F.col("count") > cell_rows)
    large = sizes.orderBy(F.desc("count")).limit(max_cells // 2).collect()
    total = sum(r["count"] for r in large)
    centres: dict = {}
    if large:
        inside = classes.join(F.broadcast(sizes.sparkSession.createDataFrame(large, sizes.schema).drop("count")), ["label", "dim"])
        drawn = sample_rows(inside.select("label", "dim", "vec", "first"), sample, total, seed, "first")
        for r in large:
            k = min(-(-r["count"] // cell_rows), max(1, max_cells * r["count"] // total))
            points = [x["vec"] for x in drawn if (x["label"], x["dim"]) == (r["label"], r["dim"])]
            if k > 1 and len(points) > 2 * k:
                centres[r["label"], r["dim"]] = k_means(_unit(np.array(points, np.float64)), k, 12, seed, True)
    slope = np.sqrt(1 - threshold ** 2) if threshold > 0 else 1.0

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = pa.Table.from_batches([b])
            label, dim = t.column("label").to_pylist(), t.column("dim").to_pylist()
            row, cell, home = [], [], []
            for key in set(zip(label, dim, strict=True)):
                own = np.array([i for i, x in enumerate(zip(label, dim, strict=True)) if x == key])
                c = centres.get(key)
                if c is None:
                    row, cell, home = [*row, own], [*cell, np.zeros(len(own), np.int64)], [*home, np.ones(len(own), bool)]
                    continue
                at, cos = nearest(_unit(matrix(t.column("vec").take(pa.array(own)))), c, True)
                apart = np.sqrt(np.maximum(0, 2 - 2 * c @ c.T))
                lead = cos[np.arange(len(own)), at][:, None] - cos
                i, d = np.nonzero(lead <= apart[at] * slope + 1e-9)
                row, cell, home = [*row, own[i]], [*cell, d], [*home, d == at[i]]
            if row:
                out = t.take(pa.array(np.concatenate(row)))
                out = out.append_column("cell", pa.array(np.concatenate(cell).astype(np.int32)))
                yield from out.append_column("home", pa.array(np.concatenate(home))).to_batches()

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema)
    return classes.mapInArrow(assign, f"{schema}, cell int, home boolean")


def near_duplicates(rows: DataFrame, threshold: float = 0.93, *, id_col: str = "vec_id", vec_col: str = "embedding",
                    label_col: str = "label", cell_rows: int = 2048, block_rows: int = 2048, max_cells: int = 1024,
                    sample: int = 32_768, seed: int = 5) -> DataFrame:
    """Links and group of every vector: ``id, n_links long, component, kept``.

    Vectors link when their labels are equal and not null and their cosine, in double precision, is at
    least ``threshold``. Vectors that are null, zero or hold null or non-finite components link with
    nothing, nor do vectors of different length or rows with a null id. Equal vectors of a label are
    one class: its copies are counted, not compared. A row repeated as it is counts once. An id that
    comes with several vectors is one node of the groups; its links are those of all its vectors.

    Every pair is found (guests at neighbouring cells, see ``_cells``). How many guests there are
    depends on the data: on vectors without any structure nearly all cells need all vectors. A cell is
    cut into blocks of ``block_rows``, each pair of blocks is one task's matrix product, and of its links only
    counts and a spanning forest leave the task. The driver holds a sample of about ``sample`` vectors
    and ``max_cells`` centroids at most.
    """
    src = rows.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vec_col).alias("vec"))
    fit = src.where(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vec")))
    classes = materialise(fit.groupBy("label", "vec").agg(F.min("id").alias("first"), F.countDistinct("id").alias("copies"))
                          .withColumn("dim", F.size("vec")).withColumn("cls", F.xxhash64("label", "vec")), "vector_classes")
    cells = materialise(_cells(classes.repartition("first"), threshold, cell_rows, max_cells, sample, seed), "cells")
    unit = ["label", "dim", "cell"]
    sizes = cells.groupBy(unit).agg(F.ceil(F.count(F.when(F.col("home"), 1)) / block_rows).cast("int").alias("home_blocks"),
                                    F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"), F.count("*").alias("n"))
    sizes = materialise(sizes.where("n > 1 and home_blocks > 0").drop("n"), "cell_sizes")
    dealt = cells.join(sizes, unit).withColumn("h", F.xxhash64("first", "cls"))

    def side(name: str, own: str, other: str, mine: str, theirs: str) -> DataFrame:
        return dealt.withColumn(mine, F.pmod("h", F.col(own)).cast("int")) \
            .withColumn(theirs, F.explode(F.sequence(F.lit(0), F.col(other) - 1))) \
            .select(*unit, "i", "j", F.lit(name).alias("side"), "first", "cls", "copies", "vec", "home")

    units = side("home", "home_blocks", "blocks", "i", "j").where("home") \
        .union(side("all", "blocks", "home_blocks", "j", "i")).drop("home")

    def compare(table: pa.Table) -> pa.Table:
        is_home = np.array([x == "home" for x in table.column("side").to_pylist()])
        ids, cls = table.column("first").to_numpy(), table.column("cls").to_numpy()
        copies, vecs = table.column("copies").to_numpy(), matrix(table.column("vec"))
        a, b = np.nonzero(is_home)[0], np.nonzero(~is_home)[0]
        unit = _unit(vecs)
        nodes, node = np.unique(ids, return_inverse=True)
        links, u, v = np.zeros(len(ids), np.int64), [], []
        other = unit[b].T
        for lo in range(0, len(a), 512):
            cos = unit[a[lo:lo + 512]] @ other
            for i, j in zip(*np.nonzero(np.abs(cos - threshold) < 1e-12), strict=True):  # the measure itself decides
                x, y = vecs[a[lo + i]], vecs[b[j]]
                cos[i, j] = (x @ y) / (np.sqrt(x @ x) * np.sqrt(y @ y))
            i, j = np.nonzero(cos >= threshold)
            i, j = a[lo + i], b[j]
            real = cls[i] != cls[j]
            i, j = i[real], j[real]
            np.add.at(links, i, copies[j])
            u.append(node[i])
            v.append(node[j])
        root = local_components(len(nodes), np.concatenate([*u, []]).astype(int), np.concatenate([*v, []]).astype(int))
        out = np.nonzero((links > 0) | (root[node] != node))[0]
        return pa.table({"first": pa.array(ids[out]), "cls": pa.array(cls[out]), "links": pa.array(links[out]),
                         "root": pa.array(nodes[root[node[out]]])})

    id_type = src.schema["id"].dataType.simpleString()
    found = materialise(units.groupBy(*unit, "i", "j").applyInArrow(
        compare, f"first {id_type}, cls long, links long, root {id_type}"), "links")
    # an id that is a member of several classes ties them together
    member_of = fit.select("id", F.xxhash64("label", "vec").alias("cls")).distinct()
    named = member_of.join(classes.select("cls", "first", "copies"), "cls")
    ties = named.where("id <> first").select(F.col("id").alias("u"), F.col("first").alias("v"))
    groups = connected_components(found.select(F.col("first").alias("u"), F.col("root").alias("v")).union(ties))
    per_class = found.groupBy("first", "cls").agg(F.sum("links").alias("links"))
    counted = named.join(per_class.select("cls", "links"), "cls", "left").groupBy("id").agg(
        F.sum(F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"))
    result = src.select("id").join(counted, "id", "left").join(groups, F.col("id") == F.col("node"), "left")
    component = F.coalesce("component", "id")
    return result.select("id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component"),
                         F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
