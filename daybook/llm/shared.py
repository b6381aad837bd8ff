"""Helpers of the operators: shared scratch tables, connected components, word patterns."""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Only a single-JVM session (``local[...]``, as in tests) that has none gets one of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir is not set: the operators need a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="daybook-llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


#: Scratch tables of the open scopes; each thread has its own.
_SCOPES: contextvars.ContextVar[tuple[list[str], ...]] = contextvars.ContextVar("scopes", default=())


def scratch_path(spark: SparkSession, name: str) -> str:
    root = f"{shared_folder(spark)}/daybook-llm-{uuid.uuid4().hex}"
    if scopes := _SCOPES.get():
        scopes[-1].append(root)
    return f"{root}/{name}"


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the scratch tables made inside once the block is left: put the write of the result in the
    block, as its plan reads them. Without a scope they stay in the shared folder (``daybook-llm-*``)."""
    made: list[str] = []
    token = _SCOPES.set((*_SCOPES.get(), made))
    try:
        yield
    finally:
        _SCOPES.reset(token)
        for root in made:
            remove(spark, root)


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back: lineage is cut, an
    executor that is lost takes nothing with it, and later plans know the table's size."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Bound what a Python worker and its executor hold at once: whole texts come in Arrow batches of
    ``rows`` records, where Spark's default would gather 10,000. A number the session chose itself stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(rows))


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node number reachable from each of ``n`` nodes over the links ``a[i] - b[i]``."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(u long, v long)`` -> ``(node, component)``, component = smallest node of its class.

    Alternating large-star and small-star rounds, each one aggregate and one join; every round is a
    written table. A node's neighbours are never gathered: only their minimum is (partial aggregate),
    and the join back on a hot node is one that AQE can split. Nodes without links are not returned.
    """
    spark = edges.sparkSession
    cur = materialise(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = None
    while True:
        found = cur.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(found) == state or found[0] == 0:
            break
        state = tuple(found)
        both = cur.union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # a join straight on an aggregate cannot be split by AQE where one node has many of the links
        low = materialise(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "large_low")
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialise(large.where("u <> v"), "large_star")
        low = materialise(large.groupBy("u").agg(F.min("v").alias("m")), "small_low")
        small = large.join(low, "u").select(F.col("v").alias("a"), "m").union(low.select(F.col("u").alias("a"), "m"))
        cur = materialise(small.where("a <> m").select(F.col("a").alias("u"), F.col("m").alias("v")).distinct(), "small_star")
    roots = cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return materialise(cur.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots), "components")
