"""Line dedup by winnowing: repeated runs of lines are found by guaranteed fingerprints and deleted.

The non-blank lines of a document are a sequence of hashes. Of every window of ``run_lines`` lines the
smallest hash is selected, so two runs of that many equal lines always select the same line, wherever
they stand. Selected lines whose hash occurs once in the corpus end there. Around the others the match is
extended both ways: every window of lines through the selected line is compared by a 128-bit hash
with its first occurrence in the corpus. The later windows that equal it, laid over each other, are the
maximal repeated runs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.shared import materialise, text_batches

WINDOW = "array<struct<start:int,len:int,k1:long,k2:long>>"


def selected_windows(hashes: list[int], words: list[int], run_lines: int, run_words: int) -> dict[int, list[tuple[int, int]]]:
    """Selected line -> the windows ``(start, length)`` it stands for.

    A window of ``run_lines`` lines selects its smallest hash (the last of equal ones), and so do two
    neighbours of less than ``run_words`` words each that hold as many together; a line of ``run_words``
    words is a window of its own.
    """
    out: dict[int, list[tuple[int, int]]] = {}
    at = -1
    for start in range(len(hashes) - run_lines + 1):
        end = start + run_lines
        if at < start:
            at = min(range(start, end), key=lambda i: (hashes[i], -i))
        elif hashes[end - 1] <= hashes[at]:
            at = end - 1
        out.setdefault(at, []).append((start, run_lines))
    for i, n in enumerate(words):
        if n >= run_words:
            out.setdefault(i, []).append((i, 1))
    if run_lines > 2:  # shorter runs cover every two lines as it is
        for i, (a, b) in enumerate(pairwise(words)):
            if a + b >= run_words > max(a, b):
                out.setdefault(i if hashes[i] < hashes[i + 1] else i + 1, []).append((i, 2))
    return out


def _positions(docs: DataFrame, run_lines: int, run_words: int) -> DataFrame:
    """``docs(id, th, text)`` -> ``(id, th, fp long, windows)``, one row per selected line."""
    windows = pa.struct([("start", pa.int32()), ("len", pa.int32()), ("k1", pa.int64()), ("k2", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                part = b.slice(lo, 1024)
                rows, fps, spans, keys, bounds = [], [], [], [], [0]
                for i, text in enumerate(part.column("text").to_pylist()):
                    lines = [x for x in map(bytes.strip, text.encode("utf-8", "surrogatepass").split(b"\n")) if x] if text else []
                    hashes = [xxhash.xxh64_intdigest(x) for x in lines]
                    words = [len(x.split()) for x in lines]
                    packed = np.array(hashes, ">u8").tobytes()
                    for at, wins in selected_windows(hashes, words, run_lines, run_words).items():
                        rows.append(i)
                        fps.append(hashes[at])
                        spans += wins
                        keys += [xxhash.xxh128_digest(packed[8 * s:8 * (s + n)]) for s, n in wins]
                        bounds.append(len(spans))
                span = np.array(spans, np.int32).reshape(-1, 2)
                key = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
                items = pa.StructArray.from_arrays([pa.array(c) for c in (span[:, 0], span[:, 1], key[:, 0], key[:, 1])], fields=list(windows))
                who = part.select(["id", "th"]).take(pa.array(rows, pa.int32()))  # not the texts
                yield pa.RecordBatch.from_arrays(
                    [who.column("id"), who.column("th"), pa.array(np.array(fps, np.uint64).view(np.int64)),
                     pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), items)], ["id", "th", "fp", "windows"])

    return docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, th long, fp long, windows {WINDOW}")


@F.pandas_udf(T.StructType().add("text", "string").add("removed", "integer"))
def _without(texts: pd.Series, runs: pd.Series) -> pd.DataFrame:
    """The text without the non-blank lines that the runs cover; empty if no other line is left."""
    out, removed = [], []
    for text, spans in zip(texts, runs, strict=True):
        if text is None:
            out.append(None)
            removed.append(0)
            continue
        drop = {i for r in spans for i in range(r["start"], r["start"] + r["len"])}
        kept, at, any_left = [], 0, False
        for line in text.split("\n"):
            if not line.encode("utf-8", "surrogatepass").strip():
                kept.append(line)
                continue
            if at not in drop:
                kept.append(line)
                any_left = True
            at += 1
        out.append("\n".join(kept) if any_left else "")
        removed.append(len(drop))
    return pd.DataFrame({"text": out, "removed": pd.array(removed, "int32")})


def repeated_runs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", run_lines: int = 3,
                  run_words: int = 50) -> DataFrame:
    """``id, th`` (hash of the text) and ``runs`` (array of start and length in non-blank lines) of the
    documents that repeat something earlier.

    A run is repeated if it is ``run_lines`` consecutive non-blank lines, one line of ``run_words``
    words, or two consecutive lines of fewer words each that hold ``run_words`` together, and it occurs
    before: in a document with a smaller id, or further up in the same one. Lines are compared without
    white space at their ends. Blank lines are no lines.
    """
    text_batches(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    at = materialise(_positions(src, run_lines, run_words), "selected_lines")
    # Both lists are tables of their own: a join straight on an aggregate cannot be split by AQE where one
    # passage holds many of the rows. They grow with the documents, so the plan is a merge at every size.
    repeated = materialise(at.groupBy("fp").count().where("count > 1").select("fp"), "repeated").hint("merge")
    windows = materialise(
        at.join(repeated, "fp", "left_semi").select("id", "th", F.explode("windows").alias("w")).select("id", "th", "w.*").distinct(),
        "windows")
    place = F.struct("id", "th", "start")
    first = windows.groupBy("k1", "k2", "len").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    first = materialise(first, "first_windows").hint("merge")
    later = windows.join(first, ["k1", "k2", "len"]).where(~place.eqNullSafe(F.col("first")))
    # a document's windows are at most its lines, so this list is bounded by the document
    return later.groupBy("id", "th").agg(F.sort_array(F.collect_list(F.struct("start", "len"))).alias("runs"))


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", removed_col: str = "lines_removed",
                run_lines: int = 3, run_words: int = 50) -> DataFrame:
    """The documents, all rows and columns, without the repeated runs of their texts (see
    ``repeated_runs``), plus ``removed_col`` (int). A column of that name is replaced.

    The first occurrence stays, by (id, hash of the text, line), null ids first. A document of which
    no non-blank line is left has an empty text. A row repeated as it is (id and text) counts once, and every
    copy of it is treated alike. Null and empty texts come back as they are; so do texts without repetition.
    """
    runs = materialise(repeated_runs(docs, id_col=id_col, text_col=text_col, run_lines=run_lines, run_words=run_words), "runs")
    runs = runs.select(F.col("id").alias("__id"), F.col("th").alias("__th"), F.col("runs").alias("__runs"))
    runs = runs.hint("merge")  # it grows with the documents: the same plan at every size
    base = docs.drop(removed_col) if removed_col in docs.columns else docs
    joined = base.withColumn("__h", F.xxhash64(text_col)).join(
        runs, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__h") == F.col("__th")), "left")
    cleaned = joined.withColumn("__new", _without(F.when(F.col("__runs").isNotNull(), F.col(text_col)), "__runs"))
    text = F.when(F.col("__runs").isNotNull(), F.col("__new.text")).otherwise(F.col(text_col))
    return cleaned.select(*[text.alias(c) if c == text_col else F.col(c) for c in base.columns],
                          F.when(F.col("__runs").isNotNull(), F.col("__new.removed")).otherwise(F.lit(0)).alias(removed_col))
