"""SimHash near-duplicates by segment bit counts.

A 64-bit fingerprint is cut into 32 segments of two bits; the bit counts of its segments are a point
in {0, 1, 2}^32 whose Manhattan distance to another fingerprint's point is a lower bound of the bit
distance. Two points within distance 4 are within distance 2 in one half of the dimensions (or in both), and
then a grid point of that half lies within distance 1 of both. So every fingerprint is entered
in both half-grids at its own cell and at the cells one step away, which makes the range join an
equality join on cells; inside a cell the lower bound and then the exact bit distance are checked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.shared import connected_components, local_components, materialise, text_batches

SEED = 42
HASHES_AT_ONCE = 1 << 17


def _shingle_hashes(text: str | None, words_per_shingle: int) -> list[int]:
    """XXH64 of each shingle of the text's words; fewer words: of the whole sequence; none: nothing."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return []
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    k = min(words_per_shingle, len(words))
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - k + 1]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends[k - 1:].tolist())]


_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).view(np.uint64).ravel()


def _bit_sums(hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Per text, how often each of the 64 bits (bit 63 first) is set in its run of hashes.

    A byte becomes eight byte-wide counters in one integer; 255 of these are added without overflow.
    """
    sums = np.zeros((len(lengths), 64), np.int64)
    pieces = -(-lengths // 255)
    own = np.repeat(np.arange(len(lengths)), pieces)
    nth = np.arange(len(own)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    starts = np.repeat(np.cumsum(lengths) - lengths, pieces) + 255 * nth
    octets = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
    if len(own):
        counted = np.add.reduceat(_LANES[octets], starts, axis=0).view(np.uint8).reshape(-1, 64)
        np.add.at(sums, own, counted)
    return sums


def fingerprints_of(texts: list[str | None], words_per_shingle: int) -> np.ndarray:
    """The texts' fingerprints: a bit is 1 if set in over half of the shingles' hashes."""
    out = np.zeros(len(texts), np.uint64)
    done, hashes, lengths = 0, [], []

    def flush(upto: int) -> None:
        nonlocal done, hashes, lengths
        counts = np.array(lengths, np.int64)
        set_bits = _bit_sums(np.array(hashes, np.uint64), counts) * 2 > counts[:, None]
        out[done:upto] = np.packbits(set_bits, axis=1).view(">u8").ravel()
        done, hashes, lengths = upto, [], []

    for i, text in enumerate(texts):
        h = _shingle_hashes(text, words_per_shingle)
        hashes += h
        lengths.append(len(h))
        if len(hashes) >= HASHES_AT_ONCE:
            flush(i + 1)
    if lengths:
        flush(len(texts))
    return out


def fingerprints(docs: DataFrame, id_col: str, text_col: str, words_per_shingle: int) -> DataFrame:
    """``(id, th long, fp long)`` of every record; th is a hash of its text."""
    text_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            step = 256  # texts may be long
            for lo in range(0, b.num_rows, step):
                part = b.slice(lo, step)
                fp = fingerprints_of(part.column(2).to_pylist(), words_per_shingle).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(fp)], ["id", "th", "fp"])

    text = F.col(text_col).cast("string")
    src = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))
    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, th bigint, fp bigint")


def segment_counts(fp: np.ndarray) -> np.ndarray:
    """Bit counts of the 32 two-bit segments, one row of uint8 per fingerprint."""
    bits = np.unpackbits(fp.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return bits[:, 0::2] + bits[:, 1::2]


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each fingerprint's cells: per half of the dimensions, its own and those one step away.

    A cell is the half's number and its 16 counts in base 3, as one integer.
    """
    power = 3 ** np.arange(16, dtype=np.int64)
    for b in batches:
        whole = b.column(0).to_numpy(zero_copy_only=False)
        for lo in range(0, len(whole), 20_000):
            fp = whole[lo:lo + 20_000]
            counts = segment_counts(fp.view(np.uint64)).astype(np.int64)
            cells, own = [], []
            for half in (0, 1):
                c = counts[:, 16 * half:16 * half + 16]
                base = c @ power + half * 3 ** 16
                cells.append(base)
                own.append(np.arange(len(fp)))
                for step in (1, -1):
                    i, d = np.nonzero((c + step >= 0) & (c + step <= 2))
                    cells.append(base[i] + step * power[d])
                    own.append(i)
            own = np.concatenate(own)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(cells)), pa.array(fp[own])], ["cell", "fp"])


def _links(a: np.ndarray, b: np.ndarray, max_bits: int, rows: int = 512) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs within ``max_bits``, in blocks: first the lower bound, then the exact distance."""
    ca, cb = segment_counts(a).astype(np.int16), segment_counts(b).astype(np.int16)
    ta, tb = ca.sum(1), cb.sum(1)
    order = np.argsort(tb, kind="stable")  # the total count alone is a bound as well: only a band is compared
    sorted_tb = tb[order]
    for lo in range(0, len(a), rows):
        near = order[np.searchsorted(sorted_tb, ta[lo:lo + rows].min() - max_bits):
                     np.searchsorted(sorted_tb, ta[lo:lo + rows].max() + max_bits, side="right")]
        for at in range(0, len(near), 4096):
            cols = near[at:at + 4096]
            x = a[lo:lo + rows, None] ^ b[None, cols]
            # bit counts of the segments differ by |d|; their sum is at most the popcount of the xor,
            # and the popcount is one instruction, so both checks are one comparison here
            i, j = np.nonzero(np.bitwise_count(x) <= max_bits)
            bound = np.abs(ca[lo + i] - cb[cols[j]]).sum(1) <= max_bits
            yield lo + i[bound], cols[j[bound]]


def near_links(classes: DataFrame, max_bits: int, block_rows: int) -> DataFrame:
    """Links ``(u, v)`` between distinct fingerprints ``classes(fp)`` that span the same groups as all
    pairs within ``max_bits`` do: of each cell's links only a spanning forest is returned.

    A cell of more than ``block_rows`` fingerprints is cut into blocks by hash and every pair of blocks is
    compared in a task of its own. The cells to cut are found in a 1/16 sample of the fingerprints; which
    cells are cut changes the size of tasks and never the links.
    """
    entries = classes.select("fp").mapInArrow(_cells, "cell long, fp long")
    sampled = classes.where(F.pmod(F.xxhash64("fp"), F.lit(16)) == 0).select("fp").mapInArrow(_cells, "cell long, fp long")
    hot = materialise(sampled.groupBy("cell").count().where(F.col("count") * 16 > block_rows)
                      .select("cell", F.ceil(F.col("count") * 16 / block_rows).cast("int").alias("blocks")), "hot_cells")
    # with no cell to cut, the join below is planned against an empty table and costs nothing
    dealt = entries.join(hot, "cell", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("blocks")).cast("int")
    units = (dealt.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("cell", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "fp"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []

        def forest(rows: np.ndarray) -> pa.RecordBatch:
            u, v = _unit_links(rows, max_bits)
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

        for b in batches:
            rows = np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns])
            if not len(rows):
                continue
            ends = np.nonzero((rows[1:, :3] != rows[:-1, :3]).any(1))[0] + 1
            if kept and (kept[-1][-1, :3] != rows[0, :3]).any():
                yield forest(np.concatenate(kept))
                kept = []
            if len(ends):  # the last unit may go on in the next batch; a unit has two blocks at most
                yield forest(np.concatenate([*kept, rows[:ends[-1]]]))
                kept = []
            kept.append(rows[ends[-1] if len(ends) else 0:])
        if kept:
            yield forest(np.concatenate(kept))

    dealt = units.select("cell", "i", "j", F.col("own").cast("long").alias("own"), "fp").repartition("cell", "i", "j")
    return dealt.sortWithinPartitions("cell", "i", "j").mapInArrow(compare, "u long, v long")


def _unit_links(rows: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of sorted rows ``(cell, i, j, own, fp)``: per unit a spanning forest of its close pairs."""
    starts = np.concatenate(([0], np.nonzero((rows[1:, :3] != rows[:-1, :3]).any(1))[0] + 1, [len(rows)]))
    sizes = np.diff(starts)
    small = np.repeat((sizes > 1) & (sizes <= 16), sizes)
    unit = np.repeat(np.arange(len(sizes)), sizes)[small]
    fp = rows[small, 4]
    bits, counts = fp.view(np.uint64), segment_counts(fp.view(np.uint64)).astype(np.int16)
    found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    for gap in range(1, int(sizes[sizes <= 16].max(initial=1))):  # neighbours at this distance in the sorted run
        a = np.nonzero(unit[gap:] == unit[:-gap])[0]
        a = a[np.abs(counts[a] - counts[a + gap]).sum(1) <= max_bits]  # lower bound
        a = a[np.bitwise_count(bits[a] ^ bits[a + gap]) <= max_bits]
        found.append((fp[a], fp[a + gap]))
    for k in np.nonzero(sizes > 16)[0]:
        part = rows[starts[k]:starts[k + 1]]
        fp = np.ascontiguousarray(part[:, 4])
        left, right = np.nonzero(part[:, 3] == part[:, 1])[0], np.nonzero(part[:, 3] == part[:, 2])[0]
        bits, root = fp.view(np.uint64), np.arange(len(fp))
        for a, b in _links(bits[left], bits[right], max_bits):
            a, b = left[a], right[b]
            joins = root[a] != root[b]  # only links that join two groups found so far
            if joins.any():
                root = local_components(len(fp), np.concatenate([np.arange(len(fp)), a[joins]]),
                                        np.concatenate([root, b[joins]]))
        linked = np.nonzero(root != np.arange(len(fp)))[0]
        found.append((fp[linked], fp[root[linked]]))
    return np.concatenate([u for u, _ in found]), np.concatenate([v for _, v in found])


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 4,
                    max_bits: int = 4, block_rows: int = 4096) -> DataFrame:
    """Fingerprint and group of every record: ``id, th long, fp long, component, root long``: hash of the
    text, fingerprint, smallest id reachable, and one fingerprint that names the group (ids may repeat).

    A-Z are lower-cased; words are runs without white space; a text without words (null, empty) has
    fingerprint zero, which links like any other. Copies share a fingerprint, so links are
    searched between distinct fingerprints only. Repeated rows are records of their own; a null id is
    never the smallest unless all ids of its group are null; no records give no rows.
    ``max_bits`` may be 4 at most (the grid's step).
    """
    if not 0 <= max_bits <= 4:
        raise ValueError("the grid serves distances up to 4 bits")
    printed = materialise(fingerprints(docs, id_col, text_col, words_per_shingle), "fingerprints")
    classes = materialise(printed.groupBy("fp").agg(F.min("id").alias("first")), "classes")
    found = connected_components(near_links(classes, max_bits, block_rows))
    grouped = classes.join(found, classes["fp"] == found["node"], "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("root"))
    smallest = grouped.groupBy("root").agg(F.min("first").alias("component"))
    named = materialise(grouped.join(smallest, "root").select("fp", "component", "root"), "named")
    return printed.join(named, "fp").select("id", "th", "fp", "component", "root")


def keep_one(docs: DataFrame, found: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each group of ``found`` (``near_duplicates``) the record with the smallest id, with all its
    columns; of a group's rows that share this id one stays. An id that comes with several texts is
    looked up by id and text, so each text stands for its own group. Records with a null id stay."""
    kept = found.where("id is not null and id = component").groupBy("root", F.col("id").alias("__id")).agg(F.min("th").alias("__kept"))
    # the list grows with the documents: one sort-merge join at every size, whose order dropDuplicates uses
    kept = materialise(kept.select("__id", "__kept"), "kept").hint("merge")
    named = docs.where(F.col(id_col).isNotNull()).withColumn("__th", F.xxhash64(F.col(text_col).cast("string")))
    on = (named[id_col] == kept["__id"]) & (named["__th"] == kept["__kept"])
    left = named.join(kept, on).drop("__id", "__kept").dropDuplicates([id_col, "__th"])
    return left.select(*docs.columns).union(docs.where(F.col(id_col).isNull()))
