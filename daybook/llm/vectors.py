"""What the vector operators share: which vectors count, Arrow matrices, k-means on a sample."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vec: Column) -> Column:
    """Not null, not zero, all components finite (false also for null)."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vec.isNotNull() & finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Equal-length lists as a float64 matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):  # no chunk at all
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1) if n else np.zeros((0, 0))


def sample_rows(df: DataFrame, rows: int, total: int, seed: int, *cols: str) -> list:
    """About ``rows`` of ``total`` rows, drawn by a seeded hash of ``cols``: a bounded, repeatable sample."""
    chance = min(1.0, rows / max(1, total))
    drawn = F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(1 << 53)) / F.lit(float(1 << 53)) < chance
    return df.where(drawn).collect()


def k_means(points: np.ndarray, k: int, rounds: int, seed: int, spherical: bool = False) -> np.ndarray:
    """Centroids by Lloyd's rounds from ``k`` distinct points; ``spherical``: unit centroids, cosine."""
    points = np.unique(points, axis=0)
    rng = np.random.default_rng(seed)
    centre = points[rng.choice(len(points), min(k, len(points)), replace=False)].copy()
    for _ in range(rounds):
        near = nearest(points, centre, spherical)[0]
        sums = np.zeros_like(centre)
        np.add.at(sums, near, points)
        size = np.linalg.norm(sums, axis=1) if spherical else np.bincount(near, minlength=len(centre)).astype(float)
        full = size > 1e-12
        centre[full] = sums[full] / size[full, None]
    return centre


def nearest(points: np.ndarray, centre: np.ndarray, spherical: bool) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid of each point and the matrix of cosines or squared distances."""
    dots = points @ centre.T
    if spherical:
        return dots.argmax(1), dots
    d = (points ** 2).sum(1)[:, None] - 2 * dots + (centre ** 2).sum(1)
    return d.argmin(1), d
