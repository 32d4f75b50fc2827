"""Distance, moment and array expressions, and Arrow batch helpers for long vectors.

The expressions suit short vectors and small tables (cluster summaries). Scans over all points use
the Arrow helpers: a batch of vectors becomes one matrix without a copy per row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def total(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0.0), lambda acc, x: acc + x)


def euclidean(x: Column, y: Column) -> Column:
    return F.sqrt(total(F.zip_with(x, y, lambda a, b: (a - b) * (a - b))))


def array_of(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def add_powers(x: Column, y: Column, power: int = 1) -> Column:
    """x[i] + y[i] ** power for every dimension."""
    return F.zip_with(x, y, lambda a, b: a + (b if power == 1 else F.pow(b, F.lit(float(power)))))


def mean_of(n: Column, sums: Column) -> Column:
    return F.transform(sums, lambda s: s / n)


def deviation_of(n: Column, sums: Column, sumsq: Column) -> Column:
    """Standard deviation per dimension from moments; rounding below zero counts as zero."""
    return F.zip_with(sums, sumsq, lambda s, q: F.sqrt(F.greatest(q / n - (s / n) * (s / n), F.lit(0.0))))


def mahalanobis(x: Column, centre: Column, deviation: Column) -> Column:
    """Diagonal Mahalanobis distance; a dimension without spread adds its plain difference."""
    gaps = F.zip_with(x, centre, lambda a, c: a - c)
    scaled = F.zip_with(gaps, deviation, lambda g, s: F.when(s == 0, g * g).otherwise((g / s) * (g / s)))
    return F.sqrt(total(scaled))


def gate(dimensions: int) -> float:
    """Three standard deviations over all dimensions: 3 * sqrt(d)."""
    return 3.0 * float(np.sqrt(dimensions))


def as_matrix(vectors: pa.Array) -> np.ndarray:
    """A batch of equally long vectors of numbers as a (rows, dimensions) matrix.

    A null vector, a null or NaN entry, and vectors of different lengths are errors: distances to them
    have no meaning, and leaving them out here would shift the rows after them.
    """
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    rows = len(vectors)
    if not rows:
        return np.zeros((0, 0))
    flat = vectors.flatten()
    lengths = vectors.value_lengths()
    if vectors.null_count or flat.null_count or len(lengths.unique()) > 1:
        raise ValueError("vectors must be complete and equally long")
    flat = flat.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    if np.isnan(flat).any():
        raise ValueError("vectors must hold numbers only")
    return flat.reshape(rows, -1)


def as_vectors(matrix: np.ndarray) -> pa.Array:
    rows, width = matrix.shape
    offsets = np.arange(0, rows * width + 1, width, dtype=np.int32) if width else np.zeros(rows + 1, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.reshape(-1)))


def squared_distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """(rows, centres) squared Euclidean distances by plain differences, centre by centre."""
    out = np.empty((len(points), len(centres)))
    for j, centre in enumerate(centres):
        gap = points - centre
        out[:, j] = np.einsum("ij,ij->i", gap, gap)
    return out
