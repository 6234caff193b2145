"""Embedding columns as whole numbers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Whole numbers of this size, and sums of a few of them, still are 64-bit integers.
LARGEST = 1 << 62


def is_usable(vector: Column) -> Column:
    """Is there a vector, all of whose entries are finite numbers?"""
    return F.forall(
        vector.cast("array<double>"), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    )


def scaled_down(vector: Column, scale: int) -> Column:
    """floor(scale * c) of every entry c; entries that no 64-bit integer holds end at its limits."""
    return F.transform(vector.cast("array<double>"), lambda c: F.floor(c * F.lit(float(scale))))


def squared_length(whole: Column) -> Column:
    return F.aggregate(whole.cast("array<double>"), F.lit(0.0), lambda total, c: total + c * c)


def by_length(vectors: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Of every length: which vectors have it, and their matrix of 64-bit integers."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    found = {}
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        same = vectors if len(at) == len(lengths) else vectors.take(pa.array(at))
        found[int(length)] = at, same.flatten().to_numpy(zero_copy_only=False).reshape(len(at), length)
    return found
