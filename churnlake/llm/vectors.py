"""Vectors of whole numbers and their exact inner products."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Whole numbers below are exact in double precision, and so is their floor as a long.
_EXACT = float(1 << 53)
_LONG = float(1 << 62)


def whole(x: Column, scale: int) -> Column:
    """floor(scale * x) as a double; a double of 2^52 or more is whole already."""
    scaled = x.cast("double") * scale
    return F.when(F.abs(scaled) < float(1 << 52), F.floor(scaled).cast("double")).otherwise(scaled)


def finite(value: str) -> Column:
    """Whether a vector is there and all its components are finite."""
    infinite = F.lit(float("inf"))
    sound = F.forall(F.col(value), lambda x: x.isNotNull() & (F.abs(x.cast("double")) < infinite))
    return F.col(value).isNotNull() & sound


def whole_vectors(vectors: DataFrame, key: str = "vec_id", value: str = "embedding", scale: int = 64) -> DataFrame:
    """``(vec_id, v)``: components x as floor(scale * x), one row per id.

    Vectors that are null or hold null or non-finite components are left out, as are rows
    without id. If an id repeats, its smallest vector in array order counts.
    """
    scaled = F.transform(F.col(value), lambda x: whole(x, scale))
    return vectors.filter(F.col(key).isNotNull() & finite(value)).groupBy(F.col(key).alias("vec_id")).agg(F.min(scaled).alias("v"))


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of a list column, short ones padded with zeros."""
    lists = column.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks)
    lengths = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), width))
    out[np.arange(width) < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of rows of whole numbers, as longs. A product beyond the range of a
    long counts as its nearest end."""
    with np.errstate(over="ignore"):
        bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if bound < _EXACT:
        return (a @ b.T).astype(np.int64)
    if bound < _LONG:
        return a.astype(np.int64) @ b.astype(np.int64).T
    whole_numbers = np.frompyfunc(int, 1, 1)
    scores = whole_numbers(a).dot(whole_numbers(b).T) if a.size and b.size else np.zeros((len(a), len(b)), object)
    low, high = -(1 << 63), (1 << 63) - 1
    return np.array([[min(max(x, low), high) for x in row] for row in scores], np.int64).reshape(len(a), len(b))
