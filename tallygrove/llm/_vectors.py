"""Integer vectors: what the vector operators share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import slim

#: Scaled components are held within this, so that squared distances and inner products of up to 64 components fit a long.
BOUND = 1 << 27
#: Within this, sums of 64 products of doubles are exact.
_EXACT = 1 << 22


def scaled(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component x as a double; null if the vector is null or has a null or non-finite component."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    whole = lambda x: F.floor(F.greatest(F.least(x * scale, F.lit(float(BOUND))), F.lit(-float(BOUND)))).cast("int")
    doubles = vector.cast("array<double>")
    return F.when(F.forall(doubles, finite), F.transform(doubles, whole))


def vector_rows(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, v) of the rows that have a vector."""
    rows = slim(df, vec_id=id_col, vector=vector_col)
    return rows.select("vec_id", scaled(F.col("vector"), scale).alias("v")).where("v is not null")


def matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    """The vectors of an Arrow list column as rows of int32."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int32, copy=False).reshape(-1, dims)


def unpacked(buffer, dims: int) -> np.ndarray:
    """Rows of a binary value, in numbers whose products are exact: doubles where these do, else longs."""
    rows = np.frombuffer(buffer, "<i4").reshape(-1, dims)
    small = not rows.size or max(int(rows.max()), -int(rows.min())) < _EXACT
    return rows.astype(np.float64 if small else np.int64)


def same_kind(*arrays: np.ndarray) -> list[np.ndarray]:
    """The arrays as doubles if all are, else as longs (holding whole numbers either way)."""
    kind = np.float64 if all(a.dtype == np.float64 for a in arrays) else np.int64
    return [a.astype(kind, copy=False) for a in arrays]


def runs(sorted_keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins."""
    return np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]])) if len(sorted_keys) else np.zeros(0, np.intp)


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ..., start + length - 1 of each, one after the other."""
    before = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) - np.repeat(before, lengths) + np.repeat(starts, lengths)
