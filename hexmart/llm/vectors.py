"""What the operators on vectors share: which rows take part, and rows as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(embedding: Column) -> Column:
    """True for a vector without null, NaN and infinite components; false for a null vector."""
    bad = F.exists(embedding, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(~bad, F.lit(False))


def usual_length(vectors: DataFrame, embedding: str = "embedding") -> int:
    """The length that most vectors have, the longer on a tie; 0 for an empty table. One row comes to the driver."""
    lengths = vectors.groupBy(F.size(embedding).alias("n")).count()
    found = lengths.agg(F.max(F.struct("count", "n")).alias("top")).first()["top"]
    return found["n"] if found else 0


def matrix(column: pa.Array | pa.ChunkedArray, width: int, dtype: type) -> np.ndarray:
    """The rows of a list column, all of length ``width``, without nulls."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(len(column), width)
