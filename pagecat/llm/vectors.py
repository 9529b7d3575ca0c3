"""What the operators on embeddings share: only the two columns they read, and the check of a vector."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def id_vector(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, v (array of doubles); extra columns are left out, so their names can't clash."""
    return embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))


def finite(vector: Column) -> Column:
    """True for a vector that is not null and holds no null, NaN or infinite component."""
    whole = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & whole, F.lit(False))


def matrix(column: pa.Array, kind: str, width: int) -> np.ndarray:
    """Rows of a binary column without nulls, each ``width`` numbers of one kind, as one matrix."""
    return np.frombuffer(b"".join(v.as_buffer() for v in column), kind).reshape(len(column), width)


def binary(rows: np.ndarray) -> pa.Array:
    """A matrix as a binary column, one row each."""
    data = np.ascontiguousarray(rows)
    size = data.shape[1] * data.itemsize
    offsets = np.arange(len(data) + 1, dtype=np.int32) * np.int32(size)
    return pa.BinaryArray.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def stacked(column: pa.Array, width: int) -> np.ndarray:
    """A list column without nulls, whose lists all hold ``width`` numbers, as one matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)
