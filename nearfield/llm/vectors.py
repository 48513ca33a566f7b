"""Integer vectors from an embedding column, shared by the operators on embeddings."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 256
BOUND = 1 << 24  # integer components are held within +-BOUND, so that sums of squares and products stay exact in 64 bits


def integer_vector(vector_col: str) -> Column:
    """floor(256 * x) of each component as longs; null for a null vector and for one with a null or non-finite component.
    Components beyond +-2^24 (x beyond +-65,536) are held at that bound."""
    x = F.col(vector_col).cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    held = lambda v: F.greatest(F.lit(float(-BOUND)), F.least(F.lit(float(BOUND)), F.floor(v * SCALE).cast("double")))
    # floor of a double beyond the longs saturates, which the bound then takes in.
    return F.when(finite, F.transform(x, lambda v: held(v).cast("long")))


def dimension(rows: DataFrame, col: str = "v") -> int:
    """The longest vector's length, 0 for no rows; shorter vectors count as padded with zeros."""
    return rows.agg(F.max(F.size(col)).alias("d")).first()["d"] or 0


def matrix(column, dim: int) -> np.ndarray:
    """An Arrow column of long lists (no nulls) as a matrix with ``dim`` columns, zeros behind shorter lists."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    if len(sizes) and (sizes == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(sizes), dim), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out
