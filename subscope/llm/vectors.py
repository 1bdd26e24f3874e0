"""Columns of vectors as matrices."""

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dimension(df: DataFrame, column: str) -> int:
    """The most frequent length of the vectors, the longer one of a tie; 0 without any."""
    found = df.where(F.col(column).isNotNull()).groupBy(F.size(column).alias("d")).count()
    first = found.orderBy(F.desc("count"), F.desc("d")).first()
    return first["d"] if first else 0


def finite_rows(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows have `dims` finite entries, and these rows as a matrix of doubles."""
    lengths = pa.compute.list_value_length(column).fill_null(-1).to_numpy(zero_copy_only=False)
    fits = lengths == dims
    flat = column.filter(pa.array(fits)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    matrix = flat.reshape(-1, dims) if dims else np.zeros((int(fits.sum()), 0))
    finite = np.isfinite(matrix).all(axis=1)  # null entries have become NaN
    kept = np.zeros(len(lengths), dtype=bool)
    kept[np.flatnonzero(fits)[finite]] = True
    return kept, matrix[finite]
