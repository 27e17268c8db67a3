"""Vectors as integer rows: which take part, padding, whole-column statistics."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(column: str) -> Column:
    """True for a vector that is there and has only finite components (an empty one counts)."""
    def finite(c):
        c = c.cast("double")
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    return F.col(column).isNotNull() & F.forall(column, finite)


def scaled(column: str, factor: int, shift: int = 0) -> Column:
    """floor(factor * c) + shift of every component c, taken as double."""
    return F.transform(column, lambda c: F.floor(F.lit(factor) * c.cast("double")) + F.lit(shift))


def padded(column: str, dims: int, fill: int = 0) -> Column:
    """The vector with ``dims`` components: the missing last ones are ``fill``."""
    return F.concat(F.col(column), F.array_repeat(F.lit(fill).cast("long"),
                                                  F.lit(dims) - F.size(column)))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """A batch's array<long> column of ``dims`` components each as (rows, dims) int64."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)


def column_sums(rows: DataFrame, column: str, dims: int) -> np.ndarray:
    """Exact sums of each component: int64 partial sums a task, then one row a component."""
    def run(batches):
        total = np.zeros(dims, np.int64)
        for b in batches:
            total += matrix(b.column(0), dims).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array(total)],
                                         ["d", "s"])
    parts = rows.select(column).mapInArrow(run, "d int, s long")
    out = np.zeros(dims, np.int64)
    for r in parts.groupBy("d").agg(F.sum("s").alias("s")).collect():       # one row a component
        out[r["d"]] = r["s"]
    return out
