"""Vectors as integer vectors, shared by vector coding and clustering.

Each component x (read as a double) becomes floor(scale * x). Squared distances then are
exact whole numbers. Components beyond ``largest(width)`` are set to it, so that a squared
distance of two vectors always fits a long; for 64 components and scale 256 that touches
only |x| above 524,288.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: components become floor(SCALE * x)
SCALE = 256


def largest(width: int) -> int:
    """Bound of a component: ``width`` squared differences of such numbers fit a long."""
    return math.isqrt(2 ** 62 // max(width, 1)) // 2


def ragged(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Flat values and row boundaries of a list column (null rows are empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return (column.flatten().to_numpy(zero_copy_only=False),
            np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of an integer list column as int64, ended with zeros to ``width``."""
    flat, ends = ragged(column)
    sizes = np.diff(ends)
    if (sizes == width).all():
        return flat.astype(np.int64).reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


def _whole(scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column(0)
            flat, ends = ragged(column)
            flat = flat.astype(np.float64)  # null components become NaN
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
            keep = (bad[ends[1:]] == bad[ends[:-1]]) & column.is_valid().to_numpy(zero_copy_only=False)
            sizes = np.diff(ends)
            chosen = np.repeat(keep, sizes)
            bound = np.repeat([largest(s) for s in sizes[keep]], sizes[keep]).astype(np.float64)
            with np.errstate(over="ignore"):
                whole = np.clip(np.floor(scale * flat[chosen]), -bound, bound).astype(np.int32)
            offsets = np.concatenate([[0], np.cumsum(sizes[keep])]).astype(np.int32)
            rest = batch.filter(pa.array(keep))
            yield pa.record_batch([pa.ListArray.from_arrays(pa.array(offsets), pa.array(whole)),
                                   *rest.columns[1:]], names=batch.schema.names)
    return run


def whole_vectors(vectors: DataFrame, vec: str, keep: dict[str, str], scale: int = SCALE) -> DataFrame:
    """(vec array<int>, kept columns) of the rows whose vector is whole and finite.

    ``keep`` names the columns to carry, as new name -> column. Null vectors and those with
    null or non-finite components are dropped; an empty vector stays.
    """
    narrow = vectors.select(F.col(vec).cast("array<double>").alias("vec"),
                            *(F.col(column).alias(name) for name, column in keep.items()))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in narrow.schema.fields[1:])
    return narrow.mapInArrow(_whole(scale), f"vec array<int>, {fields}")
