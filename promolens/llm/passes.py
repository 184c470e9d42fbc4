"""Sums over all rows of a table, and terms of texts: helpers of the operators that learn from or score whole tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.llm.common import give_back

#: Letters, digits and every byte of a non-ASCII character make terms; A-Z are lowered, all else becomes a space.
FOLD = np.full(256, 0x20, np.uint8)
FOLD[0x30:0x3A] = np.arange(0x30, 0x3A)
FOLD[0x41:0x5B] = FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
FOLD[0x80:] = np.arange(0x80, 0x100)


def summed(rows: DataFrame, cells: int, part: Callable[[Iterator[pa.RecordBatch]], np.ndarray]) -> np.ndarray:
    """The sum of ``part`` (``cells`` numbers for the batches of one task) over all tasks of ``rows``.

    Tasks send one row per cell, Spark adds them, and only the ``cells`` sums reach the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            values = np.asarray(part(batches), np.float64).reshape(-1)
            yield pa.record_batch([pa.array(np.arange(cells, dtype=np.int32)), pa.array(values)], names=["cell", "value"])
        finally:
            give_back()

    found = rows.mapInArrow(run, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(cells)
    out[found.column("cell").to_numpy()] = found.column("value").to_numpy()
    return out


def matrix(column: pa.Array, dtype) -> np.ndarray:
    """Rows of equal-sized binaries as a matrix, without copying them."""
    _, offsets, data = column.buffers()
    cuts = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[cuts[0] : cuts[-1]].view(dtype).reshape(len(column), -1)


def ragged_values(column: pa.Array, dtype) -> tuple[np.ndarray, np.ndarray]:
    """Values and cuts of binaries of any sizes."""
    held = column.to_pylist()
    width = np.dtype(dtype).itemsize
    return np.frombuffer(b"".join(held), dtype), np.r_[0, np.cumsum([len(v) // width for v in held], dtype=np.int64)]
