"""Sums over all rows that NumPy forms batch by batch."""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def matrix(part: pa.RecordBatch, column: str) -> np.ndarray:
    """A list column of a batch, with a row per row; all lists are equally long."""
    return part.column(column).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)


def summed(df: DataFrame, work: Callable[[pa.RecordBatch], np.ndarray], size: int) -> np.ndarray:
    """The sum of the ``size`` numbers that ``work`` makes of each batch. A task sends one row per number."""
    if not size:
        return np.zeros(0)

    def add(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for part in parts:
            if part.num_rows:
                total += work(part)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], names=["place", "x"])

    totals = df.mapInArrow(add, "place int, x double").groupBy("place").agg(F.sum("x").alias("x")).toArrow()
    found = np.zeros(size)
    found[totals.column("place").to_numpy()] = totals.column("x").to_numpy()
    return found
