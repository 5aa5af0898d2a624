"""Sums of arrays over all partitions."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Partial sums: row number ``i`` of a matrix and its values as little-endian doubles.
DDL = "i int, row binary"


def partial_rows(matrix: np.ndarray) -> pa.RecordBatch:
    """The rows of one partition's matrix."""
    rows = [np.ascontiguousarray(row, "<f8").tobytes() for row in matrix]
    return pa.RecordBatch.from_arrays([pa.array(range(len(rows)), pa.int32()), pa.array(rows, pa.binary())], ["i", "row"])


def total(partials: DataFrame) -> list[np.ndarray]:
    """Sum equal row numbers over all partitions, each in one task's running sum; the driver gets one row per number."""

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, row in zip(batch.column("i").to_pylist(), batch.column("row").to_pylist()):
                sums[i] = sums.get(i, 0) + np.frombuffer(row, "<f8")
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], ["i", "row"]
            )

    rows = partials.repartition("i").mapInArrow(add, DDL).collect()
    return [np.frombuffer(r.row, "<f8") for r in sorted(rows, key=lambda r: r.i)]
