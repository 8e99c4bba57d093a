"""One array of fixed size, added up over all rows of a table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from snapfold.llm.words import chunks

GROUPS = 16


def summed_arrays(rows: DataFrame, add: Callable[[pa.RecordBatch, np.ndarray], None], size: int, column: str = "text") -> np.ndarray:
    """The sum of what `add` adds, chunk by chunk, to a zero array of int64.

    A task sends on one array, compressed; GROUPS tasks add those up, and the driver their
    GROUPS arrays.  So nothing that leaves a task grows with the table.
    """
    schema = "part int, total binary"

    def pack(part: int, total: np.ndarray) -> pa.RecordBatch:
        packed = pa.compress(total.tobytes(), codec="zstd", asbytes=True)
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([packed], pa.binary())], names=["part", "total"])

    def unpack(packed: bytes) -> np.ndarray:
        return np.frombuffer(pa.decompress(packed, size * 8, codec="zstd", asbytes=True), dtype=np.int64)

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for part in chunks(batch, column):
                add(part, total)
        if total.any():
            yield pack(TaskContext.get().partitionId() % GROUPS, total)

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for value in batch.column("total"):
                total += unpack(value.as_py())
        if total.any():
            yield pack(0, total)

    total = np.zeros(size, dtype=np.int64)
    for row in rows.mapInArrow(own, schema).repartition(GROUPS, "part").mapInArrow(together, schema).toLocalIterator():
        total += unpack(bytes(row.total))
    return total
