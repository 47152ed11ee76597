"""Counts of hashed keys in a table of fixed size.

Every task counts its own keys in ``CELLS`` cells and returns the table in
compressed chunks; the chunks are added up as a tree, ``FAN`` tasks at a time, so
no task ever holds more than ``FAN`` tables' worth of one chunk.  The result (16 MB,
whatever the input) may be collected and broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from trendstream.session import materialize

BITS = 22
CELLS = 1 << BITS
CHUNKS = 64
FAN = 32
_CHUNK = pa.schema([("chunk", pa.int32()), ("task", pa.int64()), ("cells", pa.binary())])
_CHUNK_DDL = "chunk int, task long, cells binary"


def cell_of(keys: np.ndarray) -> np.ndarray:
    """Cells of unsigned 64-bit hashes."""
    return (keys >> np.uint64(64 - BITS)).astype(np.int64)


def _packed(chunks: list[int], task: int, counts: list[np.ndarray]) -> pa.RecordBatch:
    blobs = [pa.compress(c.astype("<u4").tobytes(), codec="zstd", asbytes=True) for c in counts]
    return pa.RecordBatch.from_arrays([pa.array(chunks, pa.int32()), pa.array([task] * len(chunks), pa.int64()),
                                       pa.array(blobs, pa.binary())], schema=_CHUNK)


def _counts(blob: bytes) -> np.ndarray:
    size = CELLS // CHUNKS * 4
    return np.frombuffer(pa.decompress(blob, decompressed_size=size, codec="zstd", asbytes=True), dtype="<u4")


def _added(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Counts end at the largest 32-bit number."""
    total = a + b
    return np.where(total < a, np.uint32(2 ** 32 - 1), total)


def count_cells(df: DataFrame, keys: Callable[[pa.RecordBatch], Iterator[np.ndarray]]) -> np.ndarray:
    """How often ``keys`` of the rows of ``df`` fall into each cell (all zero for an empty table)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, some = np.zeros(CELLS, dtype=np.uint32), False
        for b in batches:
            for k in keys(b):
                some = some or len(k) > 0
                table = _added(table, np.bincount(cell_of(k), minlength=CELLS).astype(np.uint32))
        if some:
            yield _packed(list(range(CHUNKS)), TaskContext.get().partitionId(), np.split(table, CHUNKS))

    def add(part: pa.Table) -> pa.Table:
        total = np.zeros(CELLS // CHUNKS, dtype=np.uint32)
        for blob in part["cells"].to_pylist():
            total = _added(total, _counts(blob))
        one = _packed([part["chunk"][0].as_py()], part["task"][0].as_py() // FAN, [total])
        return pa.Table.from_batches([one])

    parts, tasks = materialize(df.mapInArrow(count, _CHUNK_DDL), "cells"), df.rdd.getNumPartitions()
    while tasks > 1:
        parts = materialize(parts.groupBy("chunk", (parts["task"] / FAN).cast("long")).applyInArrow(add, _CHUNK_DDL), "cells")
        tasks = -(-tasks // FAN)
    table = np.zeros((CHUNKS, CELLS // CHUNKS), dtype=np.uint32)
    for r in parts.toLocalIterator():
        table[r["chunk"]] = _added(table[r["chunk"]], _counts(bytes(r["cells"])))
    return table.reshape(-1)
