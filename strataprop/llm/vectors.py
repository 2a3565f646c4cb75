"""Vectors of a fixed length that many tasks fill and Spark combines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataprop.llm.batches import arrow_function

#: Bytes in one row.
SLICE = 1 << 15
#: Tasks whose rows of one slice are combined first.
FAN_IN = 256
#: Bits of a filter over 64-bit hashes (8 MB), and those in one of Spark's bitmaps.
FILTER_BITS, BITMAP = 26, 32768
SCHEMA = "task long, slice long, bytes binary"


def vector_rows(task: int, vector: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One task's vector as rows, all-zero slices left out."""
    parts = vector.view(np.uint8).reshape(-1, SLICE)
    used = np.flatnonzero(parts.any(axis=1))
    for lo in range(0, len(used), 64):
        some = used[lo : lo + 64]
        yield pa.RecordBatch.from_pydict({
            "task": pa.array([task] * len(some), pa.int64()), "slice": pa.array(some, pa.int64()),
            "bytes": pa.array([parts[k].tobytes() for k in some], pa.binary())})


def _added(kind: np.dtype, wide: np.dtype, combine):
    """From rows sorted by task and slice: one row for each of both, its vectors combined; one is held at a time."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(held: tuple[int, int], total: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [*(pa.array([x], pa.int64()) for x in held), pa.array([total.tobytes()], pa.binary())], ["task", "slice", "bytes"])

        held, total = None, None
        for batch in batches:
            for task, number, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if (task, number) != held:
                    if held:
                        yield told(held, total)
                    held, total = (task, number), np.zeros(SLICE // kind.itemsize, wide)
                combine(total, np.frombuffer(part.as_buffer(), kind if len(part.as_buffer()) == SLICE else wide), out=total)
        if held:
            yield told(held, total)

    return arrow_function(add)


def combined(rows: DataFrame, length: int, dtype=np.uint16) -> np.ndarray:
    """All tasks' vectors together, on the driver: counts are added (as int64), bytes are or-ed.

    ``dtype`` is the tasks' own. The result has ``length`` numbers whatever the input. Rows are dealt out by
    slice and FAN_IN tasks, then by slice, and combined as they come, so a task holds one vector at a time.
    """
    small = np.dtype(dtype)
    wide, combine = (small, np.bitwise_or) if small == np.uint8 else (np.dtype(np.int64), np.add)
    for group in (F.expr(f"task div {FAN_IN}"), F.lit(0).cast("long")):
        grouped = rows.select(group.alias("task"), "slice", "bytes")
        rows = grouped.repartition("slice", "task").sortWithinPartitions("task", "slice").mapInArrow(
            _added(small, wide, combine), SCHEMA)
    total = np.zeros(length, wide).reshape(-1, SLICE // small.itemsize)
    for row in rows.collect():
        total[row["slice"]] = np.frombuffer(row["bytes"], wide)
    return total.reshape(-1)


def cells(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The cell of each 64-bit hash among 2^bits: its highest bits."""
    return (hashes.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)


def marks(hashes: DataFrame) -> np.ndarray:
    """A filter of fixed size over the one column of 64-bit hashes, on the driver.

    It passes every hash given, and others by chance: the more are given, the more.
    """
    cell = F.shiftrightunsigned(hashes.columns[0], 64 - FILTER_BITS)
    parts = hashes.filter(F.col(hashes.columns[0]).isNotNull()).groupBy((cell / BITMAP).cast("int").alias("part")).agg(
        F.bitmap_construct_agg(cell % BITMAP).alias("bits"))
    bits = np.zeros((1 << FILTER_BITS) // BITMAP * (BITMAP // 8), np.uint8).reshape(-1, BITMAP // 8)
    for row in parts.collect():  # 2^FILTER_BITS / BITMAP rows at most
        bits[row["part"]] = np.frombuffer(row["bits"], np.uint8)
    return bits.reshape(-1)


def marked(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    own = cells(hashes, FILTER_BITS)
    return (bits[own >> 3] >> (own & 7) & 1).astype(bool)
