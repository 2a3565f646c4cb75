"""How much of a table Spark hands to a Python function at once, and what the function leaves behind."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import SparkSession

SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """From here on this session's Arrow batches have 4 MB at most, or one row.

    The default of 64 MB, held several times over in the JVM and in Python, takes most of the memory
    that an executor has beside its heap. A smaller setting of the session is left alone. Batches
    never change a result.
    """
    size = int(spark.conf.get(SETTING).rstrip("bB"))
    if size <= 0 or size > BATCH_BYTES:
        spark.conf.set(SETTING, f"{BATCH_BYTES}b")


def give_back() -> None:
    """Return memory that was freed, but kept for later, to the machine."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def arrow_function(
    function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The function, which gives freed memory back when it is done.

    Spark keeps its Python workers for the tasks and stages to come; without this each of them keeps
    what its largest task took, beside the heap of the executor.
    """
    @wraps(function)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            give_back()

    return run
