"""What the operators rely on for bounded memory of Python workers."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import SparkSession

ARROW_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python in batches of a few megabytes, whatever their length (the default is 64 MB)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def frugal(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over batches, which gives the memory that it has freed back to the system when a task ends.

    Workers outlive their tasks, and the allocators keep what was freed for the next one.
    """

    @functools.wraps(run)
    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
            if trim is not None:
                trim(0)

    return wrapped
