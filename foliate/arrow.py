"""What Python workers hold: bounds of Arrow batches, and memory given back."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import SparkSession

#: Most rows of one Arrow batch; texts may be long, so a worker holds few of them at once.
ARROW_ROWS = 500
#: Most bytes of one, unless a single row is larger: tasks hold it in the JVM and in Python.
ARROW_BYTES = 4 << 20
#: The settings with Spark's own defaults, which are replaced; any other value is the user's and stays.
_ARROW = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", str(ARROW_ROWS)),
    "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", f"{ARROW_BYTES}b"),
}


def prepare(spark: SparkSession) -> None:
    """Bound the rows and bytes of an Arrow batch, unless the user has set bounds."""
    for key, (default, bound) in _ARROW.items():
        if spark.conf.get(key) == default:
            spark.conf.set(key, bound)


def _trim() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def release_memory() -> None:
    """Give what a fit has freed back to the system; the allocators would keep it for the session."""
    gc.collect()
    _trim()


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """run, for mapInArrow, giving back what it has freed at a task's end: workers outlive their tasks."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        _trim()

    return body
