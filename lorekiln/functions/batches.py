"""Arrow batches and packed integers."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

#: Rows of an Arrow batch at most; texts are long, so Spark's default takes too much memory.
BATCH_ROWS = 1000
#: Bytes of text that are worked on at a time.
SLICE_BYTES = 4 << 20


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bounds the rows of this session's Arrow batches."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def release_memory() -> None:
    """Gives freed memory back to the system: workers wait for further tasks and keep it else."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(first row, rows) of consecutive slices of about ``most`` bytes; a longer text is alone."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    begin, total = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if row > begin and total + size > most:
            yield begin, texts.slice(begin, row - begin)
            begin, total = row, 0
        total += size
    if begin < len(texts):
        yield begin, texts.slice(begin)


def by_slices(texts: pa.Array, work: Callable[[list], list], kind: pa.DataType) -> pa.Array:
    """``work`` of all texts, slice after slice: Python objects stand for one slice at a time."""
    parts = [pa.array(work(part.to_pylist()), kind) for _, part in slices(texts)]
    found = pa.concat_arrays(parts) if parts else pa.array([], kind)
    del parts
    release_memory()
    return found
