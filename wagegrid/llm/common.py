"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wagegrid import settings


def held_out(key: Column, modulus: int, rest: int) -> Column:
    """True where crc32 of the key as text leaves ``rest``; false for a null key."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % modulus == rest, F.lit(False))


#: The C library of the process, where it can return freed memory.
_LIBC = ctypes.CDLL(None)


def give_back() -> None:
    """Memory that was freed goes back to the system: a worker waits for its next task with what it
    holds, while the executor's heap and the other workers need the room.
    """
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):
        _LIBC.malloc_trim(0)


def map_batches(
    df: DataFrame, make: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | StructType
) -> DataFrame:
    """``make`` on every Arrow batch; batches for which it returns None give no rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = make(batch) if batch.num_rows else None
            if made is not None:
                yield made
                made = None
            give_back()

    return df.mapInArrow(run, schema)


def slices(sizes: Iterable[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours whose sizes sum to at most ``most``, or hold one element."""
    first, total, i = 0, 0, -1
    for i, size in enumerate(sizes):
        if i > first and total + size > most:
            yield first, i
            first, total = i, 0
        total += size
    if i >= first:
        yield first, i + 1


def with_columns(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    """The batch with columns replaced, or added behind the others."""
    held = dict(zip(batch.schema.names, batch.columns, strict=True)) | columns
    return pa.RecordBatch.from_arrays(list(held.values()), names=list(held))


def looked_up(
    df: DataFrame, facts: DataFrame, key: str, spread: Column, max_rows: int = 100_000, copies: int = 16, how: str = "inner"
) -> DataFrame:
    """``df`` with the columns of ``facts``, which has at most one row for a value of ``key``.

    Up to ``max_rows`` facts (counted first) are sent to all tasks.  More of them are copied
    ``copies`` times, and the rows of a key are dealt over the copies by ``spread``, so that
    a key that holds much of ``df`` is no single task.
    """
    small = settings.small_side(facts, max_rows)
    if small is not facts:
        return df.join(small, key, how)
    dealt = facts.withColumn("#copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    return df.withColumn("#copy", F.pmod(F.xxhash64(spread), F.lit(copies)).cast("int")).join(dealt, [key, "#copy"], how).drop("#copy")
