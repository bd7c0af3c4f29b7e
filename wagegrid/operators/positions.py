"""Row positions and folds without a single-task window.

``row_number`` over a whole table sorts it in one task.  Here Spark's range
partitioning deals the rows into slices by the order key; the dealt rows are written
down, numbered inside their slice, and the number of rows before the slice is added.  Any
key that can be sorted will do, and positions are the same for any number of slices.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wagegrid import settings

#: Rows numbered by one task; a table with more is dealt into slices.
ROWS_PER_SLICE = 2_000_000
#: Most group counts taken to the driver; more stay a distributed table.
MAX_GROUPS = 100_000


def _counts(df: DataFrame, *by: str) -> DataFrame:
    """Rows per group.  While the groups are few their counts become a local
    table, whose known size lets Spark broadcast it; more of them stay distributed.
    """
    counted = df.groupBy(*by).agg(F.count("*").alias("_n"))
    found = counted.limit(MAX_GROUPS + 1).collect()
    if len(found) > MAX_GROUPS:
        return counted
    return df.sparkSession.createDataFrame(found, counted.schema)


def _same(left: list[str], right: list[str]) -> Column:
    """Null-safe equality of columns, pair by pair."""
    pairs = zip(left, right, strict=True)
    return reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in pairs])


def _sliced(df: DataFrame, key: str, within: tuple[str, ...], slices: int) -> tuple[DataFrame, DataFrame]:
    """Rows with the number of their slice, and per slice its rows and the rows before it."""
    dealt = df.repartitionByRange(slices, key).withColumn("_slice", F.spark_partition_id())
    # written once: a slice must not change between the count and the numbering
    dealt = settings.written(dealt, "slices")
    tags = [f"_g{i}" for i in range(len(within))]
    counts = _counts(dealt, *within, "_slice").toDF(*tags, "_of", "_n")
    before = Window.partitionBy(*tags).orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    return dealt, counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))


def _numbered(dealt: DataFrame, offsets: DataFrame, key: str, within: tuple[str, ...], name: str) -> DataFrame:
    tags = [f"_g{i}" for i in range(len(within))]
    inside = Window.partitionBy(*within, "_slice").orderBy(key)
    joined = dealt.join(offsets, _same([*within, "_slice"], [*tags, "_of"]))
    numbered = joined.withColumn(name, F.col("_before") + F.row_number().over(inside) - 1)
    return numbered.drop(*tags, "_of", "_n", "_before", "_slice")


def row_numbers(
    df: DataFrame, key: str, *, within: tuple[str, ...] = (), name: str = "position",
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """0-based position of each row in the order of ``key`` (unique; of any type that
    can be sorted, nulls first), over the table or within each value of ``within``.
    """
    slices = math.ceil(df.count() / rows_per_slice)
    if slices <= 1:
        window = Window.partitionBy(*within).orderBy(key)
        return df.withColumn(name, F.row_number().over(window).cast("long") - 1)
    dealt, offsets = _sliced(df, key, within, slices)
    return _numbered(dealt, offsets, key, within, name)


def rows_between(
    df: DataFrame, key: str, first: int, last: int, *, rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """Rows at positions ``first`` to ``last - 1`` in the order of ``key``.

    Only slices that hold such positions are numbered.
    """
    slices = math.ceil(df.count() / rows_per_slice)
    if slices <= 1:
        top = df.orderBy(key).limit(max(last, 0))
        numbered = top.withColumn("position", F.row_number().over(Window.orderBy(key)).cast("long") - 1)
    else:
        dealt, offsets = _sliced(df, key, (), slices)
        held = offsets.where((F.col("_before") < last) & (F.col("_before") + F.col("_n") > first))
        numbered = _numbered(dealt, held, key, (), "position")
    return numbered.where(F.col("position").between(first, last - 1))


def stratified_folds(
    df: DataFrame, label: str, key: str, k: int, *, name: str = "fold",
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Fold 0..k-1 for every row: each class is dealt in ``k`` runs of near-equal
    length in the order of ``key``, longer runs first.
    """
    sizes = _counts(df, label).withColumnsRenamed({label: "_label", "_n": "_size"})
    placed = row_numbers(
        df, key, within=(label,), name="_pos", rows_per_slice=rows_per_slice
    )
    joined = placed.join(sizes, F.col(label).eqNullSafe(F.col("_label")))
    short = F.floor(F.col("_size") / k)
    longer = F.col("_size") % k
    edge = longer * (short + 1)
    fold = F.when(F.col("_pos") < edge, F.floor(F.col("_pos") / (short + 1))).otherwise(
        longer + F.floor((F.col("_pos") - edge) / F.greatest(short, F.lit(1)))
    )
    return joined.withColumn(name, fold.cast("int")).drop("_label", "_size", "_pos")
