"""Where jobs keep intermediate tables, and size checks for small sides."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast on request only when it has at most this many rows.
BROADCAST_ROWS = 1_000_000
#: Cells of vectors that are worth a task of their own in a job of training.
CELLS_PER_TASK = 1 << 15


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A local session (tests, benches) without the setting gets a new temporary
    folder; a cluster without it is refused, because a folder of one machine
    is not visible to the others.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="wagegrid-")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path not used before, below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, compact: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used before iterative training: later jobs read files that survive the
    loss of an executor instead of recomputing the whole lineage.  ``compact``
    lets AQE bring the rows to files of its advisory size, so that the many
    short jobs of training have no more tasks than the data asks for.
    """
    path = new_folder(df.sparkSession, name)
    (df.hint("rebalance") if compact else df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a small input over all cores before work that is heavy per row.

    A short file gives fewer tasks than there are cores.  An input with as many
    tasks as cores, such as any big table, is left as it is and not shuffled.
    For plain reads only: asking a frame with joins for its tasks would run them.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def dealt(df: DataFrame, vector: str, cells: int = CELLS_PER_TASK) -> DataFrame:
    """Deal written rows, each with a vector, over as many tasks as their cells ask for, the cores at most.

    For rows that many jobs work on: files are cut by their bytes, and vectors pack well.
    """
    found = df.agg(F.sum(F.size(f"{vector}.values")).alias("n")).first().n
    tasks = min(df.sparkSession.sparkContext.defaultParallelism, max(1, (found or 0) // cells))
    return df.repartition(tasks) if df.rdd.getNumPartitions() < tasks else df


def unfolded(df: DataFrame, array: str | Column, name: str, position: str | None = None) -> DataFrame:
    """One row per element of ``array``, as ``name`` (and its ``position`` from 0).

    The outer form with a filter behind it gives the rows of a plain explode.
    For that, Spark would also filter on the size of the array before the
    explode, and so work out a costly array (words, items of a page) twice.
    """
    if position is None:
        made = df.withColumn(name, F.explode_outer(array))
    else:
        made = df.select("*", F.posexplode_outer(array).alias(position, name))
    return made.where(F.col(name).isNotNull())


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after counting that ``df`` stays below the bound.

    Above the bound the frame is returned as it is and AQE picks the join.
    """
    seen = df.count()
    return F.broadcast(df) if seen <= max_rows else df
