"""Joining search rows to details, and finding what is still to be loaded."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_details(
    search: DataFrame, details: DataFrame, on: str = "job_id", salt: int = 1
) -> DataFrame:
    """Inner join; repeated ids multiply, ids of one side only are left out.

    AQE picks broadcast or sort-merge and splits skewed partitions.  With
    ``salt`` above 1 the search rows of an id are dealt over that many
    partitions and the details repeated for each: the result is the same, for
    ids so hot that the split of a single partition does not help.
    """
    if salt <= 1:
        return search.join(details, on, "inner")
    # By content and by task: equal copies differ in their task, and a task that
    # is run again deals its rows as before.
    place = F.xxhash64(*search.columns) + F.spark_partition_id()
    dealt = search.withColumn("_salt", F.pmod(place, F.lit(salt)).cast("int"))
    repeated = details.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    return dealt.join(repeated, [on, "_salt"], "inner").drop("_salt")


def latest_per_id(df: DataFrame, by: list[str | Column], on: str = "job_id") -> DataFrame:
    """The latest row of each id.

    A maximum over (order, row) is combined within each task before the
    shuffle, so an id with a third of all rows sends one row per task; a
    window would sort all of them in a single task.
    """
    rank = F.struct(*by)
    row = F.struct(*[c for c in df.columns if c != on])
    return df.groupBy(on).agg(F.max_by(row, rank).alias("_row")).select(on, "_row.*")


def unseen_ids(
    rows: DataFrame, stored: DataFrame, on: str = "job_id", ids: DataFrame | None = None
) -> DataFrame:
    """Rows whose id is not among ``stored``.

    One anti join with one column of the stored table.  A caller that has the ids of
    ``rows`` at hand, with their size checked, passes them: the stored table is then
    narrowed to these where it is read and not shuffled.
    """
    known = stored.select(on)
    if ids is not None:
        known = known.join(ids, on, "left_semi").distinct()
    return rows.join(known, on, "left_anti")


def new_job_ids(
    search: DataFrame, details: DataFrame, *, on: str = "job_id",
    stamp: str = "search_datetime", ties: tuple[str, ...] = (),
) -> DataFrame:
    """Postings searched but without details yet, by their latest search row."""
    return latest_per_id(unseen_ids(search, details, on), [stamp, *ties], on)


def align_columns(blocks: list[DataFrame], on: str) -> DataFrame:
    """Feature blocks side by side by row id; each block holds an id once."""
    return reduce(lambda left, right: left.join(right, on, "inner"), blocks)
