"""Counts, summaries, tops and unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagegrid import fixed_values


def count_rows(df: DataFrame, name: str = "total_rows") -> DataFrame:
    return df.agg(F.count("*").alias(name))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most first; equal counts by value."""
    counted = df.groupBy(column).agg(F.count("*").alias("n"))
    return counted.orderBy(F.desc("n"), F.asc(column))


def baseline_accuracy(df: DataFrame, label: str) -> DataFrame:
    """What always naming the biggest class would score."""
    counted = df.groupBy(label).agg(F.count("*").alias("n"))
    return counted.agg((F.max("n") / F.sum("n")).alias("baseline"))


def quality_summary(df: DataFrame) -> DataFrame:
    """One row: all rows, columns, and rows left without gaps and copies.

    One pass: copies are combined by a 256-bit digest of the row, so that texts are
    not shuffled, and both numbers come from the counted digests.
    """
    whole = F.lit(True)
    for name in df.columns:
        whole = whole & F.col(f"`{name}`").isNotNull()
    # a sum with zero makes both zeros one
    real = {name for name, kind in df.dtypes if kind in ("float", "double")}
    cells = [(F.col(f"`{c}`") + 0.0 if c in real else F.col(f"`{c}`")).alias(c) for c in df.columns]
    digest = F.sha2(F.to_json(F.struct(*cells)).cast("binary"), 256)
    rows = df.select(digest.alias("_row"), whole.alias("_whole"))
    distinct = rows.groupBy("_row", "_whole").agg(F.count("*").alias("_copies"))
    return distinct.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("n_rows"),
        F.lit(len(df.columns)).cast("long").alias("n_columns"),
        F.count_if("_whole").alias("n_good"),
    )


def fold_summary(
    df: DataFrame, score: str, by: tuple[str, ...] = (), digits: int | None = None
) -> DataFrame:
    """Mean and population standard deviation of scores, per group."""
    mean, sd = F.avg(score), F.stddev_pop(score)
    if digits is not None:
        mean, sd = F.round(mean, digits), F.round(sd, digits)
    return df.groupBy(*by).agg(mean.alias("mean_score"), sd.alias("sd_score"))


def top_importance(
    df: DataFrame, value: str = "importance", name: str = "name",
    n: int = fixed_values.IMPORTANCE_ROWS,
) -> DataFrame:
    """The ``n`` largest values; equal values by name.  Each task keeps ``n`` rows."""
    return df.orderBy(F.desc(value), F.asc(name)).limit(n)


def head(df: DataFrame, n: int, by: list[str]) -> DataFrame:
    return df.orderBy(*by).limit(n)


def tail(df: DataFrame, n: int, by: list[str]) -> DataFrame:
    """The last ``n`` rows in the order of ``by``."""
    return df.orderBy(*[F.desc(c) for c in by]).limit(n).orderBy(*by)


def append_all(frames: list[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Frames below each other, columns by name."""
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames
    )


def set_of(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()
