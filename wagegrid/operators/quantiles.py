"""Exact quantiles that never gather a column in one task."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Up to this many values the built-in exact percentile is used directly.
DIRECT_ROWS = 2_000_000
_SPREAD = 0.001
#: Three rounds serve a trillion rows; the limit only ends odd cases.
_MAX_ROUNDS = 20


def _narrowed(values: DataFrame, n: int, q: float, direct_rows: int) -> DataFrame:
    """A few scans shrink the band around the wanted rank.

    Approximate quantiles on both sides of the rank bracket it; exact counts
    confirm the bracket.  Each round keeps some thousandths of the band, or a
    single hot value.  What is left are few distinct values with counts, and
    those hold the answer.
    """
    rank = (n - 1) * q
    first, last = math.floor(rank), math.ceil(rank)
    band, below, inside, distinct, spread = values, 0, n, n, _SPREAD
    for _ in range(_MAX_ROUNDS):
        if distinct <= direct_rows:
            break
        at = (rank - below) / max(inside - 1, 1)
        low, high = band.approxQuantile(
            "v", [max(0.0, at - spread), min(1.0, at + spread)], spread / 4
        )
        in_band = F.col("v").between(low, high)
        seen = values.agg(
            F.count_if(F.col("v") < low).alias("below"),
            F.count_if(in_band).alias("inside"),
            F.approx_count_distinct(F.when(in_band, F.col("v"))).alias("distinct"),
        ).first()
        if not (seen.below <= first and last < seen.below + seen.inside):
            spread = min(0.5, spread * 4)
        elif seen.inside < inside:
            below, inside, distinct = seen.below, seen.inside, seen.distinct
            band = values.where(in_band)
        else:
            spread = spread / 4
    counted = band.groupBy("v").agg(F.count("*").alias("c"))
    # About ``direct_rows`` distinct values at most, so one task may add up their counts.
    upto = F.sum("c").over(
        Window.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = counted.withColumn("upto", upto + F.lit(below))
    at_first = F.min(F.when(F.col("upto") > first, F.col("v")))
    at_last = F.min(F.when(F.col("upto") > last, F.col("v")))
    # equal neighbours first: a share of an infinite value would be no number
    share = rank - first
    between = at_first * (1 - share) + at_last * share
    return ranked.agg(F.when(at_first == at_last, at_first).otherwise(between).alias("q"))


def quantile_value(
    df: DataFrame, column: str, q: float = 0.5, *, name: str = "quantile",
    direct_rows: int = DIRECT_ROWS,
) -> DataFrame:
    """One row: the exact ``q`` quantile, linear between neighbours; missing skipped."""
    value = F.col(column).cast("double")
    values = df.select(value.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    n = values.count()
    if n <= direct_rows:
        return values.agg(F.percentile("v", F.lit(q)).alias(name))
    return _narrowed(values, n, q, direct_rows).withColumnRenamed("q", name)


def median_value(df: DataFrame, column: str, name: str = "median", **options) -> DataFrame:
    """One row: the exact median (mean of the two middle values for an even count)."""
    return quantile_value(df, column, 0.5, name=name, **options)


def median_estimate(
    df: DataFrame, column: str, accuracy: int = 10_000, name: str = "median"
) -> DataFrame:
    """One row: an estimated median in one pass, within 1/accuracy of the rank."""
    return df.agg(
        F.percentile_approx(F.col(column).cast("double"), 0.5, accuracy).alias(name)
    )


#: Size parameter of a sketch, and the share of rows by which a rank may be off at this size
#: (for 99 % of all sketches; the figure the sketch's authors give).
SKETCH_K, SKETCH_ERROR = 800, 0.0035


def quantile_sketches(df: DataFrame, column: str, by: list[str], k: int = SKETCH_K) -> DataFrame:
    """``by``, ``sketch``: of each group a summary of its values, of some kilobytes.

    Sketches are combined in each task.  They can be stored by partition, and merged later to
    sketches of any union of groups without a look at the rows.  Nulls and NaN have no part;
    a group without a value has no sketch.
    """
    value = F.col(f"`{column}`").cast("double")
    held = df.where(value.isNotNull() & ~F.isnan(value))
    return held.groupBy(*by).agg(F.kll_sketch_agg_double(value, F.lit(k)).alias("sketch"))


def merged_sketches(sketches: DataFrame, by: list[str] | None = None, k: int = SKETCH_K) -> DataFrame:
    """Sketches of coarser groups (of all rows by default)."""
    return sketches.groupBy(*(by or [])).agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def sketch_quantile(sketches: DataFrame, q: float = 0.5, name: str = "quantile") -> DataFrame:
    """``sketch`` replaced by ``n`` and its ``q`` quantile, a value that occurs."""
    return sketches.withColumns({
        "n": F.kll_sketch_get_n_double("sketch"), name: F.kll_sketch_get_quantile_double("sketch", F.lit(q)),
    }).drop("sketch")
