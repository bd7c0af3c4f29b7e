"""Filters, projections and repairs of posting rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wagegrid import fixed_values
from wagegrid.functions.salary import is_annual


def drop_sentinel(
    df: DataFrame, column: str = "Salary", sentinel: str = fixed_values.NO_SALARY
) -> DataFrame:
    """Rows whose column holds something: neither null nor the sentinel text."""
    return df.where(F.col(column) != sentinel)


def dedupe_rows(df: DataFrame) -> DataFrame:
    """Full-row duplicates once; nulls count as equal.

    The rows are combined within each task before the shuffle, so copies of a
    hot row travel once per task.
    """
    return df.dropDuplicates()


def drop_nulls(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Without rows that miss any field."""
    return df.na.drop("any", subset=columns)


def annual_only(
    df: DataFrame, column: str = "Salary", units: tuple[str, ...] = fixed_values.OTHER_UNITS
) -> DataFrame:
    """Rows whose salary names none of the other pay periods; null drops."""
    return df.where(is_annual(column, units))


def fill_from(df: DataFrame, pairs: dict[str, str]) -> DataFrame:
    """Fill ``column`` from ``other`` where it is missing, then drop ``other``."""
    filled = df.withColumns({c: F.coalesce(c, other) for c, other in pairs.items()})
    return filled.drop(*pairs.values())


def reshape_columns(
    df: DataFrame, *, drop: tuple[str, ...] = (), rename: dict[str, str] | None = None,
    order: list[str] | None = None,
) -> DataFrame:
    """Drop, then rename, then bring into order."""
    shaped = df.drop(*drop).withColumnsRenamed(rename or {})
    return shaped.select(*order) if order else shaped


def to_stamp(text: str | Column, pattern: str = fixed_values.STAMP_FORMAT) -> Column:
    """Text at minute grain to a timestamp; null when it is no such text."""
    return F.try_to_timestamp(text, F.lit(pattern))


def cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in its order and types; text stamps use the minute format."""
    kinds = dict(df.dtypes)
    columns = []
    for field in schema.fields:
        source = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.TimestampType) and kinds[field.name] == "string":
            value = to_stamp(source)
        else:
            value = source.try_cast(field.dataType)
        columns.append(value.alias(field.name))
    return df.select(*columns)


def minute_stamp(stamp: str | Column) -> Column:
    """A stamp cut to the minute."""
    return F.date_trunc("minute", stamp)


def day_mark(stamp: str | Column) -> Column:
    """The day of a stamp as ``yyyyMMdd``."""
    return F.date_format(stamp, fixed_values.DAY_FORMAT)


def trim_text(text: str | Column, drop_breaks: bool = True) -> Column:
    """Outer white space off; line breaks out."""
    trimmed = F.regexp_replace(text, r"^\s+|\s+$", "")
    return F.translate(trimmed, "\n", "") if drop_breaks else trimmed


def scalar_if(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also for null)."""
    return F.when(condition, 1).otherwise(0)


def check_all_match(df: DataFrame, column: str, word: str = "year") -> DataFrame:
    """One row: how many rows there are, how many lack ``word``, and whether none does."""
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count_if(~F.coalesce(F.col(column).contains(word), F.lit(False))).alias("n_without"),
    ).withColumn("all_match", F.col("n_without") == 0)
