"""Reading tables, days, ranges, CSV listings and captured pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wagegrid import fixed_values, schemas
from wagegrid.sources.csv_rows import csv_rows


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A whole table: a catalog name, or a path to parquet files."""
    if "/" in name:
        return spark.read.parquet(name)
    return spark.table(name)


def read_projected(spark: SparkSession, name: str, columns: dict[str, str]) -> DataFrame:
    """Some columns under new names (``{column: new name}``); only these are scanned."""
    return read_table(spark, name).select(
        *[F.col(column).alias(alias) for column, alias in columns.items()]
    )


def read_new_ids(spark: SparkSession, name: str) -> DataFrame:
    """The list of postings still to be loaded, as the detail job wants it."""
    kept = ["title", "location", "company", "search_title", "search_location"]
    return read_projected(
        spark,
        name,
        {"job_id": "job_id", "new_search_datetime": "search_datetime", **{c: c for c in kept}},
    )


def read_day(spark: SparkSession, path: str, day: str) -> DataFrame:
    """One day (``yyyy-MM-dd``) of a table partitioned by ``search_date``.

    The filter is on the partition column, so other days are not listed or read.
    """
    return spark.read.parquet(path).where(F.col("search_date") == F.lit(day).cast("date"))


def read_date_range(df: DataFrame, column: str, first: str, last: str) -> DataFrame:
    """Rows between two stamps, both ends in; a bare date means its midnight.

    The ends are cast to the column's own type, so the comparison stays free of
    casts on the column and reaches the parquet scan as a pushed filter.
    """
    kind = df.schema[column].dataType
    return df.where(F.col(column).between(F.lit(first).cast(kind), F.lit(last).cast(kind)))


#: How cells are read: doubled quotes, empty cells missing.
_CELLS = {"escape": '"', "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}


def read_listings_csv(
    spark: SparkSession, path: str, schema: T.StructType = schemas.LISTINGS_RAW,
    multi_line: bool = True,
) -> DataFrame:
    """CSV with a header row and a known schema; an empty cell is a missing value.

    Line breaks inside quotes are part of a cell, and files are still read by many tasks
    (``csv_rows``).  ``multi_line=False`` saves one of the two passes for files known
    to hold one row per line.
    """
    if not multi_line:
        return spark.read.schema(schema).options(header=True, **_CELLS).csv(path)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    cells = F.from_csv("value", fields, {**_CELLS, "multiLine": "true"})
    return csv_rows(spark, path).select(cells.alias("cells")).select("cells.*")


def drop_saved_index(df: DataFrame, name: str = "Unnamed: 0") -> DataFrame:
    """Leave out the row-position column that some writers add to a CSV."""
    return df.drop(name)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Captured pages: ``page_id``, ``url``, ``html``."""
    return spark.read.schema(schemas.PAGES).parquet(path)


def _slot(key: str | Column, seed: int) -> Column:
    """A row's place in the draw: 32 hexadecimal digits that any engine can work out again."""
    value = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.coalesce(value.cast("string"), F.lit("")), F.lit(f"#{seed}")).cast("binary"))


def sample_rows(
    df: DataFrame, share: float = fixed_values.SAMPLE_SHARE, *,
    key: str | Column | None = None, seed: int = 42,
) -> DataFrame:
    """Random rows.  With ``key`` the choice depends on the key alone, so that a
    repeated or retried run keeps the same rows; without it rows are drawn anew.
    """
    if key is None:
        return df.sample(withReplacement=False, fraction=share)
    first = F.conv(F.substring(_slot(key, seed), 1, 8), 16, 10).cast("long")
    return df.where(first < F.lit(int(round(share * 2**32))))


def sample_exactly(df: DataFrame, k: int, key: str, *, by: tuple[str, ...] = (), seed: int = 42) -> DataFrame:
    """Exactly ``k`` random rows, or ``k`` of each group of ``by`` (all, if there are fewer).

    The rows with the smallest slots are the sample, equal slots by key.  Tasks keep the
    ``k`` smallest they see, and the smallest of these are the smallest of all: a hot group
    sends no more than ``k`` rows per task.
    """
    slotted = df.withColumn("_slot", _slot(key, seed))
    if not by:
        return slotted.orderBy("_slot", key).limit(k).drop("_slot")
    place = F.row_number().over(Window.partitionBy(*by).orderBy("_slot", key))
    return slotted.withColumn("_place", place).where(F.col("_place") <= k).drop("_slot", "_place")
