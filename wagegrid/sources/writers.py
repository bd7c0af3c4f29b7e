"""Writing CSV files, appending to tables, exporting sheets."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wagegrid import schemas
from wagegrid.operators import cleaning

#: Rows per CSV file, so that a reader that needs whole files gets many of them.
ROWS_PER_FILE = 1_000_000
_RUN = re.compile(r"[A-Za-z0-9._-]+")


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """UTF-8 CSV with a header row; quotes are doubled, line breaks kept.

    Missing and empty texts are both read back as missing.
    """
    (
        df.write.mode(mode)
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
        .csv(path)
    )


def append_by_day(
    df: DataFrame, path: str, stamp: str, day_column: str = "search_date", run: str | None = None
) -> None:
    """Append to a table partitioned by the day of ``stamp``.

    ``rebalance`` puts rows of a day together, so that tasks do not each write
    a sliver of every day; AQE splits a day that is too big for one task.

    With ``run`` the rows go to the partition of that run, whose days are partitions in
    turn, and replace all that an earlier attempt of the run left there: a run that is repeated,
    with the same or with other rows, counts once.  A table is written with runs or without.
    """
    dated = df.withColumn(day_column, F.to_date(stamp)).hint("rebalance", day_column)
    if run is None:
        dated.write.mode("append").partitionBy(day_column).parquet(path)
    else:
        write_run(dated, path, run, day_column)


def write_run(df: DataFrame, path: str, run: str, *partitions: str) -> None:
    """Make ``df`` the rows of a run in a table partitioned by run, then by ``partitions``.

    Only that run's folder is overwritten; other runs are neither read nor listed.
    """
    if not _RUN.fullmatch(run):
        raise ValueError(f"run names are letters, digits, '.', '_' and '-': {run!r}")
    df.write.mode("overwrite").partitionBy(*partitions).parquet(f"{path}/run={run}")


def append_search_day(
    df: DataFrame, path: str, stamp: str = "search_datetime", run: str | None = None
) -> None:
    """Append search rows to their day (in place of one table per day)."""
    append_by_day(df, path, stamp, run=run)


def append_details(
    df: DataFrame, path: str, schema: T.StructType = schemas.JOB_DETAILS,
    stamp: str = "search_detail_datetime", run: str | None = None,
) -> None:
    """Cast to the table's types and order, then append by day of ``stamp``."""
    append_by_day(cleaning.cast_to(df, schema), path, stamp, day_column="detail_date", run=run)


def as_sheet(df: DataFrame) -> DataFrame:
    """Every value as text, missing values (null and NaN) as empty text."""
    cells = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            value = F.nanvl(value, F.lit(None).cast(field.dataType))
        cells.append(F.coalesce(value.cast("string"), F.lit("")).alias(field.name))
    return df.select(*cells)


def export_sheet(df: DataFrame, path: str, clear: bool = True) -> None:
    """Header row and text cells as CSV; ``clear`` replaces the target first."""
    (
        as_sheet(df)
        .write.mode("overwrite" if clear else "append")
        .option("header", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .csv(path)
    )
