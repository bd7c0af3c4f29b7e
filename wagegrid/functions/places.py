"""Places: ``City, ST 12345`` to city, state and initials."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def split_location(df: DataFrame, column: str = "Location") -> DataFrame:
    """Cut at the first comma.  ``State`` keeps its leading blank; no comma, no state."""
    parts = F.split(column, ",", 2)
    return df.withColumns({"City": F.get(parts, F.lit(0)), "State": F.get(parts, F.lit(1))})


def state_initials(df: DataFrame, column: str = "State", trim: bool = False) -> DataFrame:
    """First three characters of the state part: a blank and two letters."""
    initials = F.substring(column, 1, 3)
    return df.withColumn("State Initials", F.trim(initials) if trim else initials)
