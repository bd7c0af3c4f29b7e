"""Word flags of a title."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column
from pyspark.sql import functions as F


def flag(column: str, word: str) -> Column:
    """1 when the word is in the text (case counts), else 0, also for null."""
    return F.coalesce(F.col(column).contains(word).cast("int"), F.lit(0))


def flag_vector(column: str, words: list[str]) -> Column:
    """The flags of a text as one vector."""
    return array_to_vector(F.array(*[flag(column, w).cast("double") for w in words]))
