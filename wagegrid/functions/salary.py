"""Salary text to numbers, as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagegrid import fixed_values

#: An amount behind a dollar sign; group 1 is the number, group 2 a ``K``.
AMOUNT = r"\$\s*([0-9][0-9,]*(?:\.[0-9]+)?)([kK]\b)?"
#: The same number with cents behind it, as it stands in the text.
AMOUNT_WITH_CENTS = r"\$\s*[0-9][0-9,]*\.[0-9]{2}\b"


def find_money(text: str | Column, with_cents: bool = False) -> Column:
    """All money strings of a text, in order: numbers, or whole strings with cents."""
    if with_cents:
        return F.regexp_extract_all(text, F.lit(AMOUNT_WITH_CENTS), F.lit(0))
    return F.regexp_extract_all(text, F.lit(AMOUNT), F.lit(1))


def _number(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit("")).try_cast("double")


def _amounts(text: str | Column, thousands: bool) -> Column:
    plain = find_money(text)
    if not thousands:
        return F.transform(plain, _number)
    marks = F.regexp_extract_all(text, F.lit(AMOUNT), F.lit(2))
    return F.zip_with(
        plain, marks, lambda n, k: F.when(k != "", _number(n) * 1000).otherwise(_number(n))
    )


def mean_present(*columns: str | Column) -> Column:
    """Mean of the values that are there; null when none is."""
    cols = [F.col(c) if isinstance(c, str) else c for c in columns]
    total = sum((F.coalesce(c, F.lit(0.0)) for c in cols), F.lit(0.0))
    seen = sum((c.isNotNull().cast("int") for c in cols), F.lit(0))
    return F.when(seen > 0, total / seen)


def parse_salary(
    df: DataFrame, column: str = "Salary", *, mode: str = "amounts",
    thousands: bool = False, keep: bool = False,
) -> DataFrame:
    """Replace a salary text by ``Low``, ``High`` and ``Average``.

    ``mode="amounts"`` reads amounts behind a dollar sign.  ``mode="reference"``
    blanks out all that is no digit and cuts at the first three blanks in a
    row, with its known effects on cents and leading blanks.
    """
    if mode == "amounts":
        parts = df.withColumn("_parts", _amounts(column, thousands))
        low, high = F.get("_parts", F.lit(0)), F.get("_parts", F.lit(1))
    elif mode == "reference":
        digits = F.regexp_replace(F.replace(column, F.lit("$"), F.lit("")), r"[^0-9]", ",")
        parts = df.withColumn("_parts", F.split(digits, ",,,", 2))
        low, high = (_number(F.get("_parts", F.lit(i))) for i in (0, 1))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    parsed = (
        parts.withColumns({"Low": low, "High": high})
        .withColumn("Average", mean_present("Low", "High"))
        .drop("_parts")
    )
    return parsed if keep else parsed.drop(column)


def is_annual(
    column: str | Column, units: tuple[str, ...] = fixed_values.OTHER_UNITS
) -> Column:
    """True when none of ``units`` is in the text (case counts); null for null."""
    text = F.col(column) if isinstance(column, str) else column
    kept = F.lit(True)
    for unit in units:
        kept = kept & ~text.contains(unit)
    return kept
