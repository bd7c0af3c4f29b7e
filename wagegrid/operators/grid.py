"""Search requests and the addresses they ask for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagegrid import fixed_values, schemas, settings


def _terms(text: str | Column) -> Column:
    """Comma-separated terms without quotes and blanks."""
    return F.split(F.translate(text, "' ", ""), ",")


def parse_search_request(df: DataFrame, column: str) -> DataFrame:
    """JSON ``{"titles": ..., "locations": ...}`` to two arrays; the column is replaced.

    A text that is no such object gives null arrays.
    """
    request = F.from_json(column, schemas.SEARCH_REQUEST)
    return (
        df.withColumn("_request", request)
        .withColumns(
            {
                "titles": _terms("_request.titles"),
                "locations": _terms("_request.locations"),
            }
        )
        .drop("_request", column)
    )


def search_url(title: str | Column, location: str | Column) -> Column:
    return F.format_string(fixed_values.SEARCH_URL, title, location)


def search_grid(requests: DataFrame) -> DataFrame:
    """Every title with every place of the same request, and the address to read.

    Both lists sit in the request's row, so the grid is made row by row:
    no join and no shuffle.
    """
    titled = settings.unfolded(requests, "titles", "search_title")
    placed = settings.unfolded(titled, "locations", "search_location")
    return placed.drop("titles", "locations").withColumn(
        "url", search_url("search_title", "search_location")
    )


def cross_grid(rows: DataFrame, terms: DataFrame, column: str) -> DataFrame:
    """Every row with every distinct term, a missing one included.

    This product is the operator's meaning; Spark sends round a side that is small
    by its own limit.  A column of the same name in ``rows`` is replaced.
    """
    return rows.drop(column).crossJoin(terms.select(column).distinct())


def paginate(
    df: DataFrame, place: str, max_results: int = fixed_values.MAX_RESULTS_PER_PLACE,
    step: int = fixed_values.PAGE_STEP,
) -> DataFrame:
    """Result offsets 0, 10, .. below ``max_results`` for each row, with the address."""
    if max_results <= 0:
        df, max_results = df.limit(0), 1
    offsets = F.sequence(F.lit(0), F.lit(max_results - 1), F.lit(step))
    return df.withColumn("start", F.explode(offsets)).withColumn(
        "url", F.format_string(fixed_values.LISTING_URL, place, F.col("start").cast("string"))
    )


def distinct_places(df: DataFrame, place: str) -> DataFrame:
    """Each place once."""
    return df.select(place).dropDuplicates()


def default_places(spark) -> DataFrame:
    """The places searched by default, as a one-column frame."""
    return distinct_places(
        spark.createDataFrame([(p,) for p in fixed_values.PLACES], "place string"), "place"
    )
