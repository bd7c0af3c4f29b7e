"""Captured pages to posting rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagegrid import fixed_values, settings
from wagegrid.functions import markup
from wagegrid.functions.page_parser import Field, Want, read_fields


def explode_cards(
    pages: DataFrame, html: str = "html", *, keep: tuple[str, ...] = ("page_id",),
    cards: list[Want] | None = None, fields: dict[str, Field] | None = None,
) -> DataFrame:
    """One row per result card: ``keep``, ``card_no`` (from 0) and the raw fields."""
    found = read_fields(
        html, fields or fixed_values.CARD_FIELDS, cards or fixed_values.CARD
    )
    return pages.select(*keep, F.posexplode(found).alias("card_no", "card")).select(
        *keep, "card_no", "card.*"
    )


def _clean(text: str | Column) -> Column:
    return F.nullif(markup.trim_blanks(text), F.lit(""))


def card_salary(*sources: str) -> Column:
    """The first salary text that is there, of several places to look."""
    return F.coalesce(*[_clean(s) for s in sources])


def card_fields(cards: DataFrame, keep: tuple[str, ...] = ("page_id", "card_no")) -> DataFrame:
    """Posting fields of exploded cards; what is missing is null."""
    no_breaks = F.translate("place", "\n", "")
    return cards.select(
        *keep,
        F.coalesce(_clean("title_link"), _clean("title_any")).alias("title"),
        F.nullif(no_breaks, F.lit("")).alias("location"),
        F.coalesce(_clean("company_name"), _clean("company_any")).alias("company"),
        card_salary("salary_nobr", "salary_span").alias("salary"),
        _clean("summary").alias("synopsis"),
        markup.job_id_of_link("link_id").alias("job_id"),
    )


def search_rows(
    pages: DataFrame, stamp: Column, html: str = "html",
    keep: tuple[str, ...] = ("search_title", "search_location"), **places,
) -> DataFrame:
    """Pages of a search to the rows that are stored for it."""
    exploded = explode_cards(pages, html, keep=keep, **places)
    cards = card_fields(exploded, keep=(*keep, "card_no"))
    return cards.select(
        F.date_trunc("minute", stamp).alias("search_datetime"),
        *keep, "title", "location", "company", "job_id",
    )


def detail_fields(
    pages: DataFrame, html: str = "html", *, keep: tuple[str, ...] = ("page_id",),
    fields: dict[str, Field] | None = None,
) -> DataFrame:
    """One row per posting page; rating and its count are 0 when missing.

    ``fields`` may replace the places looked at, by the names of
    ``fixed_values.POSTING_FIELDS``.
    """
    found = read_fields(html, {**fixed_values.POSTING_FIELDS, **(fields or {})})
    raw = pages.select(*keep, F.get(found, F.lit(0)).alias("d"))
    return raw.select(
        *keep,
        markup.after_last_equals("d.share_url").alias("job_id"),
        _clean("d.title").alias("desc_title"),
        F.col("d.job_desc").alias("job_desc"),
        _clean("d.company").alias("desc_company"),
        F.coalesce(F.col("d.rating").try_cast("double"), F.lit(0.0)).alias("company_rating"),
        F.coalesce(F.col("d.rating_count").try_cast("int"), F.lit(0)).alias(
            "company_rating_count"
        ),
    )


def rejects(details: DataFrame) -> DataFrame:
    """Pages without a posting id; they cannot be joined and are kept apart."""
    return details.where(F.col("job_id").isNull())


def list_items(
    pages: DataFrame, tag: str, html: str = "html", keep: tuple[str, ...] = ("page_id",)
) -> DataFrame:
    """All ``li`` or ``p`` of a page in order: ``keep``, ``item_no``, ``item``."""
    items = settings.unfolded(
        pages.select(*keep, html), markup.list_items(html, tag), "item", "item_no"
    )
    return items.drop(html).withColumn("item", markup.trim_blanks(markup.drop_tags("item")))
