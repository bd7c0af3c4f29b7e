"""Flat markup by native expressions; Python is used for entities only."""

from __future__ import annotations

import html as html_entities

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wagegrid import fixed_values

COMMENT = r"(?s)<!--.*?-->"
UNSEEN = r"(?is)<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>"
# Possessive, so that matching never recurses; a tag whose quotes do not pair ends at its first ">".
TAG = r"""(?s)</?[a-zA-Z!?](?:[^>"']++|"[^"]*+"|'[^']*+')*+>|</?[a-zA-Z!?][^>]*+>"""

#: End tags that also end an item of the given kind when its own end tag is missing.
ITEM_ENDS = {
    "li": r"(?is)</(?:li|ul|ol|menu|nav|article|section|main|body)\b.*",
    "p": r"(?is)</(?:p|li|ul|ol|td|th|div|article|section|main|body)\b.*",
}


@F.arrow_udf(T.StringType())
def decode_entities(text: pa.Array) -> pa.Array:
    """``&amp;``, ``&#233;``, ``&hellip;`` ... to characters."""
    return pa.array(
        [t if t is None or "&" not in t else html_entities.unescape(t) for t in text.to_pylist()],
        pa.string(),
    )


def drop_unseen(markup: str | Column) -> Column:
    """Without comments, scripts and style sheets."""
    return F.regexp_replace(F.regexp_replace(markup, COMMENT, ""), UNSEEN, "")


def drop_tags(markup: str | Column) -> Column:
    """Markup without its tags; entities stay as they are."""
    return F.regexp_replace(markup, TAG, "")


def trim_blanks(text: str | Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def strip_tags(markup: str | Column) -> Column:
    """The text of a page: no comments, scripts, styles or tags, entities decoded."""
    return trim_blanks(decode_entities(drop_tags(drop_unseen(markup))))


def list_items(markup: str | Column, tag: str) -> Column:
    """Inner markup of all ``tag`` elements (``li`` or ``p``), in page order.

    An item runs from its start tag to its end tag, the next start tag of the
    same kind, or the end of the block it stands in.
    """
    pieces = F.split(drop_unseen(markup), rf"(?i)<{tag}(?:\s[^>]*)?>")
    items = F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))
    return F.transform(items, lambda item: F.regexp_replace(item, ITEM_ENDS[tag], ""))


def first_element(markup: str | Column, tag: str) -> Column:
    """Inner markup of the first ``tag`` element that holds no other of its kind."""
    inner = F.regexp_extract(markup, rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}\s*>", 1)
    return F.nullif(inner, F.lit(""))


def first_attribute(markup: str | Column, tag: str, attribute: str) -> Column:
    """A quoted attribute of the first ``tag`` element that has it."""
    value = F.regexp_extract(
        markup, rf'(?is)<{tag}\b[^>]*?\s{attribute}\s*=\s*"([^"]*)"', 1
    )
    return F.nullif(value, F.lit(""))


def job_id_of_link(link_id: str | Column) -> Column:
    """Posting id: the ``id`` of the card's first link without its three-letter mark."""
    return F.nullif(F.substr(link_id, F.lit(fixed_values.ID_PREFIX_LENGTH + 1)), F.lit(""))


def after_last_equals(text: str | Column) -> Column:
    """The part behind the last ``=`` (the whole text without one)."""
    return F.element_at(F.split(text, "="), -1)


def posting_url(job_id: str | Column) -> Column:
    """Address of a posting's page."""
    return F.concat(F.lit(fixed_values.POSTING_URL), job_id)


def url_host(url: str | Column) -> Column:
    return F.try_parse_url(url, F.lit("HOST"))


def url_parameter(url: str | Column, name: str) -> Column:
    return F.try_parse_url(url, F.lit("QUERY"), F.lit(name))
