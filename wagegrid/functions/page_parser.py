"""Fields of nested markup, read inside Spark tasks one Arrow batch at a time.

Nested elements (a card inside a page, a description with blocks in it) cannot
be cut out by patterns.  This small helper walks a page once with the standard
library's tokenizer and keeps the first match of every wanted field.
"""

from __future__ import annotations

import html as html_entities
from collections import Counter
from collections.abc import Iterable
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

Want = tuple[str | None, str | None, str | None]
Field = tuple[str | None, str | None, str | None, str]

_VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input",
    "link", "meta", "param", "source", "track", "wbr",
}


def _is(tag: str, attrs: dict, want: Iterable) -> bool:
    wanted_tag, attribute, value = tuple(want)[:3]
    if wanted_tag is not None and tag != wanted_tag:
        return False
    if attribute is None:
        return True
    if attribute not in attrs:
        return False
    found = attrs[attribute] or ""
    if value is None or found == value:
        return True
    return attribute == "class" and value in found.split()


class _Card:
    """A record that is open: the fields it still lacks, and those being read."""

    __slots__ = ("record", "lacking", "taking")

    def __init__(self, fields: Iterable[str]):
        self.record: dict[str, str | None] = {}
        self.lacking = set(fields)
        self.taking: dict[str, tuple[str, list[str]]] = {}


class _Walk(HTMLParser):
    """Collects one record per card (or one per page when no card is asked for).

    What stands in a card belongs to the innermost one that is open, so that every piece of
    a page is read for one card only, however many are left open.
    """

    def __init__(self, cards: list[Want] | None, fields: dict[str, Field]):
        super().__init__(convert_charrefs=True)
        self.cards, self.fields = cards, fields
        self.records: list[dict] = []
        self.open: Counter[str] = Counter()  # open elements by tag
        self.path: list[tuple[str, list]] = []  # open elements and what ends with them
        self.nested: list[_Card] = []  # open cards, the innermost last
        self.unseen = 0
        if cards is None:
            self._open_card()

    def _open_card(self) -> _Card:
        card = _Card(self.fields)
        self.records.append(card.record)
        self.nested.append(card)
        return card

    def _add_markup(self, text: str) -> None:
        if self.nested:
            for take, parts in self.nested[-1].taking.values():
                if take == "html":
                    parts.append(text)

    def _start(self, tag: str, pairs: list, closes_at_once: bool) -> None:
        attrs = {name: value for name, value in reversed(pairs)}
        raw, ends = self.get_starttag_text() or "", []
        is_card = self.cards is not None and any(_is(tag, attrs, card) for card in self.cards)
        if not is_card:
            self._add_markup(raw)
        if self.nested:
            card = self.nested[-1]
            for name in [n for n in self.fields if n in card.lacking and _is(tag, attrs, self.fields[n])]:
                card.lacking.discard(name)
                take = self.fields[name][3]
                if take in ("text", "html"):
                    card.taking[name] = (take, [raw] if take == "html" else [])
                    ends.append((card, name))
                else:
                    card.record[name] = attrs.get(take)
        if is_card:
            ends.append((self._open_card(), None))
        self.path.append((tag, ends))
        self.open[tag] += 1
        if tag in ("script", "style"):
            self.unseen += 1
        if closes_at_once:
            self._close(write_end=False)

    def _close(self, write_end: bool = True) -> None:
        tag, ends = self.path.pop()
        self.open[tag] -= 1
        if tag in ("script", "style"):
            self.unseen -= 1
        if write_end and not any(name is None for _, name in ends):
            self._add_markup(f"</{tag}>")
        for card, name in reversed(ends):
            if name is None:
                self.nested.pop()
            else:
                card.record[name] = "".join(card.taking.pop(name)[1])

    def handle_starttag(self, tag, attrs):
        self._start(tag, attrs, tag in _VOID)

    def handle_startendtag(self, tag, attrs):
        self._start(tag, attrs, True)

    def handle_endtag(self, tag):
        if self.open[tag]:
            while self.path[-1][0] != tag:
                self._close()
            self._close()

    def handle_data(self, data):
        if self.nested:
            for take, parts in self.nested[-1].taking.values():
                if take == "html":
                    parts.append(data if self.unseen else html_entities.escape(data, quote=False))
                elif not self.unseen:
                    parts.append(data)

    def handle_comment(self, data):
        self._add_markup(f"<!--{data}-->")

    def finish(self) -> list[dict]:
        self.close()
        while self.path:
            self._close()
        return [{name: r.get(name) for name in self.fields} for r in self.records]


def read_fields(
    markup: str | Column, fields: dict[str, Field], cards: list[Want] | None = None
) -> Column:
    """Array of structs, one per card in page order (one per page without ``cards``).

    Every field is the first match inside its card: its text, its markup
    (``html``) or one of its attributes; null when there is no match.
    """
    kind = pa.list_(pa.struct([(name, pa.string()) for name in fields]))
    ddl = ", ".join(f"`{name}`: string" for name in fields)

    @F.arrow_udf(f"array<struct<{ddl}>>")
    def read(pages: pa.Array) -> pa.Array:
        found = []
        for page in pages.to_pylist():
            if page is None:
                found.append([])
                continue
            walk = _Walk(cards, fields)
            walk.feed(page)
            found.append(walk.finish())
        return pa.array(found, kind)

    return read(markup)
