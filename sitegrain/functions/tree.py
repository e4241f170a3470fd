"""Address facts of a page that need its tree: microdata by scope, data attributes by element, maps, footers, headings.

The standard library's parser streams a page's events; nothing but the open elements is kept. Python runs over Arrow
batches and only here, as regular expressions can't tell which element encloses which.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import parse_qs, unquote_plus, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements without content, microdata properties of an address in their order, attributes that hold parts.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
PROPERTIES = ["name", "streetAddress", "addressLocality", "addressRegion", "postalCode", "telephone"]
STREET_ATTRIBUTES = ["data-street", "data-address", "data-addr"]
PART_ATTRIBUTES = ["data-city", "data-state", "data-zip"]
ZIP = re.compile(r"\b\d{5}(?:-\d{4})?\b")
CUT, HEADING_CUT, FOOTER_CUT, BLOCK_ELEMENTS = 200, 100, 1500, 8
FACTS = "ord long, kind string, fact string"


def _squeezed(text: str) -> str:
    return " ".join(text.split())


def map_place(url: str) -> str:
    """The place that a map address asks for: its query, else its place path; '' for other addresses."""
    try:
        parts = urlsplit(url)
    except ValueError:
        return ""
    if "maps" not in parts.netloc + parts.path or "google" not in parts.netloc:
        return ""
    asked = parse_qs(parts.query)
    for key in ("daddr", "destination", "q"):
        if asked.get(key, [""])[0].strip():
            return _squeezed(asked[key][0])[:CUT]
    path = re.search(r"/(?:place|dir)//?([^/@]+)", parts.path)
    embedded = re.search(r"!2s([^!]+)", parts.query)
    return _squeezed(unquote_plus((path or embedded)[1]))[:CUT] if path or embedded else ""


class Facts(HTMLParser):
    """``found``: (kind, fact) in the page's order."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[str, str]] = []
        self.seen: set[tuple[str, str]] = set()
        self.open: list[tuple[str, str | None, int]] = []
        self.scopes: list[dict[str, str]] = []
        self.footer = self.silent = 0
        self.footer_text: list[str] = []
        self.heading: list[str] | None = None
        self.titled: tuple[str, list[str], int] | None = None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        given = {k: v or "" for k, v in attrs}
        for key in ("src", "href"):
            if place := map_place(given.get(key, "")):
                self._add("map", place)
        label = re.sub(r"(?i)\s*<br\s*/?>\s*", " | ", given.get("data-label", ""))
        if ZIP.search(label):
            self._add("data", _squeezed(label))
        street = next((given[k] for k in STREET_ATTRIBUTES if given.get(k)), "")
        if street:
            self._add("data", ", ".join([_squeezed(street), *[_squeezed(given[k]) for k in PART_ATTRIBUTES if given.get(k)]]))
        if tag in VOID:
            return
        is_footer = tag == "footer" or (tag in ("div", "section") and re.search(r"\bfooter", given.get("class", "")) is not None)
        marks = (2 if "itemscope" in given else 0) + (1 if is_footer else 0)
        if marks & 2:
            self.scopes.append({})
        self.footer += marks & 1
        self.silent += tag in ("script", "style")
        if re.fullmatch("h[1-4]", tag):
            self._end_block()
            self.heading = []
        elif self.titled:
            self.titled = (*self.titled[:2], self.titled[2] + 1)
        self.open.append((tag, given.get("itemprop"), marks))

    def handle_endtag(self, tag: str) -> None:
        if tag not in (t for t, _, _ in self.open):
            return
        while True:
            name, _, marks = self.open.pop()
            if marks & 2:
                parts = self.scopes.pop()
                if len(parts) >= 2:
                    self._add("microdata", ", ".join(parts[p] for p in PROPERTIES if p in parts))
            self.footer -= marks & 1
            self.silent -= name in ("script", "style")
            if self.heading is not None and re.fullmatch("h[1-4]", name):
                title = _squeezed("".join(self.heading))
                self.heading = None
                if 0 < len(title) <= HEADING_CUT:
                    self.titled = (title, [], 0)
            if name == tag:
                return

    def handle_data(self, data: str) -> None:
        if self.silent or not data.strip():
            return
        if self.footer:
            self.footer_text.append(data)
        if self.heading is not None:
            self.heading.append(data)
        elif self.titled and self.titled[2] <= BLOCK_ELEMENTS:
            self.titled[1].append(data)
        prop = self.open[-1][1] if self.open else None
        if prop in PROPERTIES and self.scopes:
            self.scopes[-1].setdefault(prop, _squeezed(data))

    def _end_block(self) -> None:
        if self.titled:
            text = _squeezed(" ".join(self.titled[1]))
            if ZIP.search(text):
                self._add("heading", f"{self.titled[0]} | {text}")
        self.titled = None

    def _add(self, kind: str, fact: str) -> None:
        fact = fact[:CUT]
        if len(fact) > 5 and (kind, fact) not in self.seen:
            self.seen.add((kind, fact))
            self.found.append((kind, fact))

    def close(self) -> None:
        super().close()
        self._end_block()
        if text := _squeezed(" ".join(self.footer_text)):
            self.found.append(("footer", text[:FOOTER_CUT]))


def facts_of(html: str | None) -> list[tuple[str, str]]:
    """(kind, fact), distinct: map places, data attributes, microdata scopes of two parts or more, headings whose text has
    a postal code, and the footer's text. Null and empty html has none.
    """
    page = Facts()
    page.feed(html or "")
    page.close()
    return page.found


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(o, *f) for o, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for f in facts_of(h)]
        cols = list(zip(*rows)) if rows else [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.string()))], ["ord", "kind", "fact"])


def page_facts(pages: DataFrame) -> DataFrame:
    """(ord, kind, fact) of every page (``ord, html``; other columns are ignored)."""
    return pages.select(F.col("ord").cast("long"), "html").mapInArrow(_rows, FACTS)
