"""Anchors of pages, read as HTML.

A page is taken apart into tags, comments, raw text and character references by the standard
library's tokenizer, a batch of pages at a time; what stands in comments, scripts and styles is no link.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from gridloom.sources.files import ship

# Elements that have no content, and those whose content is no text of the page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style template".split())


class Anchors(HTMLParser):
    """Collects (href, text) of the anchors that have an href, in order.

    The text is that of all text nodes inside, each stripped. An anchor that is not closed ends with the element
    around it."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, list | None]] = []
        self.found: list[tuple[str, list]] = []
        self.data: list[str] = []

    def flush(self):
        text = "".join(self.data).strip()
        self.data = []
        if text and not (self.open and self.open[-1][0] in HIDDEN):
            for _, parts in self.open:
                if parts is not None:
                    parts.append(text)

    def handle_starttag(self, tag, attrs):
        self.flush()
        parts = None
        hrefs = [v or "" for k, v in attrs if k == "href"] if tag == "a" else []
        if hrefs:
            parts = []
            self.found.append((hrefs[-1], parts))
        if tag not in VOID:
            self.open.append((tag, parts))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.flush()
        at = next((i for i in range(len(self.open) - 1, -1, -1) if self.open[i][0] == tag), None)
        if at is not None:
            del self.open[at:]

    def handle_data(self, data):
        self.data.append(data)

    def handle_comment(self, data):
        self.flush()

    handle_decl = handle_pi = unknown_decl = handle_comment


def anchors(html: str | None) -> list[dict]:
    if not html or "href" not in html.lower():
        return []
    parser = Anchors()
    parser.feed(html)
    parser.close()
    parser.flush()
    return [{"ordinal": i, "href": href, "text": "".join(parts)} for i, (href, parts) in enumerate(parser.found)]


ANCHORS = "array<struct<ordinal:int,href:string,text:string>>"
TYPE = pa.list_(pa.struct([("ordinal", pa.int32()), ("href", pa.string()), ("text", pa.string())]))


def with_anchors(pages: DataFrame, html: str, name: str) -> DataFrame:
    """The rows with `name`, an array of (ordinal, href, text), in place of the page."""
    ship(pages.sparkSession)
    others = [c for c in pages.columns if c != html]

    def run(batches):
        for batch in batches:
            found = pa.array([anchors(h.as_py()) for h in batch.column(len(others))], TYPE)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(others)], found], names=[*others, name])

    kinds = dict(pages.dtypes)
    return pages.select(*others, html).mapInArrow(run, ", ".join([*(f"`{c}` {kinds[c]}" for c in others), f"`{name}` {ANCHORS}"]))
