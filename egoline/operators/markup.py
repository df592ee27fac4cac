"""Follow links of stored pages by a markup tokenizer.

The tokenizer of Python's standard library runs over each page inside the task
(attributes in any quoting, comments, scripts, all character references); a
stack of open elements on top of it tells what lies inside what.
"""

from __future__ import annotations

from collections import Counter
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from egoline.functions.constants import FOLLOW_LINK_CLASS

#: Elements that have no content and no end tag (fixed by the markup language).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
LINKS = pa.list_(pa.struct([("slug", pa.string()), ("text", pa.string())]))


class FollowLinks(HTMLParser):
    """The first anchor inside every heading of the class, with the text inside the anchor as it stands."""

    def __init__(self, cls: str = FOLLOW_LINK_CLASS):
        super().__init__(convert_charrefs=True)
        self.cls = cls
        self.open: list[str] = []
        self.count: Counter[str] = Counter()  # of the open elements
        self.headings: list[dict] = []  # in order of their start tags
        self.inside: list[dict] = []  # the open ones; "in" is their depth
        self.anchors: list[dict] = []  # the open ones

    def handle_starttag(self, tag, attrs):
        values = dict(attrs)
        if tag not in VOID:
            self.open.append(tag)
            self.count[tag] += 1
        depth = len(self.open)
        if tag == "h3" and self.cls in (values.get("class") or "").split():
            self.headings.append({"in": depth, "anchor": None})
            self.inside.append(self.headings[-1])
        elif tag == "a":
            wanting = [h for h in self.inside if h["anchor"] is None]
            if wanting:
                anchor = {"in": depth, "href": values.get("href"), "text": []}
                self.anchors.append(anchor)
                for h in wanting:
                    h["anchor"] = anchor

    def handle_endtag(self, tag):
        if not self.count[tag]:
            return
        closed = None
        while closed != tag:
            closed = self.open.pop()
            self.count[closed] -= 1
        depth = len(self.open)
        if self.anchors or self.inside:
            self.anchors = [a for a in self.anchors if a["in"] <= depth]
            self.inside = [h for h in self.inside if h["in"] <= depth]

    def handle_data(self, data):
        if self.anchors and self.open[-1] not in ("script", "style"):
            for a in self.anchors:
                a["text"].append(data)

    def links(self) -> list[dict]:
        found = [h["anchor"] for h in self.headings if h["anchor"] and h["anchor"]["href"] is not None]
        return [{"slug": a["href"][1:], "text": "".join(a["text"])} for a in found]


def links_of(html: str | None, cls: str = FOLLOW_LINK_CLASS) -> list[dict]:
    """The links of one page; markup that the tokenizer rejects ends it there."""
    parser = FollowLinks(cls)
    try:
        parser.feed(html or "")
        parser.close()
    except AssertionError:  # how the tokenizer rejects a declaration
        pass
    return parser.links()


def with_follow_links(pages: DataFrame, html: str = "html", name: str = "links", cls: str = FOLLOW_LINK_CLASS) -> DataFrame:
    """``pages`` without its markup and with ``name``: ``array<struct<slug, text>>``.

    A null page has no links. A heading whose first anchor has no target, or
    without an anchor, is left out. The slug is the target without its first character.
    """
    at = pages.columns.index(html)
    rest = [c for c in pages.columns if c != html]

    def work(batches):
        for b in batches:
            for first in range(0, b.num_rows, 64):  # few parsed pages at a time
                part = b.slice(first, 64)
                found = [links_of(h, cls) for h in part.column(at).to_pylist()]
                yield pa.record_batch([*(part.column(c) for c in rest), pa.array(found, LINKS)], [*rest, name])
    schema = pages.select(*rest, F.lit(None).cast("array<struct<slug:string,text:string>>").alias(name)).schema
    return pages.mapInArrow(work, schema)


def extract_follow_links(pages: DataFrame, key: str = "url", html: str = "html", cls: str = FOLLOW_LINK_CLASS) -> DataFrame:
    """``(key, pos, slug, text)`` for every follow link of a stored page, ``pos`` from 1."""
    z = with_follow_links(pages.select(key, html), html, "links", cls).select(key, F.posexplode("links").alias("pos", "z"))
    return z.select(key, (F.col("pos") + 1).alias("pos"), "z.slug", "z.text")
