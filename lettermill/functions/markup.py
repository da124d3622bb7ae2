"""Stripping of HTML by a parser, for where patterns are not enough. A strategy for operators.mime."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Tags that link, the attribute of each, and tags whose content isn't shown.
LINKS = {"a": "href", "area": "href", "img": "src", "form": "action", "source": "src", "iframe": "src"}
HIDDEN = ("script", "style")


class _Page(HTMLParser):
    """Collects the shown text, piece by piece, and the links of each kind of tag."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.pieces: list[str] = []
        self.links: dict[str, list[str]] = {tag: [] for tag in LINKS}
        self.hidden = 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in HIDDEN
        if value := dict(attrs).get(LINKS.get(tag)):
            self.links[tag].append(value.strip())

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.hidden -= tag in HIDDEN and self.hidden > 0

    def handle_data(self, data):
        if not self.hidden:
            self.pieces.append(data)


def strip(page: str | None) -> tuple[str, list[str]]:
    """The shown text, pieces joined by spaces, and the links, tag by tag in the order of LINKS. Null is empty."""
    parser = _Page()
    parser.feed(page or "")
    parser.close()
    return " ".join(parser.pieces), [u for found in parser.links.values() for u in found]


def strip_parts(parts: Column) -> Column:
    """An array of HTML parts to struct<texts, links>: each part's text, and the links of all. Null gives null."""

    @F.pandas_udf("texts array<string>, links array<string>")
    def run(arrays: pd.Series) -> pd.DataFrame:
        done = [None if a is None else [strip(p) for p in a] for a in arrays]
        return pd.DataFrame({"texts": [None if d is None else [t for t, _ in d] for d in done], "links": [None if d is None else [u for _, us in d for u in us] for d in done]})

    return run(parts)
