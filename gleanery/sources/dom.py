"""Pages as rows of nodes: a tolerant HTML reader on the standard library's parser."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Empty elements, and those that a sibling or a block closes.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
CLOSED_BY = {"li": {"li"}, "p": {"p", "div", "ul", "ol", "table", "h1", "h2", "h3", "h4", "article", "section", "footer"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "tr": {"tr"}, "option": {"option"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}

NODES = "node_id int, parent_id int, tag string, attrs map<string,string>, ordinal int, path string, text string, whole_text string"


class _Reader(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[list] = [[0, -1, "#root", {}, 1, "", []]]
        self.open = [0]
        self.seen: dict[tuple[int, str], int] = {}
        self.whole: dict[int, list[str]] = {}

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        while len(self.open) > 1 and tag in CLOSED_BY.get(self.rows[self.open[-1]][2], ()):
            self.open.pop()
        parent = self.open[-1]
        ordinal = self.seen[parent, tag] = self.seen.get((parent, tag), 0) + 1
        self.rows.append([len(self.rows), parent, tag, {k: v or "" for k, v in attrs}, ordinal, "", []])
        if tag not in VOID:
            self.open.append(len(self.rows) - 1)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        depth = len(self.open)
        self.handle_starttag(tag, attrs)
        del self.open[max(depth, 1) :]

    def handle_endtag(self, tag: str) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            if self.rows[self.open[k]][2] == tag:
                del self.open[k:]
                return

    def handle_data(self, data: str) -> None:
        if data.strip():
            text = " ".join(data.split())
            self.rows[self.open[-1]][6].append(text)
            for k in self.open:  # an element's whole text holds that of all within it, in order
                self.whole.setdefault(k, []).append(text)


def read_page(html: str | None) -> list[tuple]:
    """Nodes of a page in document order, with absolute paths.

    A step has an ordinal only where siblings share its tag. ``text`` is the node's own
    text, ``whole_text`` that of the node and all within it. Null and empty pages have no nodes; unclosed elements end with their parent.

    >>> [(r[2], r[5], r[6]) for r in read_page("<ul><li>a<li>b<br>c</ul>")]
    [('ul', '/ul', ''), ('li', '/ul/li[1]', 'a'), ('li', '/ul/li[2]', 'b c'), ('br', '/ul/li[2]/br', '')]
    """
    if not html:
        return []
    reader = _Reader()
    reader.feed(html)
    reader.close()
    for r in reader.rows[1:]:
        step = f"/{r[2]}[{r[4]}]" if reader.seen[r[1], r[2]] > 1 else f"/{r[2]}"
        r[5] = reader.rows[r[1]][5] + step
    return [(*r[:6], " ".join(r[6]), " ".join(reader.whole.get(r[0], ()))) for r in reader.rows[1:]]


def nodes(pages: DataFrame, key: str, html: str) -> DataFrame:
    """``key`` and one row for each node of its page. The page itself does not travel on."""
    kind = pages.select(key).schema[0].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(k, *n) for k, h in zip(pdf[key], pdf["__html"]) for n in read_page(h)]
            yield pd.DataFrame(rows, columns=[key, *re.findall(r"(\w+) (?:int|string|map)", NODES)])

    return pages.select(key, F.col(html).alias("__html")).where(F.col("__html").isNotNull()).mapInPandas(run, f"`{key}` {kind}, {NODES}")
