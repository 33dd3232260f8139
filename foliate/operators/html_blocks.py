"""HTML to ordered text blocks, many documents at once (the one stage that needs Python)."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from foliate.arrow import prepare, releasing
from foliate.functions.encoding import decode_html

#: Elements that give blocks, and those whose subtrees go (fixed values).
BLOCK_TAGS = ("div", "p", "li", "h1", "h2", "h3", "h4", "h5", "h6")
REMOVED_TAGS = ("script", "style", "noscript", "svg", "table", "ix:header", "ix:hidden", "ix:references", "ix:resources")
VOID_TAGS = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
#: Starts of these close an open p, as HTML5 has it.
CLOSE_P = ("address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul")

_HIDDEN = re.compile(r"display:none|visibility:hidden")


class _Node:
    __slots__ = ("tag", "parts", "gone")

    def __init__(self, tag: str, gone: bool) -> None:
        self.tag, self.gone = tag, gone
        self.parts: list[_Node | str] = []


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = _Node("", False)
        self.open = [self.root]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in CLOSE_P:
            self._close("p", stop=("table", "td", "th"))
        if tag == "li":
            self._close("li", stop=("ul", "ol"))
        style = (dict(attrs).get("style") or "").replace(" ", "").lower()
        node = _Node(tag, tag in REMOVED_TAGS or bool(_HIDDEN.search(style)))
        self.open[-1].parts.append(node)
        if tag not in VOID_TAGS:
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS and ":" in tag:  # only foreign elements end themselves
            self.open.pop()

    def handle_endtag(self, tag: str) -> None:
        self._close(tag)

    def handle_data(self, data: str) -> None:
        self.open[-1].parts.append(data)

    def _close(self, tag: str, stop: tuple[str, ...] = ()) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                return
            if self.open[k].tag in stop:
                return


def _strings(node: _Node) -> Iterator[str]:
    todo: list[_Node | str] = [node]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            if x.strip():
                yield x.strip()
        elif not x.gone:
            todo.extend(reversed(x.parts))


def block_texts(page: str) -> list[str]:
    """Texts of the elements in BLOCK_TAGS without a direct child in BLOCK_TAGS, in order.

    Inline texts are stripped and joined by one space, white space is collapsed. Subtrees that are
    removed or hidden don't count, neither as text nor as children.
    """
    tree = _Tree()
    tree.feed(page)
    tree.close()
    out, todo = [], [tree.root]
    while todo:
        node = todo.pop()
        inner = [x for x in node.parts if isinstance(x, _Node) and not x.gone]
        if node.tag in BLOCK_TAGS and not any(x.tag in BLOCK_TAGS for x in inner):
            out.append(" ".join(" ".join(_strings(node)).split()))
        todo.extend(reversed(inner))
    return out


def decoded(pages: DataFrame, key: str = "page_id", content: str = "content") -> DataFrame:
    """key, html and encoding of pages in bytes; null content has neither. A worker holds one bounded batch."""
    prepare(pages.sparkSession)
    kind = pages.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(None, None) if x is None else decode_html(x) for x in batch.column(1).to_pylist()]
            columns = [pa.array([x[k] for x in found], pa.string()) for k in range(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[key, "html", "encoding"])

    return pages.select(key, content).mapInArrow(releasing(run), f"{key} {kind}, html string, encoding string")


def html_blocks(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """key, idx, text: the raw blocks of each page, empty ones included; a null page has none.

    html may hold text or bytes; bytes are decoded first. A block opens the body where a page has
    none, and what stands behind it belongs to it, as HTML parsers have it: no block is outside.
    """
    prepare(pages.sparkSession)
    kind = pages.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, places, texts = [], [], []
            for k, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if isinstance(page, bytes):
                    page = decode_html(page)[0]
                for i, t in enumerate(block_texts(page or "")):
                    keys.append(k)
                    places.append(i)
                    texts.append(t)
            yield pa.RecordBatch.from_arrays([pa.array(keys, batch.column(0).type), pa.array(places, pa.int32()), pa.array(texts, pa.string())], names=[key, "idx", "text"])

    return pages.select(key, html).mapInArrow(releasing(run), f"{key} {kind}, idx int, text string")
