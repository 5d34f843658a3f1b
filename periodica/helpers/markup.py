"""HTML to rows: table cells, and the text blocks of a page with the path of their ancestors."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame

from .values import plain

CELLS = "document string, table_no int, row_no int, cells array<string>"
BLOCKS = "document string, block_no int, tag string, path string, container int, text string"
LEAVES = {"p", "li", "h1", "h2", "h3", "h4", "h5", "h6", "tr", "dt", "dd", "a"}
VOID = {"br", "hr", "img", "input", "link", "meta", "source", "wbr", "col", "area", "base", "embed", "param", "track"}


class Tables(HTMLParser):
    """Every table is a scope of its own, also one inside another; rows outside of any table count as
    one only where there is no table."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.done: list[list[list[str]]] = []
        self.open: list[dict] = [{"rows": [], "row": None, "cell": None}]

    def end_row(self) -> None:
        scope = self.open[-1]
        if scope["row"]:
            scope["rows"].append(scope["row"])
        scope["row"] = scope["cell"] = None

    def handle_starttag(self, tag, attrs):
        scope = self.open[-1]
        if tag == "table":
            self.open.append({"rows": [], "row": None, "cell": None})
        elif tag == "tr":
            scope["row"], scope["cell"] = [], None
        elif tag in ("td", "th") and scope["row"] is not None:
            scope["cell"] = []

    def handle_endtag(self, tag):
        scope = self.open[-1]
        if tag == "table" and len(self.open) > 1:
            self.end_row()
            self.open.pop()
            if scope["rows"]:
                self.done.append(scope["rows"])
        elif tag in ("td", "th") and scope["cell"] is not None:
            scope["row"].append(plain("".join(scope["cell"])))
            scope["cell"] = None
        elif tag == "tr" and scope["row"] is not None:
            self.end_row()

    def handle_data(self, data):
        if self.open[-1]["cell"] is not None:
            self.open[-1]["cell"].append(data)

    def result(self) -> list[list[list[str]]]:
        self.close()
        return self.done or ([self.open[0]["rows"]] if self.open[0]["rows"] else [])


class Blocks(HTMLParser):
    """Leaf blocks in page order: tag, ancestors as tag#id.class joined by >, number of the enclosing container."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[list] = []
        self.stack: list[tuple[str, str, int, list[str] | None, int]] = []
        self.containers = 0

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            if tag == "br":
                self.handle_data(" ")
            return
        if tag in LEAVES and tag != "a" and self.stack and self.stack[-1][0] == tag:
            self.handle_endtag(tag)
        found = dict(attrs)
        name = tag + (f"#{found['id']}" if found.get("id") else "") + "".join(f".{c}" for c in (found.get("class") or "").split())
        if tag == "a" and found.get("href"):
            name += f"@{found['href']}"
        if tag not in LEAVES:
            self.containers += 1
        inside = self.stack[-1][2] if self.stack else 0
        number = self.containers if tag not in LEAVES else inside
        text, at = None, -1
        if tag in LEAVES:
            text, at = [], len(self.rows)
            self.rows.append([tag, ">".join([*(s[1] for s in self.stack), name]), number, ""])
        self.stack.append((tag, name, number, text, at))

    def handle_endtag(self, tag):
        if any(s[0] == tag for s in self.stack):
            while self.stack:
                name, _, _, text, at = self.stack.pop()
                if text is not None:
                    self.rows[at][3] = plain("".join(text))
                if name == tag:
                    return

    def handle_data(self, data):
        for s in self.stack:
            if s[3] is not None:
                s[3].append(data)

    def result(self) -> list[list]:
        self.close()
        while self.stack:
            self.handle_endtag(self.stack[-1][0])
        return [r for r in self.rows if r[3]]


def tables_of(content: str | None) -> list[list[list[str]]]:
    parser = Tables()
    parser.feed(content or "")
    return parser.result()


def blocks_of(content: str | None) -> list[list]:
    parser = Blocks()
    parser.feed(content or "")
    return parser.result()


def table_rows(documents: DataFrame) -> DataFrame:
    """document, table_no, row_no, cells of documents (document, content)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (d, t, r, cells)
                for d, content in zip(batch["document"], batch["content"])
                for t, table in enumerate(tables_of(content))
                for r, cells in enumerate(table)
            ]
            yield pd.DataFrame(rows, columns=["document", "table_no", "row_no", "cells"])

    return documents.select("document", "content").mapInPandas(run, CELLS)


def text_blocks(documents: DataFrame) -> DataFrame:
    """document, block_no, tag, path, container, text of documents (document, content)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(d, i, *b) for d, content in zip(batch["document"], batch["content"]) for i, b in enumerate(blocks_of(content))]
            yield pd.DataFrame(rows, columns=["document", "block_no", "tag", "path", "container", "text"])

    return documents.select("document", "content").mapInPandas(run, BLOCKS)
