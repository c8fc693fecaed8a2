"""HTML pages as Markdown and tables, and the links they hold.

Built on the standard library's event parser: one pass keeps the open elements
on a stack, so a page costs its length.
"""

from __future__ import annotations

from html.parser import HTMLParser
from urllib.parse import urljoin

from pyspark.sql import Column
from pyspark.sql import functions as F

_SILENT = {"script", "style", "noscript"}
_TEXTUAL = {"h1", "h2", "h3", "h4", "h5", "h6", "p", "li", "div", "span"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class _Page(HTMLParser):
    """Collects texts by element, tables, and what a page refers to."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, list[str] | None]] = []
        self.texts: list[list[str]] = []
        self.tables: list[dict] = []
        self.anchors: list[str] = []
        self.objects: list[str] = []
        self.frame: str | None = None
        self.inside: list[dict] = []
        self.silent = 0

    def handle_starttag(self, tag, attrs):  # noqa: ANN001
        given = dict(attrs)
        if tag == "a" and given.get("href"):
            self.anchors.append(given["href"].strip())
        if tag in ("object", "embed", "iframe") and (given.get("data") or given.get("src")):
            self.objects.append((given.get("data") or given["src"]).strip())
        if tag == "iframe" and given.get("src") and self.frame is None:
            self.frame = given["src"]
        if tag in _VOID:
            return
        texts: list[str] | None = None
        if tag in _SILENT:
            self.silent += 1
        elif tag == "table":
            self.inside.append({"rows": [], "headed": False})
        elif self.inside and tag == "tr":
            self.inside[-1]["rows"].append([])
        elif self.inside and tag in ("td", "th"):
            self.inside[-1]["headed"] |= tag == "th"
            if not self.inside[-1]["rows"]:
                self.inside[-1]["rows"].append([])
            texts = []
            self.inside[-1]["rows"][-1].append(texts)
        elif tag in _TEXTUAL and not self.inside:
            texts = []
            self.texts.append(texts)
        self.open.append((tag, texts))

    def handle_endtag(self, tag):  # noqa: ANN001
        if not any(name == tag for name, _ in self.open):
            return
        while self.open:
            name, _ = self.open.pop()
            if name in _SILENT:
                self.silent -= 1
            elif name == "table":
                self._close_table()
            if name == tag:
                break

    def handle_data(self, data):  # noqa: ANN001
        text = data.strip()
        if text and not self.silent:
            for _, texts in self.open:
                if texts is not None:
                    texts.append(text)

    def close(self) -> None:
        super().close()
        while self.inside:
            self._close_table()

    def _close_table(self) -> None:
        table = self.inside.pop()
        rows = [[" ".join(cell) for cell in row] for row in table["rows"]]
        rows = [row for row in rows if any(cell.strip() for cell in row)]
        if rows:
            headers = rows[0] if table["headed"] else [f"열{k + 1}" for k in range(len(rows[0]))]
            self.tables.append({"headers": headers, "rows": rows[1:] if table["headed"] else rows})


def parse(html: str | None) -> _Page:
    page = _Page()
    page.feed(html or "")
    page.close()
    return page


def to_markdown(html: str | None) -> tuple[str, list[dict]]:
    """Text of headings, paragraphs, list items and blocks, a line each (nested
    ones repeat), then the tables; and the tables as headers and rows."""
    page = parse(html)
    lines = [" ".join(t) for t in page.texts if t]
    blocks = ["\n".join(lines)] if lines else []
    for table in page.tables:
        rows = [table["headers"], ["---"] * len(table["headers"]), *table["rows"]]
        blocks.append("\n".join("| " + " | ".join(row) + " |" for row in rows))
    text = "\n\n".join(blocks)
    return "\n".join(line.rstrip() for line in text.splitlines()).strip(), page.tables


def content_links(html: str | None, base: str, most: int = 3) -> list[str]:
    """Absolute links that may hold the content: anchors first, then embedded
    objects, each once, at most ``most``."""
    page = parse(html)
    files = [h for h in page.anchors if any(x in h.lower() for x in ("fldownload.do", ".pdf", "pdfdown"))]
    shown = [s for s in page.objects if any(x in s.lower() for x in (".pdf", "fldownload.do"))]
    return list(dict.fromkeys(urljoin(base, h) for h in files + shown))[:most]


_DOC = "struct<md:string,tables:array<struct<headers:array<string>,rows:array<array<string>>>>,frame:string,links:array<string>>"


def page_struct(html: Column, base: Column) -> Column:
    """Struct (md, tables, frame, links) of a column of pages."""

    @F.pandas_udf(_DOC)
    def run(pages, bases):  # noqa: ANN001
        import pandas as pd

        out = []
        for html_, base_ in zip(pages, bases):
            md, tables = to_markdown(html_)
            frame = parse(html_).frame
            out.append({"md": md, "tables": tables, "frame": urljoin(base_ or "", frame) if frame else None, "links": content_links(html_, base_ or "")})
        return pd.DataFrame(out, columns=["md", "tables", "frame", "links"])

    run.__annotations__ = {}
    return run(html, base)
