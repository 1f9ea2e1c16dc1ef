"""Cells of an HTML table by the standard library's parser."""

from __future__ import annotations

from html.parser import HTMLParser


class _Table(HTMLParser):
    def __init__(self, css_class: str):
        super().__init__()
        self.wanted, self.depth, self.done = set(css_class.split()), 0, False
        self.rows: list[list[str]] = []
        self.cell: list[str] | None = None

    def handle_starttag(self, tag, attrs):
        if tag == "table" and not self.done and (self.depth or self.wanted <= set((dict(attrs).get("class") or "").split())):
            self.depth += 1
        elif self.depth and tag == "tr":
            self.rows.append([])
        elif self.depth and tag in ("td", "th") and self.rows:
            self.cell = []

    def handle_endtag(self, tag):
        if tag == "table" and self.depth:
            self.depth -= 1
            self.done = not self.depth
        elif tag in ("td", "th") and self.cell is not None:
            self.rows[-1].append("".join(self.cell).strip())
            self.cell = None

    def handle_data(self, data):
        if self.cell is not None:
            self.cell.append(data)


def rows_of(html: str, css_class: str) -> list[list[str]]:
    parser = _Table(css_class)
    parser.feed(html)
    return parser.rows
