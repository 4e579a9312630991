"""Tables of markup as grids: which text stands in which row and column."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa

#: The largest spans that are followed, as browsers do.
MOST_COLUMNS, MOST_ROWS = 1000, 65534


class _Reader(HTMLParser):
    """The cells of the first table with a class: rows of (colspan, rowspan, text, inner text).

    Tables inside a cell are part of its text.  Character references are decoded;
    comments, scripts and styles say nothing.  A new cell or row ends an open one.
    The inner text is that of the first span inside spans of two classes, one in the other.
    """

    def __init__(self, name: str, outer: str, inner: str) -> None:
        super().__init__(convert_charrefs=True)
        self.name, self.nest = name, (outer, inner)
        self.rows: list[list[list]] = []
        self.depth, self.done, self.cell = 0, False, None
        self.stage = self.spans = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        given = dict(attrs)
        names = (given.get("class") or "").split()
        if tag == "table":
            self.depth += 1 if self.depth or (not self.done and self.name in names) else 0
        elif self.depth == 1 and tag == "tr":
            self.cell = None
            self.rows.append([])
        elif self.depth == 1 and tag in ("td", "th"):
            if not self.rows:
                self.rows.append([])
            span = lambda key, most: min(int(given[key]), most) if (given.get(key) or "").isdigit() else 1
            self.cell = [max(1, span("colspan", MOST_COLUMNS)), span("rowspan", MOST_ROWS), [], []]
            self.rows[-1].append(self.cell)
            self.stage = 0
        elif self.cell and tag == "span":
            if self.stage < 2:
                self.stage += self.nest[self.stage] in names
            elif self.stage == 2:
                self.stage, self.spans = 3, 0
            elif self.stage == 3:
                self.spans += 1

    def handle_endtag(self, tag: str) -> None:
        if tag == "table" and self.depth:
            self.depth -= 1
            if not self.depth:
                self.done, self.cell = True, None
        elif self.depth == 1 and tag in ("td", "th", "tr"):
            self.cell = None
        elif self.cell and tag == "span" and self.stage == 3:
            self.stage, self.spans = (4, 0) if not self.spans else (3, self.spans - 1)

    def handle_data(self, data: str) -> None:
        if self.cell and self.cdata_elem is None:
            self.cell[2].append(data)
            if self.stage == 3:
                self.cell[3].append(data)


def _plain(parts: list[str]) -> str:
    return " ".join("".join(parts).split())


def grid(html: str, name: str, outer: str = "value", inner: str = "pv") -> list[tuple[int, int, str, str]]:
    """(row, column, text, inner text) of a table's grid; a cell that spans stands at each place it covers."""
    reader = _Reader(name, outer, inner)
    reader.feed(html)
    reader.close()
    out, below = [], {}  # column -> (rows that are still covered, texts)
    for r, row in enumerate(reader.rows):
        at, now = 0, {}
        for columns, rows, *parts in row:
            while at in below:
                at += 1
            last = len(reader.rows) - r if rows == 0 else min(rows, len(reader.rows) - r)
            for c in range(at, at + columns):
                now[c] = (last, tuple(map(_plain, parts)))
            at += columns
        line = below | now
        out += [(r, c, *texts) for c, (_, texts) in sorted(line.items())]
        below = {c: (left - 1, texts) for c, (left, texts) in line.items() if left > 1}
    return out


def grids(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
    """(row, html) to (row, line, at, cell, inner): a page's grid; nothing for null."""
    for batch in batches:
        for i, html in enumerate(batch.column(1).to_pylist()):
            if cells := grid(html or "", name):
                line, at, cell, inner = zip(*cells)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([i] * len(cells))), pa.array(line, pa.int64()), pa.array(at, pa.int64()), pa.array(cell), pa.array(inner)], names=["row", "line", "at", "cell", "inner"])
