"""Rows and cells of HTML pages by one scan over the tags."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pyarrow as pa


class _Done(Exception):
    """The wanted rows are closed."""


class RowScanner(HTMLParser):
    """Opens and closes rows and cells as the tags of a page come by.

    A row or cell that isn't closed ends where the next one of its table
    begins or where its parent ends. Tables may be nested: the rows of an inner
    one are rows too, and its cells and text also belong to the outer cell.
    Comments, scripts and styles have no text; named and numeric entities are
    decoded. The text is kept once, in pieces; a cell is a range of them."""

    def __init__(self, row_tag: str, cell_tag: str, max_rows: int):
        super().__init__(convert_charrefs=True)
        self.row_tag, self.cell_tag, self.max_rows = row_tag, cell_tag, max_rows
        self.scope = "table" if row_tag == "tr" else row_tag  # what an implied end doesn't cross
        self.pieces: list[str] = []
        self.rows: list[list[list[int]]] = []  # cells: first piece, end
        self.open: list[tuple[str, list]] = []  # an empty name: a row beyond the wanted ones

    def _close(self, upto: int) -> None:
        for tag, what in self.open[upto:]:
            if tag == self.cell_tag:
                what[1] = len(self.pieces)
        del self.open[upto:]
        if len(self.rows) == self.max_rows and not any(t == self.row_tag for t, _ in self.open):
            raise _Done

    def _place(self, tags: tuple[str, ...], barrier: tuple[str, ...]) -> int | None:
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] in tags:
                return k
            if self.open[k][0] in barrier:
                return None
        return None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == self.row_tag:
            if self.scope != tag and (k := self._place((tag, ""), (self.scope,))) is not None:
                self._close(k)
            row: list[list[int]] = []
            if len(self.rows) < self.max_rows:
                self.rows.append(row)
                self.open.append((tag, row))
            else:
                self.open.append(("", row))
        elif tag == self.cell_tag:
            if (k := self._place((tag,), (self.row_tag, self.scope, ""))) is not None:
                self._close(k)
            if any(t == self.row_tag for t, _ in self.open):
                cell = [len(self.pieces), len(self.pieces)]
                for t, row in self.open:
                    if t == self.row_tag:
                        row.append(cell)
                self.open.append((tag, cell))
        elif tag == self.scope:
            self.open.append((tag, []))

    def handle_endtag(self, tag: str) -> None:
        if tag == self.cell_tag:
            k = self._place((tag,), (self.row_tag, self.scope, ""))
        elif tag == self.row_tag:
            k = self._place((tag, ""), (self.scope,))
        else:
            k = self._place((tag,), ()) if tag == self.scope else None
        if k is not None:
            self._close(k)

    def handle_data(self, data: str) -> None:
        if self.open and self.cdata_elem is None and (text := data.strip()):
            self.pieces.append(text)


def page_rows(html: str | None, row_tag: str = "tr", cell_tag: str = "td", max_rows: int = 5) -> list[list[str]]:
    """The cells' text of the first ``max_rows`` rows: pieces between tags are
    trimmed and joined. A null page has no rows."""
    scanner = RowScanner(row_tag, cell_tag, max_rows)
    try:
        scanner.feed(html or "")
        scanner.close()
        scanner._close(0)
    except _Done:
        pass
    return [["".join(scanner.pieces[a:b]) for a, b in row] for row in scanner.rows]


def scan_pages(row_tag: str, cell_tag: str, max_rows: int, wanted: tuple[int, ...], key: str) -> Callable:
    """Arrow batches of (key, page) to (key, row_idx, wanted cells) of the rows
    that have all wanted cells."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, number, cells = [], [], [[] for _ in wanted]
            for i in range(batch.num_rows):
                for j, row in enumerate(page_rows(batch.column(1)[i].as_py(), row_tag, cell_tag, max_rows)):
                    if len(row) > max(wanted):
                        at.append(i)
                        number.append(j)
                        for out, w in zip(cells, wanted, strict=True):
                            out.append(row[w])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(number, pa.int32()), *(pa.array(c, pa.string()) for c in cells)],
                names=[key, "row_idx", *(f"cell_{w}" for w in wanted)])
    return run
