"""Workbooks and word-processor documents: cells with the values that they show for, paragraphs by their styles.

A workbook's sheets come in its own order, each read as a stream of events: what is held is one sheet's grid. A number is a date, a
time of day or a duration where its format says so; truth values and errors have their names. A document's body is walked
in order. All of either is on page 1.
"""

from __future__ import annotations

import datetime as dt
import io
import posixpath
import re
import zipfile
from collections.abc import Iterator
from html import escape
from xml.etree import ElementTree

W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
S = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
#: Built-in formats of dates and times, the one of a duration, the day that numbers of dates count from.
DATE_FORMATS, DURATION_FORMATS = (*range(14, 23), 45, 47), (46,)
FIRST_DAY, FIRST_DAY_1904 = dt.datetime(1899, 12, 30), dt.datetime(1904, 1, 1)
#: What is text, escaped, or in brackets in a format says nothing of its kind; brackets around hours, minutes or seconds do.
NOISE = re.compile(r'"[^"]*"|\\.|_.|\[(?!hh?\]|mm?\]|ss?\])[^\]]*\]', re.I)
DURATION = re.compile(r"\[(hh?|mm?|ss?)\]", re.I)


def place(ref: str) -> tuple[int, int]:
    """Row and column of a cell's name, from 0."""
    letters, digits = re.match(r"([A-Z]+)(\d+)", ref).groups()
    column = 0
    for x in letters:
        column = column * 26 + ord(x) - 64
    return int(digits) - 1, column - 1


def kind_of(code: str | None, number: int) -> str:
    """What a number with this format is: `date`, `duration` or `number`."""
    if code is None:
        return "date" if number in DATE_FORMATS else "duration" if number in DURATION_FORMATS else "number"
    first = NOISE.sub("", code.split(";")[0])
    return "duration" if DURATION.search(first) else "date" if re.search("[dmhys]", first, re.I) else "number"


def number_text(text: str, kind: str, first_day: dt.datetime) -> str:
    value = float(text) if re.search("[.eE]", text) else int(text)
    try:
        if kind == "duration":
            return str(dt.timedelta(milliseconds=round(value * 86_400_000)))
        if kind == "date":
            day, part = divmod(value, 1)
            part = dt.timedelta(milliseconds=round(part * 86_400_000))
            if 0 <= value < 1 and not part.days:
                return str((dt.datetime.min + part).time())
            # The calendar of these numbers has a 29th of February 1900.
            return str(first_day + dt.timedelta(days=day + (0 < value < 60 and first_day == FIRST_DAY)) + part)
    except OverflowError:
        return "#VALUE!"
    return str(value)


class Workbook:
    def __init__(self, content: bytes):
        self.zip = zipfile.ZipFile(io.BytesIO(content))
        self.names = set(self.zip.namelist())
        book = self._tree("xl/workbook.xml")
        properties = book.find(f"{S}workbookPr") if book is not None else None
        self.first_day = FIRST_DAY_1904 if properties is not None and properties.get("date1904") in ("1", "true") else FIRST_DAY
        links = self._tree("xl/_rels/workbook.xml.rels")
        parts = {} if links is None else {x.get("Id"): posixpath.normpath(posixpath.join("/xl", x.get("Target"))).lstrip("/") for x in links if x.get("Type", "").endswith("/worksheet")}
        listed = [parts[x.get(LINK)] for x in book.iter(f"{S}sheet") if x.get(LINK) in parts] if book is not None else []
        # A book that doesn't list its sheets: by the numbers of their parts.
        self.sheets = [x for x in listed if x in self.names] or sorted((n for n in self.names if re.match(r"xl/worksheets/sheet\d+\.xml$", n)), key=lambda n: int(re.search(r"\d+", n)[0]))
        self.shared = [] if "xl/sharedStrings.xml" not in self.names else [self._text(si) for si, _ in self._elements("xl/sharedStrings.xml", f"{S}si")]
        styles = self._tree("xl/styles.xml")
        own = {} if styles is None else {int(x.get("numFmtId")): x.get("formatCode") for x in styles.iter(f"{S}numFmt")}
        formats = None if styles is None else styles.find(f"{S}cellXfs")
        self.kinds = [] if formats is None else [kind_of(own.get(n), n) for n in (int(x.get("numFmtId", 0)) for x in formats)]

    def _tree(self, name: str):
        return ElementTree.fromstring(self.zip.read(name)) if name in self.names else None

    def _elements(self, name: str, *tags: str) -> Iterator[tuple[ElementTree.Element, ElementTree.Element | None]]:
        """Elements with these tags as they end, each with that around it; what has been read is let go."""
        with self.zip.open(name) as f:
            path: list[ElementTree.Element] = []
            for event, e in ElementTree.iterparse(f, ("start", "end")):
                if event == "start":
                    path.append(e)
                    continue
                path.pop()
                if e.tag in tags:
                    yield e, path[-1] if path else None
                    e.clear()
                    if path:
                        path[-1].remove(e)

    @staticmethod
    def _text(e: ElementTree.Element) -> str:
        """Plain or rich text, without its reading aids."""
        return "".join(t.text or "" for part in e if part.tag in (f"{S}t", f"{S}r") for t in part.iter(f"{S}t"))

    def value(self, c: ElementTree.Element) -> str:
        kind, v = c.get("t", "n"), c.find(f"{S}v")
        if kind == "inlineStr":
            inner = c.find(f"{S}is")
            return self._text(inner) if inner is not None else ""
        text = (v.text or "") if v is not None else ""
        if text == "" or kind in ("str", "e"):
            return text
        if kind == "s":
            return self.shared[int(text)]
        if kind == "b":
            return str(bool(int(text)))
        if kind == "d":
            return str(dt.datetime.fromisoformat(text.removesuffix("Z")))
        style = int(c.get("s", 0))
        return number_text(text, self.kinds[style] if style < len(self.kinds) else "number", self.first_day)

    def grid(self, sheet: str) -> list[list[str]]:
        """All rows from the first; merged cells have the value of their first."""
        values: dict[tuple[int, int], str] = {}
        merged: list[tuple[tuple[int, int], tuple[int, int]]] = []
        row, column = 0, -1
        for e, around in self._elements(sheet, f"{S}c", f"{S}row", f"{S}mergeCell"):
            if e.tag == f"{S}c":
                here = around.get("r") if around is not None else None
                row, column = place(e.get("r")) if e.get("r") else (int(here) - 1 if here else row, column + 1)
                values[row, column] = self.value(e)
            elif e.tag == f"{S}row":
                row, column = int(e.get("r", row + 1)), -1  # what comes next, should it not say
            else:
                a, _, b = e.get("ref").partition(":")
                merged.append((place(a), place(b or a)))
        for (r0, c0), (r1, c1) in merged:
            first = values.get((r0, c0), "")
            values |= {(r, c): first for r in range(r0, r1 + 1) for c in range(c0, c1 + 1)}
        if not values:
            return []
        columns = max(c for _, c in values) + 1
        return [[values.get((r, c), "") for c in range(columns)] for r in range(max(r for r, _ in values) + 1)]


def sheet_grids(content: bytes) -> Iterator[list[list[str]]]:
    book = Workbook(content)
    yield from map(book.grid, book.sheets)


def paragraph_category(style: str, numbered: bool) -> str:
    style = style.lower()
    named = {"title": "title", "subtitle": "section_header", "caption": "caption"}
    if style in named:
        return named[style]
    return "section_header" if style.startswith("heading") else "list_item" if style.startswith("list") or numbered else "text"


#: Elements of a run that stand for a character.
MARKS = {f"{W}tab": "\t", f"{W}ptab": "\t", f"{W}cr": "\n", f"{W}noBreakHyphen": "-"}


def run_text(run: ElementTree.Element) -> str:
    part = lambda e: (e.text or "") if e.tag == f"{W}t" else "\n" if e.tag == f"{W}br" and e.get(f"{W}type", "textWrapping") == "textWrapping" else MARKS.get(e.tag, "")
    return "".join(map(part, run))


def paragraph_text(p: ElementTree.Element) -> str:
    """Text of the runs and links of a paragraph; what floats beside it isn't part of it."""
    return "".join(run_text(r) for e in p for r in ([e] if e.tag == f"{W}r" else e.findall(f"{W}r") if e.tag == f"{W}hyperlink" else []))


def table_rows(table: ElementTree.Element) -> list[list[ElementTree.Element]]:
    """The cell at each place of a table's rows: a wide cell is at several, one that goes on is that above."""
    rows: list[list[ElementTree.Element]] = []
    for tr in table.findall(f"{W}tr"):
        row: list[ElementTree.Element] = []
        for tc in tr.findall(f"{W}tc"):
            span, down = tc.find(f"{W}tcPr/{W}gridSpan"), tc.find(f"{W}tcPr/{W}vMerge")
            goes_on = down is not None and down.get(f"{W}val", "continue") == "continue" and rows and len(row) < len(rows[-1])
            row += [rows[-1][len(row)] if goes_on else tc] * int(span.get(f"{W}val", 1) if span is not None else 1)
        rows.append(row)
    return rows


def document_items(content: bytes) -> Iterator[tuple[str, str]]:
    """(category, text) of the paragraphs and tables of a document's body."""
    z = zipfile.ZipFile(io.BytesIO(content))
    styles, default = {}, ""
    if "word/styles.xml" in z.namelist():
        for s in ElementTree.fromstring(z.read("word/styles.xml")).iter(f"{W}style"):
            name = s.find(f"{W}name")
            styles[s.get(f"{W}styleId")] = name.get(f"{W}val", "") if name is not None else ""
            if s.get(f"{W}type") == "paragraph" and s.get(f"{W}default") in ("1", "true"):
                default = styles[s.get(f"{W}styleId")]

    def walk(parent: ElementTree.Element) -> Iterator[tuple[str, str]]:
        for e in parent:
            if e.tag == f"{W}p":
                if text := paragraph_text(e).strip():
                    style = e.find(f"{W}pPr/{W}pStyle")
                    # Where no styles are defined at all, their keys are all there is.
                    name = default if style is None else styles.get(style.get(f"{W}val"), default) if styles else style.get(f"{W}val", "")
                    yield paragraph_category(name, e.find(f"{W}pPr/{W}numPr") is not None), text
            elif e.tag == f"{W}tbl":
                rows = table_rows(e)
                if len(rows) == 1 and len(rows[0]) == 1 and rows[0][0].find(f"{W}tbl") is not None:
                    yield from walk(rows[0][0])  # a frame around tables
                else:
                    cell = lambda c: escape("\n".join(map(paragraph_text, c.findall(f"{W}p"))))
                    yield "table", "<table><tbody>" + "".join("<tr>" + "".join(f"<td>{cell(c)}</td>" for c in r) + "</tr>" for r in rows) + "</tbody></table>"

    yield from walk(ElementTree.fromstring(z.read("word/document.xml")).find(f"{W}body"))
