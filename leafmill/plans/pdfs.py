"""PDF files made from the lines of documents, in both forms that files have, for queries and tests."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from leafmill.plans import tables as D

#: Lines of a page, the left edge, and the distance of baselines.
LINES, LEFT, STEP = 40, 50, 18
HEADING, BODY = 18, 12

Line = tuple[str, float, float, float]  # text, size, x, baseline from the bottom


def write_pdf(pages: list[tuple[float, float, list[Line]]], packed: bool = False) -> bytes:
    """A PDF of these pages (width, height, lines). packed: objects in a stream, references in another, two bytes a character; else a table and Windows
    characters as far as they go. Long lines are shown in two parts."""
    simple = not packed and all(_plain(t) for _, _, lines in pages for t, *_ in lines)
    objects: dict[int, bytes] = {1: b"<< /Type /Catalog /Pages 2 0 R >>"}
    streams: dict[int, bytes] = {}
    if simple:
        objects[3] = b"<< /Type /Font /Subtype /Type1 /BaseFont /Helvetica /Encoding /WinAnsiEncoding >>"
    else:
        objects[3] = b"<< /Type /Font /Subtype /Type0 /BaseFont /Any /Encoding /Identity-H /DescendantFonts [4 0 R] /ToUnicode 5 0 R >>"
        objects[4] = b"<< /Type /Font /Subtype /CIDFontType2 /BaseFont /Any /DW 500 /W [32 [250] 65 90 700] >>"
        streams[5] = b"1 begincodespacerange <0000> <FFFF> endcodespacerange 1 beginbfrange <0000> <FFFF> <0000> endbfrange"
    code = (lambda t: b"(" + t.encode("cp1252").replace(b"\\", b"\\\\").replace(b"(", b"\\(").replace(b")", b"\\)").replace(b"\r", b"\\r") + b")") if simple else (lambda t: b"<" + t.encode("utf-16-be").hex().encode() + b">")
    kids = []
    for k, (width, height, lines) in enumerate(pages):
        page, contents = 6 + 2 * k, 7 + 2 * k
        kids.append(b"%d 0 R" % page)
        objects[page] = b"<< /Type /Page /Parent 2 0 R /MediaBox [0 0 %g %g] /Contents %d 0 R >>" % (width, height, contents)
        shown = []
        for text, size, x, y in lines:
            half = len(text) // 2 if len(text) > 10 else len(text)
            shown.append(b"BT /F1 %g Tf 1 0 0 1 %g %g Tm " % (size, x, y) + b" ".join(code(part) + b" Tj" for part in (text[:half], text[half:]) if part) + b" ET")
        streams[contents] = b"\n".join(shown)
    objects[2] = b"<< /Type /Pages /Count %d /Kids [%s] /Resources << /Font << /F1 3 0 R >> >> >>" % (len(pages), b" ".join(kids))
    out = bytearray(b"%PDF-1.7\n")
    places: dict[int, tuple[int, int, int]] = {}

    def add(number: int, body: bytes) -> None:
        places[number] = (1, len(out), 0)
        out.extend(b"%d 0 obj\n%s\nendobj\n" % (number, body))

    def stream(number: int, data: bytes, head: bytes = b"") -> None:
        squeezed = zlib.compress(data)
        add(number, b"<< /Filter /FlateDecode /Length %d %s>>\nstream\n%s\nendstream" % (len(squeezed), head, squeezed))

    for number, data in streams.items():
        stream(number, data)
    if not packed:
        for number, body in objects.items():
            add(number, body)
        start, size = len(out), max(places) + 1
        rows = b"".join(b"%010d 00000 n \n" % places[i][1] if i in places else b"0000000000 65535 f \n" for i in range(size))
        return bytes(out) + b"xref\n0 %d\n%strailer\n<< /Size %d /Root 1 0 R >>\nstartxref\n%d\n%%%%EOF\n" % (size, rows, size, start)
    pack, table = 6 + 2 * len(pages), 7 + 2 * len(pages)
    heads, bodies, at = [], [], 0
    for k, (number, body) in enumerate(objects.items()):
        heads.append(b"%d %d" % (number, at))
        bodies.append(body)
        at += len(body) + 1
        places[number] = (2, pack, k)
    head = b" ".join(heads) + b" "
    stream(pack, head + b" ".join(bodies), b"/Type /ObjStm /N %d /First %d " % (len(heads), len(head)))
    start = len(out)
    places[table] = (1, start, 0)
    rows = [bytes([places.get(i, (0, 0, 0))[0]]) + places.get(i, (0, 0, 0))[1].to_bytes(4, "big") + places.get(i, (0, 0, 0))[2].to_bytes(2, "big") for i in range(table + 1)]
    # Each row is told as its difference from the one above it.
    told = b"".join(b"\2" + bytes((x - y) & 255 for x, y in zip(row, above, strict=True)) for row, above in zip(rows, [bytes(7), *rows], strict=False))
    stream(table, told, b"/Type /XRef /Size %d /W [1 4 2] /Root 1 0 R /DecodeParms << /Predictor 12 /Columns 7 >> " % (table + 1))
    return bytes(out) + b"startxref\n%d\n%%%%EOF\n" % start


def _plain(text: str) -> bool:
    try:
        return bool(text.encode("cp1252")) or True
    except UnicodeEncodeError:
        return False


def pages_of_text(text: str | None) -> list[tuple[float, float, list[Line]]]:
    """Pages of LINES lines of a text; lines of 40 characters at most are headings."""
    lines = (text or "").split("\n")
    made = []
    for k in range(0, len(lines), LINES):
        width, height = 501.0 + k // LINES, 800.0 + k // LINES % 2
        made.append((width, height, [(t, HEADING if len(t) <= 40 else BODY, LEFT, height - STEP * (i + 1)) for i, t in enumerate(lines[k : k + LINES]) if t.strip()]))
    return made


def documents_as_pdf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """key, path and content: a PDF of each document."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 256):
                some = batch.slice(a, 256)
                made = [write_pdf(pages_of_text(t), i is not None and i % 2 == 1) for i, t in zip(*(c.to_pylist() for c in some.columns), strict=True)]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array([f"{i}.pdf" for i in some.column(0).to_pylist()]), pa.array(made, pa.binary())], ["key", "path", "content"])

    return D.spread(D.read(spark, sf_dir, "documents").selectExpr("doc_id", "cast(text as string) as text"), "doc_id").mapInArrow(run, "key bigint, path string, content binary")
