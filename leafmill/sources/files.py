"""Files as items: Spark's binaryFile scan, the type of each file, and one parser per format.

Parsers take bytes and give (page, category, text, bbox, font_size) rows, and a Page where a page has a size, an image
or words; they run inside mapInArrow on the executors. PDF and JPEG need optional libraries; a file without a parser is a
row with an error.
"""

from __future__ import annotations

import csv
import html.parser
import importlib.util
import io
import itertools
import os
import re
import subprocess
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.sources import office

Row = tuple[int, str | None, str, tuple[float, float, float, float], float | None]


class Page(NamedTuple):
    """What a page has besides lines: its size in points, its image as PNG, and (text, box) of its words."""

    page: int
    width: float | None = None
    height: float | None = None
    image: bytes | None = None
    words: list[tuple[str, tuple[float, float, float, float]]] | None = None


NOWHERE = (0.0, 0.0, 0.0, 0.0)
#: Block tags, virtual font sizes, magic bytes.
BLOCK_TAGS = ("h1", "h2", "h3", "h4", "h5", "h6", "p", "li", "td", "th", "blockquote", "pre")
FONT_SIZES = {"h1": 24.0, "h2": 20.0, "h3": 18.0, "h4": 16.0, "h5": 14.0, "h6": 13.0}
BODY_SIZE = 12.0
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
MAGIC = ((b"%PDF", "pdf"), (b"\x89PNG\r\n\x1a\n", "png"), (b"\xff\xd8\xff", "jpeg"), (b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1", "ppt"))
ZIPPED = (("word/", "docx"), ("xl/", "xlsx"), ("ppt/", "pptx"))


def sniff(path: str, content: bytes) -> str:
    """The type of a file by its first bytes, then its members, then its suffix; ValueError if unknown."""
    return sniff_file(path, io.BytesIO(content))


def sniff_file(path: str, file) -> str:
    """sniff() of an open file: of most only the first bytes are read, of an archive its directory."""
    head = file.read(64)
    for magic, kind in MAGIC:
        if head.startswith(magic):
            return kind
    if head.startswith(b"PK\x03\x04"):
        try:
            names = zipfile.ZipFile(file).namelist()
        except ValueError as e:  # a store's file says so if its end is too near
            raise zipfile.BadZipFile(str(e)) from e
        for prefix, kind in ZIPPED:
            if any(n.startswith(prefix) for n in names):
                return kind
        if any(n.startswith("Contents/") or n == "mimetype" for n in names):
            return "hwpx"
        raise ValueError(f"unknown archive: {path}")
    if head.removeprefix(b"\xef\xbb\xbf").lstrip().lower().startswith((b"<!doctype html", b"<html")):
        return "html"
    suffix = os.path.splitext(path)[1].lower().lstrip(".")
    found = {"csv": "csv", "md": "md", "markdown": "md", "txt": "txt"}.get(suffix)
    if not found:
        raise ValueError(f"unknown type: {path}")
    return found


def _text(content: bytes) -> str:
    return content.decode("utf-8", "replace").replace("\r\n", "\n").replace("\r", "\n")


class _Blocks(html.parser.HTMLParser):
    """Block tags in document order; each text node, stripped, goes to every open block."""

    def __init__(self):
        super().__init__()
        self.stack: list[tuple[str, list[str] | None]] = []
        self.found: list[tuple[str, list[str]]] = []

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            return
        parts: list[str] | None = [] if tag in BLOCK_TAGS else None
        if parts is not None:
            self.found.append((tag, parts))
        self.stack.append((tag, parts))

    def handle_endtag(self, tag):
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                del self.stack[i:]
                return

    def handle_data(self, data):
        if data.strip() and not any(t in ("script", "style") for t, _ in self.stack):
            for _, parts in self.stack:
                if parts is not None:
                    parts.append(data.strip())


def parse_html(content: bytes) -> Iterator[Row]:
    blocks = _Blocks()
    blocks.feed(_text(content))
    blocks.close()
    for tag, parts in blocks.found:
        if text := "".join(parts):
            yield 1, None, text, NOWHERE, FONT_SIZES.get(tag, BODY_SIZE)


def parse_txt(content: bytes) -> Iterator[Row]:
    for part in re.split(r"\n\s*\n+", _text(content).strip()):
        if part.strip():
            yield 1, "text", part.strip(), NOWHERE, None


def table_html(head: list[str], body: list[list[str]], caption: str | None = None) -> str:
    from html import escape

    line = lambda cells, tag: "<tr>" + "".join(f"<{tag}>{escape(c)}</{tag}>" for c in cells) + "</tr>"
    top = f"<caption>{escape(caption)}</caption>" if caption is not None else ""
    return f"<table>{top}<thead>{line(head, 'th')}</thead><tbody>{''.join(line(r, 'td') for r in body)}</tbody></table>"


#: What a line outside of code is, by the first pattern that fits it, and the line under a table's head.
MD_RULES = tuple((kind, re.compile(pattern, re.S)) for kind, pattern in (("section_header", r"#{1,6}\s+(?P<text>.*)$"), ("table", r"(?P<text>\|.*)$"), ("list_item", r"(?:[-*+]|\d+[.)])\s+(?P<text>.*)$"), ("text", r"(?P<text>.*)$")))
MD_RULER = re.compile(r"\|?\s*:?-+:?\s*(\|\s*:?-+:?\s*)*\|?$")


def md_lines(text: str) -> Iterator[tuple[tuple, str]]:
    """(label, text) of each line that isn't blank or a fence: lines that make up one item have one label."""
    fences, head = 0, -2
    for i, raw in enumerate(text.split("\n")):
        line = raw.strip()
        if line.startswith("```"):
            fences, head = fences + 1, -2
            continue
        if fences % 2:
            yield ("code", fences), raw
            continue
        if head == i - 1 and MD_RULER.match(line):
            continue
        kind, found = next((kind, m) for kind, rule in MD_RULES if (m := rule.match(line)))
        if kind == "table":
            head = i if head < 0 else head
            yield ("table", head), line
            continue
        head = -2
        if found["text"]:
            yield (kind, -1 - i), found["text"]


def parse_md(content: bytes) -> Iterator[Row]:
    """Fenced code, pipe tables, headings, list items, and any other line as a text."""
    cells = lambda x: [c.strip() for c in x.strip("|").split("|")]
    for (kind, _), lines in itertools.groupby(md_lines(_text(content)), key=lambda x: x[0]):
        lines = [x for _, x in lines]
        text = table_html(cells(lines[0]), list(map(cells, lines[1:]))) if kind == "table" else "\n".join(lines)
        if text:
            yield 1, kind, text, NOWHERE, None


def grid_html(grid: list[list[str]]) -> Iterator[str]:
    """A table for each run of rows between blank ones; see operators.tables for the same over rows of a table."""
    block: list[list[str]] = []
    for row in [*grid, []]:
        if any(c.strip() for c in row):
            block.append(row)
        elif block:
            full = {c for c in block[0] if c.strip()}
            if len(full) == 1 and len(block) > 1:
                yield table_html(block[1], block[2:], full.pop())
            else:
                yield table_html(block[0], block[1:])
            block = []


def parse_csv(content: bytes) -> Iterator[Row]:
    rows = list(csv.reader(io.StringIO(content.decode("utf-8-sig", "replace"), newline="")))
    width = max(map(len, rows), default=0)
    for table in grid_html([r + [""] * (width - len(r)) for r in rows]):
        yield 1, "table", table, NOWHERE, None


def parse_xlsx(content: bytes) -> Iterator[Row]:
    """The tables of every sheet, in the workbook's order."""
    for grid in office.sheet_grids(content):
        for table in grid_html(grid):
            yield 1, "table", table, NOWHERE, None


def parse_docx(content: bytes) -> Iterator[Row]:
    for category, text in office.document_items(content):
        yield 1, category, text, NOWHERE, None


def parse_pdf(content: bytes, dpi: int | None = 150) -> Iterator[Row | Page]:
    """Lines of a PDF by its spans, with size, image (unless dpi is None) and words of each page by PyMuPDF; without it see pdf_fragments(), and without any library sources.pdf."""
    try:
        import fitz
    except ImportError:
        yield from pdf_fragments(content) if importlib.util.find_spec("pypdf") else pdf_spans(content)
        return
    with fitz.open(stream=content, filetype="pdf") as pdf:
        for number, page in enumerate(pdf, 1):
            yield Page(number, page.rect.width, page.rect.height, page.get_pixmap(dpi=dpi).tobytes("png") if dpi else None, [(w[4], tuple(w[:4])) for w in page.get_text("words")] if dpi else None)
            for line in (x for b in page.get_text("dict")["blocks"] for x in b.get("lines", [])):
                spans = [(s["text"], s["size"], s["bbox"]) for s in line["spans"]]
                text, size = join_spans(spans), dominant_size(spans)
                if text.strip():
                    boxes = [s[2] for s in spans]
                    yield number, None, text, (min(b[0] for b in boxes), min(b[1] for b in boxes), max(b[2] for b in boxes), max(b[3] for b in boxes)), size


def pdf_spans(content: bytes) -> Iterator[Row | Page]:
    """Lines and page sizes of a PDF that is taken whole; read_lines() reads files by ranges of pages."""
    from leafmill.sources import pdf

    doc = pdf.Document(io.BytesIO(content))
    interpreter = pdf.Interpreter(doc)
    for number, page in enumerate(doc.pages(), 1):
        left, bottom, right, top = doc.box(page)
        yield Page(number, right - left, top - bottom)
        for text, box, size in pdf.lines_in_order(interpreter.page(page), left, top):
            yield number, None, text, box, size


def pdf_fragments(content: bytes) -> Iterator[Row]:
    """Lines of a PDF by its text fragments, without images; needs pypdf."""
    import pypdf

    for number, page in enumerate(pypdf.PdfReader(io.BytesIO(content)).pages, 1):
        found: list[tuple[str, float, float, float]] = []
        page.extract_text(visitor_text=lambda text, _, at, font, size, found=found: found.append((text, at[4], at[5], size)))
        yield from ((number, None, text, box, size) for text, box, size in lines_of_fragments(found))


def lines_of_fragments(found: Iterable[tuple[str, float, float, float]]) -> Iterator[tuple[str, tuple[float, float, float, float], float]]:
    """(text, box, size) of the lines that (text, x, y, size) fragments make; operators.layout.fragment_lines does it over a table."""
    line: list[tuple[str, float, float, float]] = []
    for f in [*(f for f in found if f[0] and f[0].strip()), None]:
        if line and (f is None or abs(f[2] - line[-1][2]) > 1):
            text, x, y, size = "".join(x[0] for x in line), line[0][1], line[-1][2], line[-1][3]
            yield text, (x, y, x + size / 2 * len(text), y + size), size
            line = []
        if f is not None:
            line.append(f)


def join_spans(spans: list[tuple]) -> str:
    """Texts of a line's spans with a space where the gap is over a quarter of their mean size."""
    out, before = "", None
    for text, size, box in spans:
        if before and box[0] - before[2][2] > (size + before[1]) / 2 * 0.25 and not before[0].endswith(" ") and not text.startswith(" "):
            out += " "
        out += text
        before = (text, size, box)
    return out


def dominant_size(spans: list[tuple]) -> float:
    weights: dict[float, int] = {}
    for text, size, _ in spans:
        weights[size] = weights.get(size, 0) + len(text)
    return max(weights, key=weights.get, default=0.0)


def parse_image(content: bytes) -> Iterator[Page]:
    """One page without lines, at one point a pixel: OCR or a model reads it. JPEG needs Pillow, which turns it into a PNG."""
    if not png_size(content):
        from PIL import Image

        out = io.BytesIO()
        with Image.open(io.BytesIO(content)) as image:
            image.convert("RGB").save(out, "PNG")
        content = out.getvalue()
    yield Page(1, image=content)


def png_size(content: bytes) -> tuple[int, int] | None:
    if content[:8] != MAGIC[1][0] or len(content) < 24:
        return None
    return int.from_bytes(content[16:20], "big"), int.from_bytes(content[20:24], "big")


def convert_with(command: Callable[[str, str], list[str]], suffix: str, timeout: int = 600) -> Callable[[bytes], Iterator[Row]]:
    """A parser that turns a file into a PDF by a program (input, output folder) -> command line, in a folder of its own."""

    def parse(content: bytes) -> Iterator[Row]:
        with tempfile.TemporaryDirectory() as folder:
            source = os.path.join(folder, f"in{suffix}")
            with open(source, "wb") as f:
                f.write(content)
            done = subprocess.run(command(source, folder), capture_output=True, timeout=timeout, check=False)
            target = os.path.join(folder, "in.pdf")
            if done.returncode or not os.path.exists(target) or not os.path.getsize(target):
                raise RuntimeError(f"conversion failed: {done.stderr[-300:]!r}")
            with open(target, "rb") as f:
                yield from parse_pdf(f.read())

    return parse


def soffice(source: str, folder: str) -> list[str]:
    return [os.environ.get("SOFFICE_BIN", "soffice"), f"-env:UserInstallation=file://{folder}/profile", "--headless", "--convert-to", "pdf", "--outdir", folder, source]


def rhwp(source: str, folder: str) -> list[str]:
    return [os.environ.get("RHWP_BIN", "rhwp"), "export-pdf", source, "-o", os.path.join(folder, "in.pdf")]


PARSERS: dict[str, Callable[[bytes], Iterator[Row]]] = {
    "html": parse_html, "txt": parse_txt, "md": parse_md, "csv": parse_csv, "xlsx": parse_xlsx, "docx": parse_docx, "pdf": parse_pdf, "png": parse_image, "jpeg": parse_image,
    "ppt": convert_with(soffice, ".ppt"), "pptx": convert_with(soffice, ".pptx"), "hwpx": convert_with(rhwp, ".hwpx"),
}

#: Files whose lines are held together.
AT_ONCE = 256
PAGE_TYPE = pa.struct([("page", pa.int32()), ("width", pa.float64()), ("height", pa.float64()), ("image", pa.binary()), ("words", pa.list_(pa.struct([("text", pa.string()), ("bbox", pa.struct([(k, pa.float64()) for k in ("x0", "y0", "x1", "y1")]))])))])
BOX = "struct<x0: double, y0: double, x1: double, y1: double>"
PAGES = f"pages array<struct<page: int, width: double, height: double, image: binary, words: array<struct<text: string, bbox: {BOX}>>>>"
LINES = "ext string, error string, lines array<struct<seq: int, page: int, category: string, text: string, bbox: struct<x0: double, y0: double, x1: double, y1: double>, font_size: double>>"


def line_structs(lines: list[tuple]) -> pa.StructArray:
    """(seq, page, category, text, box, size) of lines as Arrow structs, column by column."""
    seq, page, category, text, box, size = zip(*lines, strict=True) if lines else ((),) * 6
    sides = pa.StructArray.from_arrays([pa.array(side, pa.float64()) for side in (zip(*box, strict=True) if box else ((),) * 4)], ["x0", "y0", "x1", "y1"])
    columns = [pa.array(seq, pa.int32()), pa.array(page, pa.int32()), pa.array(category, pa.string()), pa.array(text, pa.string()), sides, pa.array(size, pa.float64())]
    return pa.StructArray.from_arrays(columns, ["seq", "page", "category", "text", "bbox", "font_size"])


def register_parser(kind: str, parser: Callable[[bytes], Iterator[Row]]) -> None:
    """Use `parser` for files of that type."""
    PARSERS[kind] = parser


def parse(rows: DataFrame, kind: str | None = None) -> DataFrame:
    """rows (key, path, content binary) with ext, error, lines and pages. kind: of all rows, else each is sniffed.

    An error is `Name: text` of what a parser raised: errors_by_kind() counts them, so a fault of a parser shows.
    """
    parsers = dict(PARSERS)
    boxed = lambda b: dict(zip(("x0", "y0", "x1", "y1"), b, strict=True))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(a, AT_ONCE) for b in batches for a in range(0, len(b), AT_ONCE)):
            exts, errors, pages, lines, ends = [], [], [], [], [0]
            for path, content in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                ext, error, found, sheets = kind, None, [], []
                try:
                    ext = kind or sniff(path or "", content or b"")
                    if ext not in parsers:
                        raise ValueError(f"no parser for {ext}")
                    made = list(parsers[ext](content or b""))
                    sheets = [x._asdict() | {"words": None if x.words is None else [{"text": t, "bbox": boxed(b)} for t, b in x.words]} for x in made if isinstance(x, Page)]
                    found = [(i, *x) for i, x in enumerate(x for x in made if not isinstance(x, Page))]
                except Exception as e:  # one bad file is a row with an error, not a failed job
                    error, found, sheets = f"{type(e).__name__}: {e}", [], []
                exts.append(ext)
                errors.append(error)
                lines += found
                ends.append(len(lines))
                pages.append(sheets)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(exts, pa.string()), pa.array(errors, pa.string()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), line_structs(lines)), pa.array(pages, pa.list_(PAGE_TYPE))], ["key", "path", "ext", "error", "lines", "pages"])

    return rows.select("key", "path", "content").mapInArrow(run, f"key bigint, path string, {LINES}, {PAGES}")


def errors_by_kind(parsed: DataFrame) -> DataFrame:
    """(ext, error, n): how often files failed, by type and by the error's name."""
    return parsed.where("error is not null").groupBy("ext", F.substring_index("error", ":", 1).alias("error")).agg(F.count("*").alias("n"))


def pages_of(parsed: DataFrame) -> DataFrame:
    """doc_id, path, page, width, height, image, words of every page that a parser described."""
    return parsed.where("error is null").select(F.col("key").alias("doc_id"), "path", F.explode("pages").alias("x")).select("doc_id", "path", "x.*")


def words_of(pages: DataFrame) -> DataFrame:
    """doc_id, page, id, text, bbox of the words of pages."""
    return pages.select("doc_id", "page", F.posexplode("words").alias("id", "x")).select("doc_id", "page", "id", "x.text", "x.bbox")


def page_sizes(pages: DataFrame) -> DataFrame:
    """doc_id, page, width, height of the pages of files named .pdf."""
    return pages.where(F.lower("path").endswith(".pdf") & F.col("width").isNotNull()).select("doc_id", "page", "width", "height")


def lines_of(parsed: DataFrame) -> DataFrame:
    """doc_id, path, seq, page, category, text, bbox, font_size of every line."""
    return parsed.select(F.col("key").alias("doc_id"), "path", F.explode("lines").alias("x")).select("doc_id", "path", "x.*")


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Files under `path` with ext, error and lines; key is the hash of the path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return parse(files.select(F.xxhash64("path").alias("key"), "path", "content"))


def read_lines(spark: SparkSession, path: str, most: int = 50) -> tuple[DataFrame, DataFrame]:
    """Lines and pages of the files under `path`. Files named .pdf are read by ranges of `most` pages in tasks of their own, unless a library is at hand that renders them too."""
    from leafmill.sources import pdf

    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(F.xxhash64("path").alias("key"), "path", "content")
    if importlib.util.find_spec("fitz"):
        parsed = parse(found)
        return lines_of(parsed.where("error is null")), pages_of(parsed)
    named = F.lower("path").endswith(".pdf")
    parsed = parse(found.where(~named))
    by_range = pdf.read_pdf(found.where(named).drop("content"), most)
    sizes = by_range.where("page is not null").select(F.col("key").alias("doc_id"), "path", "page", "width", "height", F.lit(None).cast("binary").alias("image"), F.lit(None).cast(f"array<struct<text: string, bbox: {BOX}>>").alias("words"))
    lines = pdf.lines_of_spans(by_range).select("doc_id", F.lit(None).cast("string").alias("path"), "seq", "page", F.lit(None).cast("string").alias("category"), "text", "bbox", "font_size")
    return lines_of(parsed.where("error is null")).unionByName(lines), pages_of(parsed).unionByName(sizes)


def split_pages(lines: DataFrame, most: int = 50) -> DataFrame:
    """split_no of each page, as if long files were cut into files of `most` pages."""
    return lines.withColumn("split_no", F.expr(f"cast((page - 1) div {most} as int)"))
