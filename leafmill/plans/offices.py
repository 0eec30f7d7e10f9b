"""Workbooks made from orders and documents made from parts, for queries."""

from __future__ import annotations

import datetime as dt
import io
import zipfile
from collections.abc import Iterable, Iterator
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.plans import tables as D

MAIN, RELS = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
WORDS = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"


def zipped(parts: dict[str, str]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return out.getvalue()


def workbook(orders: list[dict]) -> bytes:
    """Two sheets, the first of them in the part with the greater number: orders under a merged caption, and after a blank row their notes."""
    strings = sorted({o["priority"] for o in orders})
    serial = lambda t: (t - dt.datetime(1899, 12, 30)) / dt.timedelta(days=1)
    head = "".join(f'<c t="inlineStr"><is><t>{x}</t></is></c>' for x in ("key", "price", "final", "day", "at", "took", "priority"))
    rows = [f'<row r="{i}"><c r="A{i}"><v>{o["key"]}</v></c><c r="B{i}"><v>{o["price"]!r}</v></c><c r="C{i}" t="b"><v>{int(o["status"] == "F")}</v></c><c r="D{i}" s="1"><v>{serial(o["day"]):.10g}</v></c><c r="E{i}" s="2"><v>{o["key"] % 24 / 24!r}</v></c><c r="F{i}" s="3"><v>{1 + o["key"] % 5 / 8!r}</v></c><c r="G{i}" t="s"><v>{strings.index(o["priority"])}</v></c></row>' for i, o in enumerate(orders, 3)]
    first = f'<worksheet xmlns="{MAIN}"><sheetData><row r="1"><c r="A1" t="str"><v>Orders</v></c><c r="G1"/></row><row r="2">{head}</row>{"".join(rows)}</sheetData><mergeCells count="1"><mergeCell ref="A1:G1"/></mergeCells></worksheet>'
    second = f'<worksheet xmlns="{MAIN}"><sheetData><row><c t="str"><v>n</v></c><c t="str"><v>ratio</v></c></row><row><c><v>{len(orders)}</v></c><c t="e"><v>#DIV/0!</v></c></row><row r="4"><c r="B4" t="str"><v>end</v></c></row></sheetData></worksheet>'
    return zipped({
        "xl/workbook.xml": f'<workbook xmlns="{MAIN}" xmlns:r="{RELS}"><sheets><sheet name="b" sheetId="2" r:id="rB"/><sheet name="a" sheetId="1" r:id="rA"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rA" Type="{RELS}/worksheet" Target="worksheets/sheet1.xml"/><Relationship Id="rB" Type="{RELS}/worksheet" Target="/xl/worksheets/sheet2.xml"/></Relationships>',
        "xl/styles.xml": f'<styleSheet xmlns="{MAIN}"><numFmts><numFmt numFmtId="170" formatCode="[$-409]yyyy\\-mm\\-dd;@"/><numFmt numFmtId="171" formatCode="[h]:mm"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="170"/><xf numFmtId="20"/><xf numFmtId="171"/></cellXfs></styleSheet>',
        "xl/sharedStrings.xml": f'<sst xmlns="{MAIN}">{"".join(f"<si><r><t>{escape(x[:1])}</t></r><r><t>{escape(x[1:])}</t></r><rPh><t>no</t></rPh></si>" for x in strings)}</sst>',
        "xl/worksheets/sheet1.xml": second,
        "xl/worksheets/sheet2.xml": first,
    })


def _made(rows: DataFrame, make, suffix: str) -> DataFrame:
    """key, path and content: make(value) of each row (key, value)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, values = (c.to_pylist() for c in batch.columns)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f"{k}.{suffix}" for k in keys]), pa.array([make(v) for v in values], pa.binary())], ["key", "path", "content"])

    return rows.mapInArrow(run, "key bigint, path string, content binary")


def orders_as_workbooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A workbook for each customer with orders."""
    row = F.struct(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status"), F.col("o_orderdate").cast("timestamp_ntz").alias("day"), F.col("o_orderpriority").alias("priority"))
    rows = D.spread(D.read(spark, sf_dir, "orders"), "o_custkey").groupBy(F.col("o_custkey").alias("key")).agg(F.sort_array(F.collect_list(row)).alias("value"))
    return _made(rows, workbook, "xlsx")


STYLES = ("Title", "heading 2", "Subtitle", "Subtitle Small", "caption", "Captioned", "List Bullet", "Normal")


def word_document(part: dict) -> bytes:
    """A paragraph in each style, a numbered one, one of an unknown style, one with a tab, a break and a link, and a table with a wide and a high cell."""
    styles = "".join(f'<w:style w:type="paragraph" w:styleId="s{i}"{" w:default=\'1\'" if x == "Normal" else ""}><w:name w:val="{x}"/></w:style>' for i, x in enumerate(STYLES))
    run = lambda t: f"<w:r><w:t>{escape(t)}</w:t></w:r>"
    p = lambda inner, head="": f"<w:p><w:pPr>{head}</w:pPr>{inner}</w:p>"
    name, brand = part["name"], part["brand"]
    body = "".join(p(run(f"{x} {name}"), f'<w:pStyle w:val="s{i}"/>') for i, x in enumerate(STYLES))
    body += p(run(name), "<w:numPr/>") + p(run(brand), '<w:pStyle w:val="none"/>') + p(f"<w:r><w:t>{escape(name)}</w:t><w:tab/><w:t>b</w:t><w:br/></w:r><w:hyperlink>{run(brand)}</w:hyperlink>") + p("<w:r> </w:r>")
    cell = lambda t, head="": f"<w:tc><w:tcPr>{head}</w:tcPr>{p(run(t))}</w:tc>"
    wide, high, on = '<w:gridSpan w:val="2"/>', '<w:vMerge w:val="restart"/>', "<w:vMerge/>"
    body += f"<w:tbl><w:tr>{cell('<' + name, wide)}{cell('h', high)}</w:tr><w:tr>{cell('1')}{cell('2')}{cell('', on)}</w:tr></w:tbl>"
    return zipped({"word/document.xml": f'<w:document xmlns:w="{WORDS}"><w:body>{body}</w:body></w:document>', "word/styles.xml": f'<w:styles xmlns:w="{WORDS}">{styles}</w:styles>'})


def parts_as_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = D.spread(D.read(spark, sf_dir, "part"), "p_partkey").select(F.col("p_partkey").alias("key"), F.struct(F.col("p_name").alias("name"), F.col("p_brand").alias("brand")).alias("value"))
    return _made(rows, word_document, "docx")


def as_files(rows: DataFrame, folder: str) -> DataFrame:
    """Each row (name, text) as a file under `folder`; name and path, as Spark names it, of those that are there."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        for batch in batches:
            for name, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with store.open_output_stream(f"{base}/{name}") as out:
                    out.write((text or "").encode())
            yield pa.RecordBatch.from_arrays([batch.column(0)], ["name"])

    rows.mapInArrow(run, "name string").write.format("noop").mode("overwrite").save()
    found = rows.sparkSession.read.format("binaryFile").load(folder).select("path")
    return found.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "path")
