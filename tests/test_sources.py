"""Parsers on files that are built here."""

import io
import zipfile

import pytest

from leafmill.plans import pipeline
from leafmill.sources import files, office
from leafmill.streaming.files import watch


def texts(rows):
    return [(r[1], r[2]) for r in rows]


def zipped(**members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in members.items():
            z.writestr(name.replace("__", "/") + ".xml", text)
    return out.getvalue()


def test_sniff():
    assert files.sniff("x", b"%PDF-1") == "pdf" and files.sniff("x", b"\x89PNG\r\n\x1a\n") == "png" and files.sniff("x.csv", b"  <HTML>") == "html"
    assert files.sniff("a.md", b"# x") == "md" and files.sniff("x", zipped(xl__workbook="")) == "xlsx"
    with pytest.raises(ValueError):
        files.sniff("x.bin", b"abc")


def test_html():
    page = b"<html><body><h1>Pier</h1><p>one <b>two</b></p><h2>Slip</h2><script>x</script><style>y</style></body></html>"
    assert [(r[2], r[4]) for r in files.parse_html(page)] == [("Pier", 24.0), ("onetwo", 12.0), ("Slip", 20.0)]


def test_markdown():
    md = b"# Head\n\ntext\n- one\n2) two\n| a | b |\n|---|---|\n| 1 | 2 |\n```\ncode\n  more\n```\n"
    assert texts(files.parse_md(md)) == [("section_header", "Head"), ("text", "text"), ("list_item", "one"), ("list_item", "two"), ("table", "<table><thead><tr><th>a</th><th>b</th></tr></thead><tbody><tr><td>1</td><td>2</td></tr></tbody></table>"), ("code", "code\n  more")]


def test_text_and_csv():
    assert [t for _, t in texts(files.parse_txt(b"  Fog at dawn.\r\n \r\n\r\nWind from the north,\r\nrising.\n\nRain."))] == ["Fog at dawn.", "Wind from the north,\nrising.", "Rain."]
    assert len(list(files.parse_csv(b"a,b\n1,2\n\nc,d\n3,4\n"))) == 2
    assert "<th>knots</th>" in next(files.parse_csv("\ufeffknots,bearing\n5,120\n".encode()))[2]


def test_xlsx():
    sheet = f'<worksheet xmlns="{office.S[1:-1]}"><sheetData><row r="1"><c r="A1" t="inlineStr"><is><t>Top</t></is></c></row><row r="2"><c r="A2"><v>1</v></c><c r="B2"><v>2</v></c></row><row r="3"><c r="A3"><v>3</v></c></row></sheetData><mergeCells><mergeCell ref="A1:B1"/></mergeCells></worksheet>'
    (row,) = files.parse_xlsx(zipped(xl__worksheets__sheet1=sheet))
    assert row[2].startswith("<table><caption>Top</caption><thead><tr><th>1</th><th>2</th>")


def test_numbers_of_cells():
    assert [office.kind_of(c, 0) for c in ("0.00", 'yyyy"d"', '0"d"', "[Red]0", "[h]:mm:ss", "[$-F800]dddd", "General", "mm:ss")] == ["number", "date", "number", "number", "duration", "date", "number", "date"]
    assert [office.kind_of(None, n) for n in (0, 14, 22, 46, 49)] == ["number", "date", "date", "duration", "number"]
    shown = lambda text, kind="date", first=office.FIRST_DAY: office.number_text(text, kind, first)
    assert [shown("45292"), shown("45292.75"), shown("0.5"), shown("1"), shown("60"), shown("0", first=office.FIRST_DAY_1904)] == ["2024-01-01 00:00:00", "2024-01-01 18:00:00", "12:00:00", "1900-01-01 00:00:00", "1900-02-28 00:00:00", "00:00:00"]
    assert [shown("1.5", "duration"), shown("7", "number"), shown("7.0", "number"), shown("1E3", "number"), shown("1e20")] == ["1 day, 12:00:00", "7", "7.0", "1000.0", "#VALUE!"]


def test_a_workbook_without_references():
    sheet = f'<worksheet xmlns="{office.S[1:-1]}"><sheetData><row><c t="str"><v>a</v></c><c t="b"><v>1</v></c></row><row><c/><c t="str"><v>b</v></c></row><row r="5"><c t="str"><v>c</v></c></row></sheetData></worksheet>'
    assert list(office.sheet_grids(zipped(xl__worksheets__sheet1=sheet, xl__worksheets__sheet10=sheet.replace("c<", "d<"), xl__worksheets__sheet2="<worksheet/>"))) == [
        [["a", "True"], ["", "b"], ["", ""], ["", ""], ["c", ""]], [], [["a", "True"], ["", "b"], ["", ""], ["", ""], ["d", ""]],
    ]


def test_docx():
    w = office.W[1:-1]
    body = '<w:p><w:pPr><w:pStyle w:val="Heading1"/></w:pPr><w:r><w:t>Head</w:t></w:r></w:p><w:p><w:r><w:t>Text</w:t></w:r></w:p><w:p><w:pPr><w:numPr/></w:pPr><w:r><w:t>Item</w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:p><w:r><w:t>a&lt;</w:t></w:r></w:p></w:tc></w:tr></w:tbl>'
    doc = zipped(word__document=f'<w:document xmlns:w="{w}"><w:body>{body}</w:body></w:document>')
    assert texts(files.parse_docx(doc)) == [("section_header", "Head"), ("text", "Text"), ("list_item", "Item"), ("table", "<table><tbody><tr><td>a&lt;</td></tr></tbody></table>")]


def test_spans():
    assert files.join_spans([("calm", 10, (0, 0, 30, 1)), ("sea", 10, (33, 0, 63, 1))]) == "calm sea"
    assert files.join_spans([("mo", 10, (0, 0, 15, 1)), ("or", 10, (15.5, 0, 25, 1))]) == "moor"
    assert files.dominant_size([("ab", 6, ()), ("abcdef", 10, ())]) == 10


def test_png_size():
    assert files.png_size(b"\x89PNG\r\n\x1a\n" + bytes(8) + (123).to_bytes(4, "big") + (456).to_bytes(4, "big")) == (123, 456)
    assert files.png_size(b"x") is None


def test_folder_and_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.md").write_text("# Head\n\nbody of a\n")
    (tmp_path / "in" / "b.txt").write_text("one\n\ntwo\n")
    (tmp_path / "in" / "c.bin").write_bytes(b"??")
    read = files.read_files(spark, str(tmp_path / "in"))
    assert read.where("error is not null").count() == 1
    config = pipeline.Config(reg_date="x")
    assert {r["text"] for r in pipeline.process(spark, str(tmp_path / "in"), config).collect()} == {"Head, body of a", "one two"}  # the second paragraph continues the first
    watch(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp"), config, once=True).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_fragments():
    found = [("East ", 10.0, 700.0, 9.0), (" ", 0.0, 0.0, 1.0), ("quay", 40.0, 700.5, 12.0), ("West", 10.0, 680.0, 9.0)]
    assert list(files.lines_of_fragments(found)) == [("East quay", (10.0, 700.5, 64.0, 712.5), 12.0), ("West", (10.0, 680.0, 28.0, 689.0), 9.0)]
    assert list(files.lines_of_fragments([])) == []


def test_a_converter_that_fails_is_an_error(spark, monkeypatch):
    """The program's output is read as a PDF; one that ends badly or writes nothing is an error of that row."""
    silent = files.convert_with(lambda source, folder: ["true"], ".ppt")
    with pytest.raises(RuntimeError):
        list(silent(b"x"))
    monkeypatch.setattr(files, "parse_pdf", lambda content: iter([(1, None, content.decode(), files.NOWHERE, None)]))
    copied = files.convert_with(lambda source, folder: ["cp", source, f"{folder}/in.pdf"], ".ppt")
    assert [r[2] for r in copied(b"slides")] == ["slides"]
    assert files.soffice("a.ppt", "/f")[-1] == "a.ppt" and files.rhwp("a.hwp", "/f")[1:3] == ["export-pdf", "a.hwp"]


def test_errors_are_counted_by_kind(spark):
    bad = files.parse(spark.createDataFrame([(1, "a.bin", b"?"), (2, "b.bin", b"?"), (3, "c.docx", b"PK\x03\x04")], "key bigint, path string, content binary"))
    assert {(r["error"], r["n"]) for r in files.errors_by_kind(bad).collect()} == {("ValueError", 2), ("BadZipFile", 1)}


def test_files_are_made_and_read_in_many_tasks(spark, sf_dir):
    """A table that is one task by its bytes is spread before Python makes or reads its files."""
    from leafmill import catalog

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for name in ("docx_items", "xlsx_tables", "md_blocks", "html_lines"):
        rows = catalog.QUERIES[name](spark, sf_dir)
        assert "REPARTITION_BY_NUM" in rows._jdf.queryExecution().executedPlan().toString() and parts > 1, name
