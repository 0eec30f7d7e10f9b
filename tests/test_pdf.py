"""The PDF reader on files that are written here, by hand and by plans.pdfs."""

import io

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from leafmill.plans import pdfs, pipeline
from leafmill.sources import files, pdf

PAGES = [(300.0 + k, 400.0, [(f"Quay {k} (north) \\ east", 12, 50, 350), ("Größe – 5 €", 18, 50, 320)]) for k in range(5)]


def texts(content):
    return [[t for t, _, _ in pdf.lines_in_order(pdf.Interpreter(d).page(p), 0, 0)] for d in [pdf.Document(io.BytesIO(content))] for p in d.pages()]


def by_hand(contents, fonts="/F1 << /Type /Font /Subtype /Type1 /Encoding /WinAnsiEncoding >>", more="", table=True):
    """A file with one page of these operators; without `table` its references are nowhere."""
    out = f"%PDF-1.4\n1 0 obj << /Type /Catalog /Pages 2 0 R >> endobj\n2 0 obj << /Type /Pages /Count 1 /Kids [3 0 R] /MediaBox [0 0 200 100] >> endobj\n3 0 obj << /Type /Page /Parent 2 0 R /Contents 4 0 R /Resources << /Font << {fonts} >> {more} >> >> endobj\n".encode()
    out += b"4 0 obj << /Length %d >> stream\n%s\nendstream endobj\n" % (len(contents), contents)
    places = [out.find(b"%d 0 obj" % i) for i in range(1, 5)]
    if not table:
        return out + b"trailer << /Root 1 0 R >>"
    return out + b"xref\n0 5\n0000000000 65535 f \n" + b"".join(b"%010d 00000 n \n" % x for x in places) + b"trailer << /Size 5 /Root 1 0 R >>\nstartxref\n%d\n%%%%EOF" % len(out)


@pytest.mark.parametrize("packed", [False, True])
def test_both_forms_of_files(packed):
    content = pdfs.write_pdf(PAGES, packed)
    assert texts(content) == [[t for t, *_ in lines] for _, _, lines in PAGES]
    doc = pdf.Document(io.BytesIO(content))
    assert [doc.box(p) for p in doc.pages()] == [(0, 0, w, h) for w, h, _ in PAGES]
    assert texts(pdfs.write_pdf([(9.0, 9.0, [("日本 ☃ 𝄞 é", 9, 1, 1)])], packed)) == [["日本 ☃ 𝄞 é"]]


def test_a_file_without_its_table_is_scanned():
    content = by_hand(b"BT /F1 9 Tf 5 50 Td (still here) Tj ET", table=False)
    assert texts(content) == [["still here"]]
    broken = pdfs.write_pdf(PAGES, True)
    assert texts(broken[: broken.rfind(b"startxref")] + b"startxref\n5\n%%EOF") == texts(broken)


def test_strings_and_operators():
    shown = lambda x, **more: texts(by_hand(x, **more))[0]
    assert shown(rb"BT /F1 10 Tf 5 50 Td (a\(b\) \101\7 c\\ (in (side)) \
x) Tj ET") == ["a(b) A\x07 c\\ (in (side)) x"]
    assert shown(b"BT /F1 10 Tf 14 TL 5 90 Td <48 69 2> Tj T* (two) Tj (three) ' 1 2 (four) \" ET") == ["Hi ", "two", "three", "four"]
    assert shown(b"BT /F1 10 Tf 5 50 Td [(ab) -300 (cd) 20 (ef)] TJ ET") == ["ab cdef"]
    assert shown(b"BT /F1 10 Tf 1 0 0 1 5 50 Tm (left) Tj 1 0 0 1 150 50 Tm (right) Tj 1 0 0 1 5 50 Tm (again) Tj ET") == ["left", "right", "again"]
    assert shown(b"BT /F1 10 Tf 5 50 Td (before) Tj ET BI /W 2 /H 1 ID \x00(EI\xff) EI BT /F1 10 Tf 5 20 Td (behind) Tj ET") == ["before", "behind"]
    assert shown(b"/F1 5 Tf (no place) Tj 5 Td ] >> (odd) Tj % (not this) Tj\nQ") == ["no placeodd"]
    assert shown(b"") == shown(b"BT (no font) Tj ET") == []


def test_places_and_sizes():
    content = by_hand(b"q 2 0 0 2 10 0 cm BT /F1 10 Tf 5 20 Td (abcd) Tj ET Q BT /F1 8 Tf 1 0 0 1 0 10 Tm (x) Tj ET", "/F1 << /Subtype /Type1 /FirstChar 97 /Widths [500 500 1000 1000] >>")
    doc = pdf.Document(io.BytesIO(content))
    (first, second), = [list(pdf.Interpreter(doc).page(p)) for p in doc.pages()]
    assert first == ("abcd", 20.0, 20.0, 40.0, 80.0) and second[:4] == ("x", 8.0, 0.0, 10.0)


def test_encodings():
    shown = lambda x, fonts: texts(by_hand(x, fonts))[0]
    differences = "/F1 << /Subtype /Type1 /Encoding << /Differences [65 /eacute /uni20AC /fi 70 /Zcaron /nothing /germandbls] >> >>"
    assert shown(b"BT /F1 9 Tf 5 5 Td (ABCDFGH) Tj ET", differences) == ["é€ﬁDŽß"]
    assert shown(b"BT /F1 9 Tf 5 5 Td (\x8a) Tj ET", "/F1 << /Subtype /TrueType /Encoding /MacRomanEncoding >>") == ["ä"]


def test_forms_and_revisions():
    form = b"5 0 obj << /Type /XObject /Subtype /Form /Matrix [1 0 0 1 0 40] /Resources << /Font << /F1 << /Subtype /Type1 >> >> /XObject << /X 5 0 R >> >> /Length 46 >> stream\nBT /F1 9 Tf 5 5 Td (in a form) Tj ET /X Do    \nendstream endobj\n"
    content = by_hand(b"/X Do", more="/XObject << /X 5 0 R >>")
    start, old = len(content), int(content.rsplit(b"startxref\n", 1)[1].split(b"\n")[0])
    content += form + b"xref\n5 1\n%010d 00000 n \ntrailer << /Size 6 /Root 1 0 R /Prev %d >>\nstartxref\n%d\n%%%%EOF" % (start, old, start + len(form))
    assert texts(content)[0][0] == "in a form"


@pytest.mark.parametrize("kind", [1, 2, 10, 11, 12, 13, 14])
def test_predictors(kind):
    rows = [bytes((7 * i + j * j) % 256 for j in range(12)) for i in range(5)]
    told, above = b"", bytes(12)
    for row in rows:
        left = bytes(3) + row[:-3]
        corner = bytes(3) + above[:-3]
        near = lambda a, b, c: min((a, b, c), key=lambda v: abs(a + b - c - v))
        guess = {1: bytes(12), 2: left, 10: bytes(12), 11: left, 12: above, 13: bytes((a + b) // 2 for a, b in zip(left, above, strict=True)), 14: bytes(near(a, b, c) for a, b, c in zip(left, above, corner, strict=True))}[kind]
        told += (bytes([kind - 10]) if kind >= 10 else b"") + bytes((x - g) & 255 for x, g in zip(row, guess, strict=True))
        above = row
    assert pdf.unpredicted(told, {"Predictor": kind, "Colors": 3, "Columns": 4}) == b"".join(rows)


def test_a_long_file_is_read_by_several_tasks(spark, sf_dir, tmp_path):
    """200 pages of the lines of documents, in one file: ranges of 50 pages in four tasks, the rows of one range."""
    lines = [t for r in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").limit(80).collect() for t in (r["text"] or "").split("\n") if t.strip()][:400]
    pages = [(595.0, 842.0, [(lines[(2 * k + i) % len(lines)][:80], 12, 50, 800 - 20 * i) for i in range(2)]) for k in range(200)]
    (tmp_path / "long.pdf").write_bytes(pdfs.write_pdf(pages, True))
    (tmp_path / "bad.pdf").write_bytes(b"%PDF-1.4 nothing")
    (tmp_path / "locked.pdf").write_bytes(by_hand(b"").replace(b"/Size 5", b"/Encrypt 9 0 R /Size 5"))
    found = spark.read.format("binaryFile").load(f"{tmp_path}/*.pdf").select(F.xxhash64("path").alias("key"), "path", "length")
    read = pdf.read_pdf(found, 50, tasks=16).withColumn("task", F.spark_partition_id()).cache()
    good = read.where("error is null")
    assert good.count() == 200 and {r["n"] for r in good.groupBy("split_no").agg(F.count("*").alias("n")).collect()} == {50}
    assert good.select("split_no", "task").distinct().count() == 4 and good.select("task").distinct().count() > 1
    assert sorted(r["error"].split(":")[0] for r in read.where("error is not null").collect()) == ["ValueError"] * 2
    whole = pdf.lines_of_spans(pdf.read_pdf(found, 10_000)).orderBy("page", "seq").collect()
    by_range = pdf.lines_of_spans(good).orderBy("page", "seq").collect()
    assert by_range == whole and [r["text"] for r in whole] == [t for _, _, ls in pages for t, *_ in ls if t.strip()]
    # What is relational and what is plain agree, and the pipeline takes such files.
    plain = [(r[0], r[2]) for r in files.pdf_spans((tmp_path / "long.pdf").read_bytes()) if not isinstance(r, files.Page)]
    assert plain == [(r["page"], r["text"]) for r in whole]
    records = pipeline.process(spark, str(tmp_path), pipeline.Config(reg_date="x"))
    assert records.count() > 0 and records.where("e_page > 190 and chunk_bboxes is not null").count() > 0


def test_no_files(spark):
    none = spark.createDataFrame([], "key bigint, path string, content binary")
    assert pdf.read_pdf(none).count() == 0


def test_pages_leave_tasks_together(spark):
    """Pages of many small files are few Arrow batches, and operands read by one pattern are those of the general reader."""
    from leafmill.sources import pdf

    for data in (b"1 0 0 1 50 .5 Tm (a\\(b) Tj <4 1> Tj [(x) -300 (y)] TJ 1. 2 Td +3 4.25 Td % c\n--3 2 Td /F#31 true null (a\rb) Tj (q(n)ested)' T* <> Tj q", b"12", b"Tj", b"", b"/", b"1.5.2 3-4 abc\0def \0 9 "):
        general, quick = pdf.Reader(data), pdf.Reader(data)
        while general.skip() or general.peek():
            x, y = general.next(False), quick.operand()
            assert (type(x), x) == (type(y), y)
        assert quick.skip() or not quick.peek()
    from leafmill.plans import pdfs

    content = pdfs.write_pdf(pdfs.pages_of_text("Harbour\nShips lie at the east quay."))
    files = spark.createDataFrame([(i, f"{i}.pdf", bytearray(content)) for i in range(40)], "key bigint, path string, content binary").coalesce(1)
    batches = pdf.read_pdf(files, tasks=1).select("key").mapInArrow(lambda found: (pa.RecordBatch.from_arrays([pa.array([len(b)])], ["n"]) for b in found), "n bigint")
    assert [r["n"] for r in batches.collect()] == [40]
