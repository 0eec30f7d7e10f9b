"""Registered queries over the driver's tables, and the SQL that gives the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafmill.functions import text as T
from leafmill.operators import chunk, clean, layout, metadata, models, order, tables
from leafmill.plans import offices, pdfs, pipeline, stubs
from leafmill.plans import tables as D
from leafmill.sources import datasource, files, pdf
from leafmill.store import shared_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
REG_DATE = "2024-01-01T00:00:00Z"


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# --- relations that several oracles share -------------------------------------------------------

ITEMS = """items AS (
  SELECT doc_id, CAST(i AS INT) AS seq, CAST(i // 10 + 1 AS INT) AS page, l[i + 1] AS text, CASE WHEN length(l[i + 1]) <= 40 THEN 'section_header' ELSE 'text' END AS category
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL) d, unnest(range(len(l))) AS r(i))"""
SECTIONS = ITEMS + """, sec AS (SELECT *, sum(CASE WHEN category = 'section_header' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY seq) AS section FROM items),
 grouped AS (SELECT doc_id, section, max(CASE WHEN category = 'section_header' THEN text END) AS heading, coalesce(string_agg(CASE WHEN category <> 'section_header' THEN text END, chr(10) ORDER BY seq), '') AS body, min(page) AS i_page, max(page) AS e_page FROM sec GROUP BY doc_id, section),
 filled AS (SELECT * FROM grouped WHERE coalesce(heading, '') <> '' OR body <> '')"""


def rendered(heading: str, body: str) -> str:
    return f"CASE WHEN coalesce({heading}, '') = '' THEN {body} WHEN {body} = '' THEN {heading} ELSE {heading} || ', ' || {body} END"


def cut(size: int, overlap: int, source: str, keys: str, body: str = "body") -> str:
    step = size - overlap
    return f"""(SELECT {keys}, i AS piece, substr({body}, i * {step} + 1, {size}) AS part, i * {step} AS s, least(i * {step} + {size}, length({body})) AS e
      FROM {source}, unnest(range(greatest(1, CAST(ceil((length({body}) - {size}) / {step}.0) AS BIGINT) + 1))) AS r(i))"""


def smart_sql(size: int, overlap: int) -> str:
    return f"""{SECTIONS}, pieces AS {cut(size, overlap, "filled", "doc_id, section, heading, i_page, e_page")},
 chunks AS (SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY section, piece) - 1 AS INT) AS chunk_no, {rendered("heading", "part")} AS text, i_page, e_page, section, piece, s, e FROM pieces)"""


BASE = ITEMS + """, carried AS (SELECT *, last_value(CASE WHEN category = 'section_header' THEN text END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY seq) AS heading FROM items),
 base AS (SELECT doc_id, seq, page, text, heading, row_number() OVER (PARTITION BY doc_id ORDER BY seq) AS rn FROM carried WHERE category <> 'section_header' AND text <> '')"""
PLAIN = ("doc_id", "chunk_no", "text", "i_page", "e_page")

# --- text rules -----------------------------------------------------------------------------------

_TYPO = "replace(replace(text, ' of ', ' • '), ', ', '’ ')"


@query(f"WITH {ITEMS} SELECT doc_id, seq, translate({_TYPO}, '⁄‘’“”•', '/''''\"\"·') AS text FROM items")
def normalize_typography(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = F.replace(F.replace("text", F.lit(" of "), F.lit(" • ")), F.lit(", "), F.lit("’ "))
    return D.items_doc(spark, sf_dir).select("doc_id", "seq", T.normalize_typography(typed).alias("text"))


CORRUPT = ITEMS + """, corrupt AS (SELECT doc_id, seq, page, CASE WHEN seq % 3 = 0 THEN replace(text, 'thth', chr(65533)) || CASE WHEN doc_id % 5 = 0 THEN 'GLYPH<41>' ELSE '' END ELSE text END AS text FROM items),
 flags AS (SELECT *, length(text) - length(regexp_replace(text, '[\\x{FFFD}\\x{E000}-\\x{F8FF}]', '', 'g')) AS bad, regexp_matches(text, 'GLYPH<[0-9A-Fa-f]+>') OR regexp_matches(text, '(/G\\d+){2,}') OR regexp_matches(text, '^(/\\w+\\s*){2,}') AS garbled FROM corrupt)"""


@query(f"WITH {CORRUPT} SELECT doc_id, seq, CAST(bad AS INT) AS n_bad FROM flags")
def bad_char_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.corrupt_lines(spark, sf_dir).select("doc_id", "seq", T.bad_chars(F.col("text")).alias("n_bad"))


@query(f"WITH {CORRUPT} SELECT doc_id, seq, garbled FROM flags")
def garbled_glyph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.corrupt_lines(spark, sf_dir).select("doc_id", "seq", T.garbled(F.col("text")).alias("garbled"))


@query(f"WITH {CORRUPT} SELECT doc_id, seq, bad >= 1 OR garbled AS corrupted FROM flags")
def line_glyph_corruption(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.corrupt_lines(spark, sf_dir).select("doc_id", "seq", T.corrupted(F.col("text")).alias("corrupted"))


@query(f"WITH {CORRUPT} SELECT doc_id, page, bool_or(garbled) OR sum(bad) > 3 AS damaged FROM flags GROUP BY doc_id, page")
def page_glyph_corruption(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate's verdict over pages that all have lines."""
    lines = D.corrupt_lines(spark, sf_dir)
    return pipeline.needs_ocr(lines, lines.select("doc_id", "page").distinct()).withColumnRenamed("ocr", "damaged")


@query(f"WITH {CORRUPT}, pages AS (SELECT doc_id, CAST(page AS INT) AS page FROM corrupt UNION SELECT doc_id, 1000 FROM documents) SELECT p.doc_id, p.page, coalesce(bool_or(f.garbled) OR sum(f.bad) > 3, true) AS ocr FROM pages p LEFT JOIN flags f USING (doc_id, page) GROUP BY p.doc_id, p.page")
def ocr_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = D.corrupt_lines(spark, sf_dir)
    empty = D.read(spark, sf_dir, "documents").select("doc_id", F.lit(1000).alias("page"))
    return pipeline.needs_ocr(lines, lines.select("doc_id", "page").union(empty).distinct())


LABELS = "(['Text','Title','List-item','Table','Picture','Code','Strange label'])[CAST(c_custkey % 7 + 1 AS INT)]"
REGIONS = f"""regions AS (SELECT c_custkey // 150 AS doc_id, CAST(c_custkey // 30 % 5 + 1 AS INT) AS page, CAST(c_custkey AS INT) AS region_no, {LABELS} AS label, (c_custkey % 100) / 100.0::DOUBLE AS confidence,
  CAST(c_custkey // 6 * 41 % 480 + c_custkey % 3 AS DOUBLE) AS l, CAST(c_custkey // 6 * 59 % 640 AS DOUBLE) AS t, CAST(c_custkey // 6 * 41 % 480 + 40 + c_custkey % 80 AS DOUBLE) AS r, CAST(c_custkey // 6 * 59 % 640 + 30 + c_custkey % 70 AS DOUBLE) AS b FROM customer),
 named AS (SELECT *, CASE label WHEN 'Strange label' THEN 'text' ELSE replace(lower(label), '-', '_') END AS category FROM regions)"""
LINES = """lines AS (SELECT p_partkey // 200 AS doc_id, CAST(p_partkey // 40 % 5 + 1 AS INT) AS page, CAST(p_partkey AS INT) AS seq, p_name AS text, CAST(p_partkey * 37 % 500 AS DOUBLE) AS x0, CAST(p_partkey * 53 % 700 AS DOUBLE) AS y0,
  CAST(p_partkey * 37 % 500 + 20 + p_partkey % 60 AS DOUBLE) AS x1, CAST(p_partkey * 53 % 700 + 8 + p_partkey % 9 AS DOUBLE) AS y1, CAST(8 + p_partkey % 4 * 2 AS DOUBLE) AS font_size FROM part)"""
#: The same on fifty pages, however many there are.
CROWDED_REGIONS = f"""regions AS (SELECT c_custkey % 10 AS doc_id, CAST(c_custkey // 10 % 5 + 1 AS INT) AS page, CAST(c_custkey AS INT) AS region_no, {LABELS} AS label, (c_custkey % 100) / 100.0::DOUBLE AS confidence,
  CAST(c_custkey // 100 * 41 % 480 + c_custkey % 3 AS DOUBLE) AS l, CAST(c_custkey // 100 * 59 % 640 AS DOUBLE) AS t, CAST(c_custkey // 100 * 41 % 480 + 40 + c_custkey % 80 AS DOUBLE) AS r, CAST(c_custkey // 100 * 59 % 640 + 30 + c_custkey % 70 AS DOUBLE) AS b FROM customer),
 named AS (SELECT *, CASE label WHEN 'Strange label' THEN 'text' ELSE replace(lower(label), '-', '_') END AS category FROM regions)"""
CROWDED_LINES = """lines AS (SELECT p_partkey % 10 AS doc_id, CAST(p_partkey // 10 % 5 + 1 AS INT) AS page, CAST(p_partkey AS INT) AS seq, p_name AS text, CAST(p_partkey * 37 % 500 AS DOUBLE) AS x0, CAST(p_partkey * 53 % 700 AS DOUBLE) AS y0,
  CAST(p_partkey * 37 % 500 + 20 + p_partkey % 60 AS DOUBLE) AS x1, CAST(p_partkey * 53 % 700 + 8 + p_partkey % 9 AS DOUBLE) AS y1, CAST(8 + p_partkey % 4 * 2 AS DOUBLE) AS font_size FROM part)"""


@query(f"WITH {REGIONS} SELECT doc_id, page, region_no, category FROM named")
def label_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.boxes_regions(spark, sf_dir).select("doc_id", "page", "region_no", T.to_category(F.col("category")).alias("category"))


@query(f"WITH {REGIONS} SELECT doc_id, page, region_no, CASE category WHEN 'title' THEN 'section_header' ELSE category END AS category FROM named WHERE confidence >= CASE WHEN category IN ('title', 'code') THEN 0.45 ELSE 0.5 END AND NOT (category = 'picture' AND (r - l) * (b - t) > 0.9 * 100 * 90)")
def confidence_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.filter_regions(D.boxes_regions(spark, sf_dir), 100.0, 90.0).select("doc_id", "page", "region_no", "category")


# --- sources --------------------------------------------------------------------------------------


@query(f"WITH {ITEMS} SELECT doc_id, seq, page, category, text FROM items")
def line_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.items_doc(spark, sf_dir).select("doc_id", "seq", "page", "category", "text")


@query("""WITH t AS (SELECT doc_id, list_filter(list_transform(string_split_regex(trim(replace(text, '. ', '.' || chr(10) || chr(10)), ' ' || chr(10) || chr(9) || chr(13)), '\\n\\s*\\n+'), lambda x: trim(x, ' ' || chr(10) || chr(9) || chr(13))), lambda x: x <> '') AS l FROM documents)
 SELECT doc_id, CAST(i AS INT) AS seq, l[i + 1] AS text FROM t, unnest(range(len(l))) AS r(i)""")
def txt_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences of documents as paragraphs of text files."""
    made = F.replace("text", F.lit(". "), F.lit(".\n\n"))
    rows = D.read(spark, sf_dir, "documents").select(F.col("doc_id").alias("key"), F.lit(None).cast("string").alias("path"), F.encode(made, "utf-8").alias("content"))
    return files.lines_of(files.parse(rows, "txt")).select("doc_id", "seq", "text")


def _contents(spark: SparkSession, sf_dir: str, table: str, key: str, column: str) -> DataFrame:
    return D.spread(D.read(spark, sf_dir, table).select(F.col(key).alias("key"), F.lit(None).cast("string").alias("path"), F.encode(column, "utf-8").alias("content")), "key")


@query()
def html_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = files.lines_of(files.parse(_contents(spark, sf_dir, "pages", "page_id", "html"), "html"))
    return layout.rule_layout(lines).select("doc_id", "seq", "category", "text", "font_size")


@query("""WITH l AS (SELECT doc_id, i, trim(x[i + 1], ' ' || chr(9)) AS t FROM (SELECT doc_id, string_split(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10)) AS x FROM documents) d, unnest(range(len(x))) AS r(i)),
 m AS (SELECT doc_id, i, CASE WHEN regexp_matches(t, '^#{1,6}\\s+') THEN 'section_header' WHEN regexp_matches(t, '^(?:[-*+]|\\d+[.)])\\s+') THEN 'list_item' ELSE 'text' END AS category, CASE WHEN regexp_matches(t, '^#{1,6}\\s+') THEN regexp_replace(t, '^#{1,6}\\s+', '') WHEN regexp_matches(t, '^(?:[-*+]|\\d+[.)])\\s+') THEN regexp_replace(t, '^(?:[-*+]|\\d+[.)])\\s+', '') ELSE t END AS text FROM l WHERE t <> '')
 SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS INT) AS seq, category, text FROM m WHERE text <> ''""")
def md_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.lines_of(files.parse(_contents(spark, sf_dir, "documents", "doc_id", "text"), "md")).select("doc_id", "seq", "category", "text")


@query()
def csv_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.lines_of(files.parse(_contents(spark, sf_dir, "documents", "doc_id", "text"), "csv")).select("doc_id", "seq", "text")


@query(f"WITH {ITEMS} SELECT doc_id, seq, page, CAST((page - 1) // 2 AS INT) AS split_no FROM items")
def page_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.split_pages(D.items_doc(spark, sf_dir), 2).select("doc_id", "seq", "page", "split_no")


PDF_LINES = """l AS (SELECT doc_id, i, CAST(i // 40 + 1 AS INT) AS page, x[i + 1] AS text FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents) d, unnest(range(len(x))) AS r(i))"""


@query(f"""WITH {PDF_LINES} SELECT doc_id, page, CAST(row_number() OVER (PARTITION BY doc_id, page ORDER BY i) - 1 AS INT) AS seq, text, CASE WHEN length(text) <= 40 THEN 18.0::DOUBLE ELSE 12.0::DOUBLE END AS font_size, 50.0::DOUBLE AS x0, round(18.0::DOUBLE * (i % 40 + 1) - 0.8::DOUBLE * CASE WHEN length(text) <= 40 THEN 18 ELSE 12 END, 6) AS y0
 FROM l WHERE NOT regexp_full_match(text, '[\\s\\x0b\\x{{1c}}-\\x{{1f}}\\x{{85}}\\x{{a0}}\\x{{2000}}-\\x{{200a}}\\x{{2028}}\\x{{2029}}\\x{{3000}}]*')""")
def pdf_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as PDF files, read back by ranges of two pages: every line with its place and size."""
    pages = pdf.read_pdf(pdfs.documents_as_pdf(spark, sf_dir), 2)
    return pdf.lines_of_spans(pages).select("doc_id", "page", "seq", "text", "font_size", F.col("bbox.x0").alias("x0"), F.round("bbox.y0", 6).alias("y0"))


@query(f"WITH {PDF_LINES} SELECT DISTINCT doc_id, page, CAST((page - 1) // 2 AS INT) AS split_no, 500.0::DOUBLE + page AS width, 800.0::DOUBLE + (page - 1) % 2 AS height FROM l")
def pdf_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages of these files, with their sizes and the range that each was read in."""
    return pdf.read_pdf(pdfs.documents_as_pdf(spark, sf_dir), 2).select(F.col("key").alias("doc_id"), "page", "split_no", "width", "height")


@query("""WITH o AS (SELECT o_custkey AS doc_id, o_orderkey AS k, '<tr><td>' || o_orderkey || '</td><td>' || CAST(o_totalprice AS VARCHAR) || '</td><td>' || CASE WHEN o_orderstatus = 'F' THEN 'True' ELSE 'False' END || '</td><td>' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '</td><td>' || lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':00:00</td><td>1 day, ' || 3 * (o_orderkey % 5) || ':00:00</td><td>' || o_orderpriority || '</td></tr>' AS line FROM orders),
 b AS (SELECT doc_id, count(*) AS n, string_agg(line, '' ORDER BY k) AS body FROM o GROUP BY doc_id)
 SELECT doc_id, 0 AS seq, 1 AS page, '<table><caption>Orders</caption><thead><tr><th>key</th><th>price</th><th>final</th><th>day</th><th>at</th><th>took</th><th>priority</th></tr></thead><tbody>' || body || '</tbody></table>' AS text FROM b
 UNION ALL SELECT doc_id, 1, 1, '<table><thead><tr><th>n</th><th>ratio</th></tr></thead><tbody><tr><td>' || n || '</td><td>#DIV/0!</td></tr></tbody></table>' FROM b UNION ALL SELECT doc_id, 2, 1, '<table><thead><tr><th></th><th>end</th></tr></thead><tbody></tbody></table>' FROM b""")
def xlsx_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as workbooks, read back: sheets in the workbook's order, dates, times, durations, truth values, errors, merged cells."""
    return files.lines_of(files.parse(offices.orders_as_workbooks(spark, sf_dir))).select("doc_id", "seq", "page", "text")


@query("""WITH p AS (SELECT p_partkey AS doc_id, p_name AS n, p_brand AS b FROM part), k AS (SELECT * FROM (VALUES (0, 'title', 'Title '), (1, 'section_header', 'heading 2 '), (2, 'section_header', 'Subtitle '), (3, 'text', 'Subtitle Small '), (4, 'caption', 'caption '), (5, 'text', 'Captioned '), (6, 'list_item', 'List Bullet '), (7, 'text', 'Normal ')) v(seq, category, head))
 SELECT doc_id, seq, category, head || n AS text FROM p, k UNION ALL SELECT doc_id, 8, 'list_item', n FROM p UNION ALL SELECT doc_id, 9, 'text', b FROM p UNION ALL SELECT doc_id, 10, 'text', n || chr(9) || 'b' || chr(10) || b FROM p
 UNION ALL SELECT doc_id, 11, 'table', '<table><tbody><tr><td>&lt;' || n || '</td><td>&lt;' || n || '</td><td>h</td></tr><tr><td>1</td><td>2</td><td>h</td></tr></tbody></table>' FROM p""")
def docx_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as word-processor documents, read back: paragraphs by their styles, tables with wide and high cells."""
    return files.lines_of(files.parse(offices.parts_as_documents(spark, sf_dir))).select("doc_id", "seq", "category", "text")


# --- chunkers and records --------------------------------------------------------------------------


@query(f"WITH {BASE} SELECT doc_id, seq, heading FROM carried")
def heading_carry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk.carry_heading(D.items_doc(spark, sf_dir)).select("doc_id", "seq", "heading")


@query(f"WITH {SECTIONS} SELECT doc_id, seq, CAST(section AS INT) AS section FROM sec")
def section_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk.sections(D.items_doc(spark, sf_dir)).select("doc_id", "seq", "section")


@query(f"WITH {BASE} SELECT doc_id, CAST(rn - 1 AS INT) AS chunk_no, {rendered('heading', 'text')} AS text, page AS i_page, page AS e_page FROM base")
def hierarchical_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk.hierarchical(D.items_doc(spark, sf_dir)).select(*PLAIN)


@query(f"WITH {smart_sql(1000, 100)} SELECT doc_id, chunk_no, text, i_page, e_page FROM chunks")
def smart_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk.smart(D.items_doc(spark, sf_dir), 1000, 100, boxes=False).select(*PLAIN)


@query(f"WITH {SECTIONS} SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY section) - 1 AS INT) AS chunk_no, {rendered('heading', 'body')} AS text, i_page, e_page FROM filled")
def smart_chunks_unsplit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk.smart(D.items_doc(spark, sf_dir), 0).select(*PLAIN)


@query(f"""WITH {smart_sql(200, 20)}, spans AS (SELECT doc_id, section, seq, text, s, s + length(text) AS e FROM (SELECT *, coalesce(sum(length(text) + 1) OVER (PARTITION BY doc_id, section ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM sec WHERE category <> 'section_header')),
 heads AS (SELECT doc_id, section, count(*) AS n, sum(length(text)) AS w FROM sec WHERE category = 'section_header' GROUP BY doc_id, section)
 SELECT c.doc_id, c.chunk_no, CAST(coalesce(max(h.n), 0) + count(p.seq) AS INT) AS n_boxes, CAST(coalesce(max(h.w), 0) + coalesce(sum(length(p.text)), 0) AS DOUBLE) AS widths FROM chunks c LEFT JOIN heads h ON h.doc_id = c.doc_id AND h.section = c.section
 LEFT JOIN spans p ON p.doc_id = c.doc_id AND p.section = c.section AND p.s < c.e AND p.e > c.s GROUP BY c.doc_id, c.chunk_no""")
def smart_chunk_bboxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk.smart(D.items_doc(spark, sf_dir), 200, 20).select("doc_id", "chunk_no", F.size("bboxes").alias("n_boxes"), F.aggregate("bboxes", F.lit(0.0), lambda a, b: a + b["bbox"]["x1"]).alias("widths"))


def hybrid_sql(size: int, overlap: int) -> str:
    return f"""WITH RECURSIVE {BASE}, walk AS (
  SELECT doc_id, rn, CAST(0 AS BIGINT) AS g, CAST(length(text) AS BIGINT) AS held, heading FROM base WHERE rn = 1
  UNION ALL SELECT b.doc_id, b.rn, CASE WHEN b.heading IS NOT DISTINCT FROM w.heading AND w.held + 1 + length(b.text) <= {size} THEN w.g ELSE w.g + 1 END,
    CASE WHEN b.heading IS NOT DISTINCT FROM w.heading AND w.held + 1 + length(b.text) <= {size} THEN w.held + 1 + length(b.text) ELSE length(b.text) END, b.heading
  FROM walk w JOIN base b ON b.doc_id = w.doc_id AND b.rn = w.rn + 1),
 merged AS (SELECT b.doc_id, w.g, max(b.heading) AS heading, string_agg(b.text, chr(10) ORDER BY b.rn) AS body, min(page) AS i_page, max(page) AS e_page FROM base b JOIN walk w ON w.doc_id = b.doc_id AND w.rn = b.rn GROUP BY b.doc_id, w.g),
 whole AS (SELECT doc_id, g, 0 AS piece, heading, body AS part, i_page, e_page FROM merged WHERE length({rendered("heading", "body")}) <= {size}),
 long AS (SELECT * FROM merged WHERE length({rendered("heading", "body")}) > {size}),
 pieces AS (SELECT doc_id, g, piece, heading, part, i_page, e_page FROM whole UNION ALL SELECT doc_id, g, piece, heading, part, i_page, e_page FROM {cut(size, overlap, "long", "doc_id, g, heading, i_page, e_page")})
 SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY g, piece) - 1 AS INT) AS chunk_no, {rendered("heading", "part")} AS text, i_page, e_page FROM pieces"""


@query(hybrid_sql(1000, 100))
def hybrid_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk.hybrid(D.items_doc(spark, sf_dir), 1000, 100).select(*PLAIN)


@query(ORACLES["hierarchical_chunks"])
def hybrid_chunks_nomerge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk.hybrid(D.items_doc(spark, sf_dir), 0).select(*PLAIN)


@query(f"WITH docs AS (SELECT doc_id, text AS body FROM documents WHERE text <> '') SELECT doc_id, CAST(piece AS INT) AS chunk_no, part AS text FROM {cut(500, 50, 'docs', 'doc_id')}")
def sliding_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk.whole_document(D.items_doc(spark, sf_dir), 500, 50).select("doc_id", "chunk_no", "text")


STATS = """CAST(length(text) AS INT) AS n_chars, CAST(len(list_filter(string_split_regex(text, '[\\t-\\r\\x1c-\\x20\\x85\\xa0]+'), lambda x: x <> '')) AS INT) AS n_words,
 CAST(len(regexp_extract_all(text, '\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x85]')) + CASE WHEN text <> '' AND NOT regexp_matches(text, '(\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x85])$') THEN 1 ELSE 0 END AS INT) AS n_lines"""
COUNTERS = """CAST(max(e_page) OVER (PARTITION BY doc_id) AS INT) AS n_page, CAST(row_number() OVER (PARTITION BY doc_id, i_page ORDER BY chunk_no) - 1 AS INT) AS i_chunk_on_page, CAST(count(*) OVER (PARTITION BY doc_id, i_page) AS INT) AS n_chunk_of_page,
 CAST(row_number() OVER (PARTITION BY doc_id ORDER BY chunk_no) - 1 AS INT) AS i_chunk_on_doc, CAST(count(*) OVER (PARTITION BY doc_id) AS INT) AS n_chunk_of_doc"""


@query(f"SELECT doc_id, {STATS} FROM documents")
def text_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    return D.read(spark, sf_dir, "documents").select("doc_id", F.length(t).alias("n_chars"), T.n_words(t).alias("n_words"), T.n_lines(t).alias("n_lines"))


@query(f"WITH {smart_sql(1000, 100)} SELECT doc_id, chunk_no, {COUNTERS} FROM chunks")
def page_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.counters(chunk.smart(D.items_doc(spark, sf_dir), 1000, 100)).select("doc_id", "chunk_no", "n_page", "i_chunk_on_page", "n_chunk_of_page", "i_chunk_on_doc", "n_chunk_of_doc")


@query(f"WITH {smart_sql(1000, 100)} SELECT doc_id, text, {STATS}, i_page, e_page, {COUNTERS}, '{REG_DATE}' AS reg_date, CAST(NULL AS VARCHAR) AS chunk_bboxes FROM chunks")
def metadata_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: sections, windows, statistics and counters of every document."""
    return pipeline.run(D.items_doc(spark, sf_dir), pipeline.Config(chunker="smart", chunk_size=1000, over_lap=100, reg_date=REG_DATE))


@query(f"WITH {smart_sql(1000, 100)} SELECT doc_id, count(*) AS num_vectors, CAST(sum(length(text)) AS BIGINT) AS total_chars FROM chunks GROUP BY doc_id")
def regression_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.totals(metadata_vectors(spark, sf_dir))


@query(f"""WITH {SECTIONS}, numbered AS (SELECT *, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY section) - 1 AS INT) AS chunk_no FROM filled)
 SELECT n.doc_id, n.chunk_no, count(*) AS n_boxes, round(sum((s.seq % 10 * 12) / 120.0), 6) AS top, round(sum(length(s.text) / 500.0), 6) AS rights FROM numbered n JOIN sec s ON s.doc_id = n.doc_id AND s.section = n.section GROUP BY n.doc_id, n.chunk_no""")
def chunk_bboxes_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = chunk.smart(D.items_doc(spark, sf_dir), 0)
    sizes = D.items_doc(spark, sf_dir).select("doc_id", "page").distinct().withColumns({"width": F.lit(500.0), "height": F.lit(120.0)})
    boxed = metadata.normalized_boxes(chunks, sizes)
    parsed = boxed.select("doc_id", "chunk_no", F.explode(F.from_json("chunk_bboxes", "array<struct<page: int, bbox: struct<l: double, t: double, r: double, b: double>>>")).alias("x"))
    return parsed.groupBy("doc_id", "chunk_no").agg(F.count("*").alias("n_boxes"), F.round(F.sum("x.bbox.t"), 6).alias("top"), F.round(F.sum("x.bbox.r"), 6).alias("rights"))


@query(f"WITH {SECTIONS}, numbered AS (SELECT *, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY section) - 1 AS INT) AS chunk_no FROM filled) SELECT DISTINCT n.doc_id, n.chunk_no, s.page FROM numbered n JOIN sec s ON s.doc_id = n.doc_id AND s.section = n.section")
def pages_touched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.pages_touched(chunk.smart(D.items_doc(spark, sf_dir), 0))


@query(f"WITH {ITEMS} SELECT doc_id, seq, page, category, text FROM items WHERE category = 'text'")
def return_level_loader(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = pipeline.Config(return_level="loader", preprocess=(lambda d: d.where("category = 'text'"),))
    return pipeline.run(D.items_doc(spark, sf_dir), config).select("doc_id", "seq", "page", "category", "text")


@query(ORACLES["smart_chunks"])
def return_level_chunker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.run(D.items_doc(spark, sf_dir), pipeline.Config(return_level="chunker")).select(*PLAIN)


@query(f"WITH {smart_sql(60, 0)} SELECT doc_id, chunk_no, trim(text, ' ' || chr(10) || chr(9) || chr(13)) AS text FROM chunks WHERE trim(text, ' ' || chr(10) || chr(9) || chr(13)) <> ''")
def postprocess_trim_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = pipeline.Config(chunk_size=60, over_lap=0, return_level="postprocess", postprocess=(pipeline.trim_and_drop,))
    return pipeline.run(D.items_doc(spark, sf_dir), config).select("doc_id", "chunk_no", "text")


@query(f"WITH {smart_sql(1000, 100)} SELECT doc_id, chunk_no AS chunk_id, text AS content, i_page AS first_page, e_page AS last_page FROM chunks")
def simple_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = pipeline.Config(metadata=metadata.simple_records)
    return pipeline.run(D.items_doc(spark, sf_dir), config).select("doc_id", "chunk_id", "content", F.get("page_range", 0).alias("first_page"), F.get("page_range", 1).alias("last_page"))


@query(f"WITH {smart_sql(1000, 100)} SELECT doc_id, CAST(doc_id AS VARCHAR) AS source, chunk_no, text, i_page, e_page, CAST(length(text) AS INT) AS n_chars, count(*) OVER (PARTITION BY doc_id) AS n_vectors FROM chunks")
def vectors_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON of each document's records, read back."""
    dumped = pipeline.dump(metadata_vectors(spark, sf_dir))
    read = F.from_json("json", "source string, vectors array<struct<text: string, i_page: int, e_page: int, n_chars: int, i_chunk_on_doc: int>>")
    rows = dumped.select("doc_id", read.alias("r")).select("doc_id", "r.source", F.size("r.vectors").cast("bigint").alias("n_vectors"), F.explode("r.vectors").alias("v"))
    return rows.select("doc_id", "source", F.col("v.i_chunk_on_doc").alias("chunk_no"), "v.text", "v.i_page", "v.e_page", "v.n_chars", "n_vectors")


@query(f"WITH {smart_sql(1000, 100)} SELECT doc_id AS source, chunk_no, text, i_page, e_page, CAST(length(text) AS INT) AS n_chars, count(*) OVER (PARTITION BY doc_id) AS n_vectors FROM chunks")
def json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of each document written as a JSON document of its own by the data source, and read back by Spark."""
    folder = f"{shared_dir(spark)}/leafmill/json-{uuid.uuid4().hex}"
    datasource.write_documents(metadata_vectors(spark, sf_dir), folder)
    schema = "source bigint, vectors array<struct<text: string, i_page: int, e_page: int, n_chars: int, i_chunk_on_doc: int>>"
    rows = datasource.read_documents(spark, folder, schema).select("source", F.size("vectors").cast("bigint").alias("n_vectors"), F.explode("vectors").alias("v"))
    return rows.select("source", F.col("v.i_chunk_on_doc").alias("chunk_no"), "v.text", "v.i_page", "v.e_page", "v.n_chars", "n_vectors")


@query(f"WITH {smart_sql(300, 30)} SELECT doc_id, chunk_no, text, i_page, e_page FROM chunks")
def merged_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Defaults, the settings of a service and those of a call, later ones first."""
    config = pipeline.Config.merged({"chunk_size": 1000, "over_lap": 100}, {"chunk_size": 300}, {"over_lap": 30, "return_level": "chunker"})
    return pipeline.run(D.items_doc(spark, sf_dir), config).select(*PLAIN)


@query("""WITH t AS (SELECT 's' || s_suppkey AS source, s_name || ' of nation ' || s_nationkey || '.' || chr(10) || 'Balance ' || CAST(s_acctbal AS VARCHAR) || '.' AS text FROM supplier)
 SELECT source, text, CAST(length(text) AS INT) AS n_chars, 2 AS n_lines, 1 AS i_page, 0 AS i_chunk_on_doc, 1 AS n_chunk_of_doc FROM t""")
def fixed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as text files in a folder, through the pipeline that takes no settings."""
    text = F.concat("s_name", F.lit(" of nation "), F.col("s_nationkey").cast("string"), F.lit(".\n\nBalance "), F.col("s_acctbal").cast("string"), F.lit("."))
    folder = f"{shared_dir(spark)}/leafmill/texts-{uuid.uuid4().hex}"
    made = offices.as_files(D.read(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), "s_suppkey", F.lit(".txt")).alias("name"), text.alias("text")), folder)
    records = pipeline.fixed_pipeline(spark, folder)
    named = made.select(F.xxhash64("path").alias("doc_id"), F.replace("name", F.lit(".txt"), F.lit("")).alias("source"))
    return records.join(named, "doc_id").select("source", "text", "n_chars", "n_lines", "i_page", "i_chunk_on_doc", "n_chunk_of_doc")


# --- cleaning --------------------------------------------------------------------------------------


@query(f"""WITH {ITEMS}, counts AS (SELECT doc_id, max(page) AS n FROM items GROUP BY doc_id), pages AS (SELECT doc_id, n, CAST(i AS INT) AS page, source FROM counts JOIN documents USING (doc_id), unnest(range(1, n + 1)) AS r(i)),
 paged AS (SELECT doc_id, page, seq + 1000 * page AS seq, text, (seq % 10) * 12 + 40.0 AS y0, (seq % 10) * 12 + 50.0 AS y1 FROM items UNION ALL SELECT doc_id, page, 1000 * page - 1, coalesce(source, ''), 0.0, 8.0 FROM pages
   UNION ALL SELECT doc_id, page, 1000 * page + 999, 'Page ' || page || ' of ' || n, 190.0, 198.0 FROM pages),
 keyed AS (SELECT *, CASE WHEN regexp_matches(trim(text, ' ' || chr(9) || chr(13)), '(?i)^[\\-\\s]*(page\\s*)?\\d+(\\s*(of|/)\\s*\\d+)?[\\-\\s]*$') THEN chr(1) || 'page' ELSE trim(text, ' ' || chr(9) || chr(13)) END AS k, min(y0) OVER (PARTITION BY doc_id, page) AS top, max(y1) OVER (PARTITION BY doc_id, page) AS bottom FROM paged),
 kinds AS (SELECT *, CASE WHEN y1 <= top + greatest(bottom - top, 1) * 0.1 THEN 'h' WHEN y0 >= bottom - greatest(bottom - top, 1) * 0.1 THEN 'f' END AS kind FROM keyed),
 once AS (SELECT doc_id, page, k, kind FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, page, k ORDER BY seq) AS n FROM kinds WHERE kind IS NOT NULL AND k <> '') WHERE n = 1),
 gone AS (SELECT DISTINCT o.doc_id, o.k FROM (SELECT doc_id, k, kind, count(*) AS c FROM once GROUP BY doc_id, k, kind) o JOIN counts p ON p.doc_id = o.doc_id WHERE p.n >= 3 AND o.c >= greatest(2, round(0.6 * p.n)))
 SELECT doc_id, seq, page, text FROM keyed WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = keyed.doc_id AND g.k = keyed.k)""")
def header_footer_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.strip_headers_footers(D.items_paged(spark, sf_dir)).select("doc_id", "seq", "page", "text")


@query(f"""WITH {ITEMS}, parts AS (SELECT doc_id, CAST(seq * 10000 + piece AS INT) AS seq, page, CAST(length(text) AS DOUBLE) AS width, CAST(piece AS DOUBLE) AS piece, trim(part, ' ' || chr(9) || chr(13)) AS text FROM {cut(60, 0, "(SELECT * FROM items WHERE text <> '')", "doc_id, seq, page, text", "text")}),
 lagged AS (SELECT *, lag(text) OVER w AS before FROM parts WINDOW w AS (PARTITION BY doc_id ORDER BY seq)),
 linked AS (SELECT *, coalesce(regexp_full_match(before, '.+[a-z,\\-]\\s*') AND regexp_full_match(text, '\\s*[a-z].+'), false) AS link FROM lagged),
 groups AS (SELECT *, sum(CASE WHEN link THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY seq) AS g FROM linked)
 SELECT doc_id, CAST(min(seq) AS INT) AS seq, min(page) AS page, string_agg(CASE WHEN link AND right(before, 1) <> '-' THEN ' ' || text ELSE text END, '' ORDER BY seq) AS text,
  max(CASE WHEN page = head THEN width END) AS x1, min(CASE WHEN page = head THEN piece END) AS y0 FROM (SELECT *, min(page) OVER (PARTITION BY doc_id, g) AS head FROM groups) GROUP BY doc_id, g""")
def paragraph_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.merge_paragraphs(D.items_wrapped(spark, sf_dir)).select("doc_id", "seq", "page", "text", F.col("bbox.x1").alias("x1"), F.col("bbox.y0").alias("y0"))


# --- layout ----------------------------------------------------------------------------------------


@query(f"""WITH {LINES}, sizes AS (SELECT doc_id, page, font_size, count(*) AS n FROM lines WHERE font_size > 0 GROUP BY doc_id, page, font_size),
 body AS (SELECT doc_id, page, font_size AS body FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, page ORDER BY n DESC, font_size) AS k FROM sizes) WHERE k = 1)
 SELECT doc_id, page, seq, body, CASE WHEN font_size >= 1.2::DOUBLE * body THEN 'section_header' ELSE 'text' END AS category FROM lines JOIN body USING (doc_id, page)""")
def rule_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.rule_layout(D.boxes_lines(spark, sf_dir), body=True).select("doc_id", "page", "seq", "category", "body")


_INTER = "greatest(least({a}.x1, {b}.r) - greatest({a}.x0, {b}.l), 0) * greatest(least({a}.y1, {b}.b) - greatest({a}.y0, {b}.t), 0)".format(a="x", b="g")


@query(f"""WITH {CROWDED_LINES}, {CROWDED_REGIONS}, best AS (SELECT x.doc_id, x.page, x.seq, g.region_no, row_number() OVER (PARTITION BY x.seq ORDER BY {_INTER} / ((x.x1 - x.x0) * (x.y1 - x.y0)) DESC, g.region_no) AS k
  FROM lines x JOIN regions g ON g.doc_id = x.doc_id AND g.page = x.page AND {_INTER} / ((x.x1 - x.x0) * (x.y1 - x.y0)) > 0.2)
 SELECT l.doc_id, l.page, l.seq, b.region_no FROM lines l LEFT JOIN (SELECT * FROM best WHERE k = 1) b ON b.seq = l.seq""")
def region_match_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.match_overlap(D.crowded_lines(spark, sf_dir), D.crowded_regions(spark, sf_dir)).select("doc_id", "page", "seq", "region_no")


@query(f"""WITH {CROWDED_LINES}, {CROWDED_REGIONS}, best AS (SELECT x.seq, g.region_no, row_number() OVER (PARTITION BY x.seq ORDER BY (g.r - g.l) * (g.b - g.t), g.region_no) AS k FROM lines x JOIN regions g ON g.doc_id = x.doc_id AND g.page = x.page
  AND (x.x0 + x.x1) / 2 BETWEEN g.l AND g.r AND (x.y0 + x.y1) / 2 BETWEEN g.t AND g.b)
 SELECT l.doc_id, l.page, l.seq, b.region_no FROM lines l LEFT JOIN (SELECT * FROM best WHERE k = 1) b ON b.seq = l.seq""")
def region_match_center(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.match_center(D.crowded_lines(spark, sf_dir), D.crowded_regions(spark, sf_dir)).select("doc_id", "page", "seq", "region_no")


_RI = "greatest(least(x.r, y.r) - greatest(x.l, y.l), 0) * greatest(least(x.b, y.b) - greatest(x.t, y.t), 0)"
_AX, _AY = "((x.r - x.l) * (x.b - x.t))", "((y.r - y.l) * (y.b - y.t))"
_GRP = "CASE WHEN category = 'picture' THEN 'p' WHEN category IN ('form', 'key_value_region', 'table', 'document_index') THEN 'w' ELSE 'r' END"


@query(f"""WITH {CROWDED_REGIONS}, grouped AS (SELECT *, {_GRP} AS grp FROM named) SELECT x.doc_id, x.page, x.region_no AS a, y.region_no AS b FROM grouped x JOIN grouped y ON x.doc_id = y.doc_id AND x.page = y.page AND x.grp = y.grp AND x.region_no < y.region_no
 AND ({_RI} / ({_AX} + {_AY} - {_RI}) > 0.8 OR {_RI} / {_AX} > 0.8 OR {_RI} / {_AY} > 0.8)""")
def region_overlap_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = D.crowded_regions(spark, sf_dir)
    return layout.overlap_edges(regions.withColumn("category", T.to_category(F.col("category"))))


_WIDE = "({a}.x0 < {b}.x1 AND {b}.x0 < {a}.x1)"


@query(f"""WITH {CROWDED_LINES} SELECT a.doc_id, a.page, a.seq AS above, b.seq AS below FROM lines a JOIN lines b ON a.doc_id = b.doc_id AND a.page = b.page AND a.seq <> b.seq AND a.y1 <= b.y0 AND {_WIDE.format(a="a", b="b")}
 WHERE NOT EXISTS (SELECT 1 FROM lines c WHERE c.doc_id = a.doc_id AND c.page = a.page AND c.seq <> a.seq AND c.seq <> b.seq AND a.y1 <= c.y0 AND c.y1 <= b.y0 AND ({_WIDE.format(a="a", b="c")} OR {_WIDE.format(a="b", b="c")}))""")
def reading_order_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order.edges(D.crowded_lines(spark, sf_dir))


@query(f"""WITH RECURSIVE {LINES}, flow AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page ORDER BY y0, x0, seq) AS r FROM lines WHERE seq % 6 <> 0),
 e AS (SELECT a.doc_id, a.page, a.r AS above, b.r AS below FROM flow a JOIN flow b ON a.doc_id = b.doc_id AND a.page = b.page AND a.seq <> b.seq AND a.y1 <= b.y0 AND {_WIDE.format(a="a", b="b")}
  WHERE NOT EXISTS (SELECT 1 FROM flow c WHERE c.doc_id = a.doc_id AND c.page = a.page AND c.seq <> a.seq AND c.seq <> b.seq AND a.y1 <= c.y0 AND c.y1 <= b.y0 AND ({_WIDE.format(a="a", b="c")} OR {_WIDE.format(a="b", b="c")}))),
 node AS (SELECT f.doc_id, f.page, f.r, (SELECT count(*) FROM e WHERE e.doc_id = f.doc_id AND e.page = f.page AND e.below = f.r) AS waits, coalesce((SELECT list(e.below ORDER BY e.below) FROM e WHERE e.doc_id = f.doc_id AND e.page = f.page AND e.above = f.r), []) AS next FROM flow f),
 pages AS (SELECT doc_id, page, list(waits ORDER BY r) AS waits, list(next ORDER BY r) AS next FROM node GROUP BY doc_id, page),
 walk AS (SELECT doc_id, page, 0 AS k, CAST(NULL AS BIGINT) AS took, list_reverse(list_filter(range(1, len(waits) + 1), lambda i: waits[i] = 0)) AS todo, waits, next FROM pages
  UNION ALL SELECT doc_id, page, k + 1, t, list_concat(todo[:-2], list_reverse(list_filter(next[t], lambda c: left_[c] = 0))), left_, next FROM (SELECT *, todo[-1] AS t, list_transform(range(1, len(waits) + 1), lambda i: waits[i] - CASE WHEN list_contains(next[todo[-1]], i) THEN 1 ELSE 0 END) AS left_ FROM walk WHERE len(todo) > 0)),
 led AS (SELECT l.doc_id, l.page, l.seq, last_value(f.r IGNORE NULLS) OVER (PARTITION BY l.doc_id, l.page ORDER BY l.seq) AS leader FROM lines l LEFT JOIN flow f ON f.seq = l.seq)
 SELECT d.doc_id, d.page, d.seq, CAST(row_number() OVER (PARTITION BY d.doc_id, d.page ORDER BY coalesce(w.k, 0), d.seq) - 1 AS INT) AS position FROM led d LEFT JOIN walk w ON w.doc_id = d.doc_id AND w.page = d.page AND w.took = d.leader""")
def reading_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = D.boxes_lines(spark, sf_dir).withColumn("category", F.when(F.col("seq") % 6 == 0, "formula").otherwise("text"))
    return order.reading_order(lines).select("doc_id", "page", "seq", "position")


@query(f"""WITH {LINES}, toks AS (SELECT *, list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '') AS w FROM lines), rows AS (SELECT doc_id, page, seq, x0, x1, CAST(i AS INT) AS k, w[i + 1] AS token FROM toks, unnest(range(len(w))) AS r(i)),
 sums AS (SELECT *, coalesce(sum(length(token) + 1) OVER (PARTITION BY seq ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(length(token) + 1) OVER (PARTITION BY seq) - 1 AS total FROM rows)
 SELECT doc_id, page, seq, CAST(row_number() OVER (PARTITION BY doc_id, page ORDER BY seq, k) - 1 AS INT) AS id, token, round(x0 + (x1 - x0) * before / total, 6) AS l, round(x0 + (x1 - x0) * (before + length(token)) / total, 6) AS r FROM sums""")
def word_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.word_tokens(D.boxes_lines(spark, sf_dir)).select("doc_id", "page", "seq", "id", "token", F.round("l", 6).alias("l"), F.round("r", 6).alias("r"))


@query(f"WITH {LINES} SELECT doc_id, page, seq, round(x0 / (150 / 72.0::DOUBLE), 6) AS x0, round(y1 / (150 / 72.0::DOUBLE), 6) AS y1 FROM lines")
def dpi_rescale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.boxes_lines(spark, sf_dir).select("doc_id", "page", "seq", F.round(layout.rescale(F.col("bbox.x0")), 6).alias("x0"), F.round(layout.rescale(F.col("bbox.y1")), 6).alias("y1"))


_H, _W = "CAST(p_partkey * 7919 % 9000 AS DOUBLE)", "CAST(p_partkey * 104729 % 9000 AS DOUBLE)"


@query(f"""WITH s AS (SELECT p_partkey AS id, {_H} AS h, {_W} AS w FROM part), r AS (SELECT *, greatest(28, round_even(h / 28, 0) * 28) AS h0, greatest(28, round_even(w / 28, 0) * 28) AS w0, sqrt(h * w / 11289600) AS sh, sqrt(3136 / (h * w)) AS gr FROM s WHERE h > 0 AND w > 0 AND greatest(h, w) / least(h, w) <= 200)
 SELECT s.id, CAST(CASE WHEN h0 * w0 > 11289600 THEN greatest(28, floor(r.h / sh / 28) * 28) WHEN h0 * w0 < 3136 THEN ceil(r.h * gr / 28) * 28 ELSE h0 END AS INT) AS height, CAST(CASE WHEN h0 * w0 > 11289600 THEN greatest(28, floor(r.w / sh / 28) * 28) WHEN h0 * w0 < 3136 THEN ceil(r.w * gr / 28) * 28 ELSE w0 END AS INT) AS width FROM s LEFT JOIN r ON r.id = s.id""")
def smart_resize(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    sized = D.read(spark, sf_dir, "part").select(k.alias("id"), layout.smart_resize((k * 7919 % 9000).cast("double"), (k * 104729 % 9000).cast("double")).alias("s"))
    return sized.select("id", F.col("s.height").alias("height"), F.col("s.width").alias("width"))


@query(f"WITH {LINES} SELECT doc_id, page, seq, '[' || CAST(round_even(x0 + 0.5, 0) AS INT) || ', ' || CAST(round_even(y0 + 0.5, 0) AS INT) || ', ' || CAST(round_even(x1, 0) AS INT) || ', ' || CAST(round_even(y1, 0) AS INT) || ']' AS box FROM lines")
def grounding_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = F.col("bbox")
    return D.boxes_lines(spark, sf_dir).select("doc_id", "page", "seq", layout.grounding_box(b["x0"] + 0.5, b["y0"] + 0.5, b["x1"], b["y1"]).alias("box"))


@query("SELECT p_partkey AS id, CAST(CASE p_partkey % 5 WHEN 4 THEN 0 ELSE 1 END AS INT) AS n_regions, CASE WHEN p_partkey % 5 <> 4 THEN 'Text' END AS label, CASE WHEN p_partkey % 5 <> 4 THEN CAST(p_partkey AS DOUBLE) END AS x0 FROM part")
def vlm_json_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers that are plain, fenced, cut short, have a bad element, or are no JSON."""
    k = F.col("p_partkey").cast("string")
    one = F.concat(F.lit('{"bbox": ['), k, F.lit(', 1, 2, 3], "category": "Text", "text": "a"}'))
    answer = F.element_at(
        F.array(F.concat(F.lit("["), one, F.lit("]")), F.concat(F.lit("Sure:\n```json\n["), one, F.lit("]\n```\nDone")), F.concat(F.lit("["), one, F.lit(', {"bbox": [1, 2')), F.concat(F.lit('[{"bbox": [1, 2], "category": "Text"}, '), one, F.lit("]")), F.lit("no regions here")),
        (F.col("p_partkey") % 5 + 1).cast("int"),
    )
    found = D.read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), layout.parse_regions(answer).alias("r"))
    return found.select("id", F.size("r").alias("n_regions"), F.get("r", 0)["category"].alias("label"), F.get(F.get("r", 0)["bbox"], 0).alias("x0"))


@query(f"WITH {LINES} SELECT doc_id, page, seq, round(x0 / 600 * 1200, 6) AS \"left\", round((1 - greatest(1 - y0 / 800, 1 - y1 / 800)) * 1600, 6) AS top, round((x1 - x0) / 600 * 1200, 6) AS width, round((y1 - y0) / 800 * 1600, 6) AS height, CAST(seq % 11 AS INT) AS colour FROM lines")
def viewer_pixel_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = F.col("bbox")
    flipped = F.struct((b["x0"] / 600).alias("l"), (1 - b["y0"] / 800).alias("t"), (b["x1"] / 600).alias("r"), (1 - b["y1"] / 800).alias("b"), F.lit("BOTTOMLEFT").alias("coord_origin"))
    rows = D.boxes_lines(spark, sf_dir).select("doc_id", "page", "seq", metadata.pixel_box(flipped, F.lit(1200), F.lit(1600)).alias("p"), (F.col("seq") % 11).cast("int").alias("colour"))
    return rows.select("doc_id", "page", "seq", *[F.round(f"p.{c}", 6).alias(c) for c in ("left", "top", "width", "height")], "colour")


@query(f"""WITH {CROWDED_LINES}, {CROWDED_REGIONS}, hit AS (SELECT x.seq, g.region_no, g.category, g.l, row_number() OVER (PARTITION BY x.seq ORDER BY (g.r - g.l) * (g.b - g.t), g.region_no) AS k FROM lines x JOIN named g ON g.doc_id = x.doc_id AND g.page = x.page AND (x.x0 + x.x1) / 2 BETWEEN g.l AND g.r AND (x.y0 + x.y1) / 2 BETWEEN g.t AND g.b),
 rows AS (SELECT l.doc_id, l.page, l.seq, l.text, l.x0, h.region_no, h.category, h.l, row_number() OVER (PARTITION BY l.doc_id, l.page, h.region_no ORDER BY l.seq) AS n FROM lines l LEFT JOIN hit h ON h.seq = l.seq AND h.k = 1)
 SELECT doc_id, page, seq, coalesce(category, 'text') AS category, CASE WHEN category = 'table' AND region_no % 2 = 0 THEN '<table>' || region_no || '</table>' ELSE text END AS text, CASE WHEN category = 'table' THEN l ELSE x0 END AS x0 FROM rows WHERE category IS DISTINCT FROM 'table' OR n = 1""")
def table_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = D.crowded_regions(spark, sf_dir).withColumn("category", T.to_category(F.col("category")))
    lines = layout.match_center(D.crowded_lines(spark, sf_dir), regions)
    html = regions.where("category = 'table' and region_no % 2 = 0").select("doc_id", "page", "region_no", F.concat(F.lit("<table>"), F.col("region_no").cast("string"), F.lit("</table>")).alias("html"))
    return layout.table_items(lines, regions, html).select("doc_id", "page", "seq", "category", "text", F.col("bbox.x0").alias("x0"))


# --- tables ----------------------------------------------------------------------------------------

GRID = """o AS (SELECT o_orderkey // 100 AS doc_id, o_orderkey // 20 % 5 AS b, * FROM orders), bs AS (SELECT DISTINCT doc_id, b FROM o),
 grid AS (SELECT doc_id, b, b * 100 AS row_no, ['block ' || b, '', ''] AS cells FROM bs UNION ALL SELECT doc_id, b, b * 100 + 1, ['key', 'priority', 'a<b & ''c'''] FROM bs UNION ALL SELECT doc_id, b, b * 100 + 2 + o_orderkey % 20, [CAST(o_orderkey AS VARCHAR), o_orderpriority, '<' || o_orderstatus || '>'] FROM o),
 blocked AS (SELECT doc_id, CAST(dense_rank() OVER (PARTITION BY doc_id ORDER BY b) AS INT) AS block, CAST(row_no AS BIGINT) AS row_no, cells FROM grid)"""


@query(f"WITH {GRID} SELECT doc_id, block, row_no, cells[1] AS first FROM blocked")
def table_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.blocks(D.grid(spark, sf_dir)).select("doc_id", "block", "row_no", F.get("cells", 0).alias("first"))


_ESC = "replace(replace(replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;')"


def _tr(tag: str) -> str:
    return "'<tr>' || list_aggregate(list_transform(cells, lambda x: '<" + tag + ">' || " + _ESC.format("x") + " || '</" + tag + ">'), 'string_agg', '') || '</tr>'"


@query(f"""WITH {GRID} SELECT doc_id, block, '<table><caption>' || max(CASE WHEN row_no % 100 = 0 THEN cells[1] END) || '</caption><thead>' || max(CASE WHEN row_no % 100 = 1 THEN {_tr("th")} END) || '</thead><tbody>' || string_agg(CASE WHEN row_no % 100 > 1 THEN {_tr("td")} END, '' ORDER BY row_no) || '</tbody></table>' AS html FROM blocked GROUP BY doc_id, block""")
def rows_to_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.grid_tables(D.grid(spark, sf_dir)).select("doc_id", "block", "html")


CELLS = """cells AS (SELECT o_orderkey // 25 AS table_id, CAST(o_orderkey // 5 % 5 AS INT) AS r, CAST(o_orderkey % 5 AS INT) AS c, CASE WHEN o_orderkey % 7 = 0 THEN 2 ELSE 1 END AS cs, o_orderkey // 5 % 5 = 0 AS head, o_orderpriority || ' x|y' AS text FROM orders),
 slots AS (SELECT table_id, CAST(a AS INT) AS r, CAST(b AS INT) AS c FROM (SELECT DISTINCT table_id FROM cells), unnest(range(5)) AS x(a), unnest(range(5)) AS y(b))"""


@query(f"""WITH {CELLS}, shown AS (SELECT s.table_id, s.r, s.c, CASE WHEN k.table_id IS NULL THEN '<td></td>' ELSE '<' || CASE WHEN k.head THEN 'th' ELSE 'td' END || CASE WHEN k.cs > 1 THEN ' colspan="2"' ELSE '' END || '>' || k.text || '</' || CASE WHEN k.head THEN 'th' ELSE 'td' END || '>' END AS x
   FROM slots s LEFT JOIN cells k ON k.table_id = s.table_id AND k.r = s.r AND k.c = s.c WHERE NOT EXISTS (SELECT 1 FROM cells o WHERE o.table_id = s.table_id AND o.r = s.r AND o.cs = 2 AND o.c + 1 = s.c)),
 lines AS (SELECT table_id, r, '<tr>' || string_agg(x, '' ORDER BY c) || '</tr>' AS line FROM shown GROUP BY table_id, r) SELECT table_id, '<table>' || string_agg(line, '' ORDER BY r) || '</table>' AS html FROM lines GROUP BY table_id""")
def structure_to_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.structure_html(D.structures(spark, sf_dir))


@query(f"""WITH {CELLS}, lines AS (SELECT s.table_id, s.r, '| ' || string_agg(replace(coalesce(k.text, ''), '|', chr(92) || '|'), ' | ' ORDER BY s.c) || ' |' AS line, coalesce(bool_or(k.head), false) AS head FROM slots s LEFT JOIN cells k ON k.table_id = s.table_id AND k.r = s.r AND k.c = s.c GROUP BY s.table_id, s.r)
 SELECT table_id, string_agg(CASE WHEN head AND r = 0 THEN line || chr(10) || '| --- | --- | --- | --- | --- |' ELSE line END, chr(10) ORDER BY r) AS markdown FROM lines GROUP BY table_id""")
def structure_to_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.structure_markdown(D.structures(spark, sf_dir))


@query("SELECT o_orderkey // 25 AS doc_id, CAST(o_orderkey // 5 % 5 AS INT) AS r, CAST(o_orderkey % 5 AS INT) AS c, CASE WHEN o_orderkey // 5 % 5 <= 1 AND o_orderkey % 5 <= 1 THEN max(CASE WHEN o_orderkey % 25 = 0 THEN o_orderpriority ELSE '' END) OVER (PARTITION BY o_orderkey // 25) ELSE o_orderpriority END AS value FROM orders")
def merged_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = D.read(spark, sf_dir, "orders")
    key = F.expr("o_orderkey div 25").alias("doc_id")
    cells = orders.select(key, F.expr("cast(o_orderkey div 5 % 5 as int)").alias("r"), F.expr("cast(o_orderkey % 5 as int)").alias("c"), F.col("o_orderpriority").alias("value"))
    merged = orders.select(key).distinct().select("doc_id", F.lit(0).alias("r0"), F.lit(0).alias("c0"), F.lit(1).alias("r1"), F.lit(1).alias("c1"))
    return tables.fill_merged(cells, merged)


# --- sources and reading order, over contents and pages made from the tables ------------------------


@query("""WITH t AS (SELECT p_partkey AS doc_id, [p_name, p_brand, p_type] AS l FROM part)
 SELECT doc_id, CAST(i AS INT) AS seq, CASE WHEN i = 0 THEN 'section_header' ELSE 'text' END AS category, l[i + 1] AS text, CASE WHEN i = 0 THEN 24.0::DOUBLE ELSE 12.0::DOUBLE END AS font_size FROM t, unnest(range(3)) AS r(i)""")
def html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = F.concat(F.lit("<!DOCTYPE html><html><h1>"), "p_name", F.lit("</h1><script>x()</script>\n<p>"), "p_brand", F.lit("</p><ul><li>"), "p_type", F.lit("</li></ul></html>"))
    rows = D.read(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"), F.lit("a.txt").alias("path"), F.encode(page, "utf-8").alias("content"))
    return layout.rule_layout(files.lines_of(files.parse(D.spread(rows, "key")))).select("doc_id", "seq", "category", "text", "font_size")


@query("""SELECT p_partkey AS doc_id, CAST(i AS INT) AS seq, ['section_header', 'list_item', 'list_item', 'table', 'code', 'text'][i + 1] AS category,
 [p_name, p_brand, p_type, '<table><thead><tr><th>size</th><th>key</th></tr></thead><tbody><tr><td>' || p_size || '</td><td>' || p_partkey || '</td></tr></tbody></table>', '# ' || p_name, p_type][i + 1] AS text FROM part, unnest(range(6)) AS r(i)""")
def md_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = F.concat(F.lit("## "), "p_name", F.lit("\n\n- "), "p_brand", F.lit("\n12. "), "p_type", F.lit("\n| size | key |\n|---|:-:|\n| "), F.col("p_size").cast("string"), F.lit(" | "), F.col("p_partkey").cast("string"), F.lit(" |\n```sql\n# "), "p_name", F.lit("\n```\n  "), "p_type")
    rows = D.read(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"), F.lit("a.md").alias("path"), F.encode(page, "utf-8").alias("content"))
    return files.lines_of(files.parse(D.spread(rows, "key"))).select("doc_id", "seq", "category", "text")


@query(f"""WITH rows AS (SELECT n_regionkey AS doc_id, n_nationkey, [n_name, CAST(n_nationkey AS VARCHAR), ''] AS cells FROM nation)
 SELECT CAST(doc_id AS BIGINT) AS doc_id, 0 AS seq, '<table><caption>' || max(r_name) || '</caption><thead><tr><th>name</th><th>key, &quot;n&quot;</th><th></th></tr></thead><tbody>' || string_agg({_tr("td")}, '' ORDER BY n_nationkey) || '</tbody></table>' AS text FROM rows JOIN region ON r_regionkey = doc_id GROUP BY doc_id
 UNION ALL SELECT CAST(r_regionkey AS BIGINT), 1, '<table><thead><tr><th>a</th><th>b</th><th>' || r_name || '</th></tr></thead><tbody></tbody></table>' FROM region""")
def csv_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ragged file with a byte-order mark, a quoted head, a blank row and a second table."""
    nation, region = D.read(spark, sf_dir, "nation"), D.read(spark, sf_dir, "region")
    body = nation.groupBy("n_regionkey").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda x: F.concat(x["n_name"], F.lit(","), x["n_nationkey"].cast("string"))), "\r\n").alias("body"))
    page = F.concat(F.lit("\ufeff"), "r_name", F.lit('\r\nname,"key, ""n"""\r\n'), "body", F.lit("\r\n\r\na,b,"), "r_name", F.lit("\r\n"))
    rows = region.join(body, F.col("r_regionkey") == F.col("n_regionkey")).select(F.col("r_regionkey").cast("bigint").alias("key"), F.lit("a.csv").alias("path"), F.encode(page, "utf-8").alias("content"))
    return files.lines_of(files.parse(rows)).select("doc_id", "seq", "text")


COLUMNED = ITEMS + """, columned AS (SELECT doc_id, page, seq, 'Line ' || seq || ' of document ' || doc_id || '.' AS text FROM items)"""


def _columned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """items_doc as lines of two columns a page, left and right by turns, numbered page by page."""
    right, row = F.col("seq") % 2 * 300.0, F.floor(F.col("seq") % 10 / 2) * 20.0 + 5
    text = F.concat(F.lit("Line "), F.col("seq").cast("string"), F.lit(" of document "), F.col("doc_id").cast("string"), F.lit("."))
    box = F.struct(right.cast("double").alias("x0"), row.cast("double").alias("y0"), (right + 200).cast("double").alias("x1"), (row + 15).cast("double").alias("y1"))
    return D.items_doc(spark, sf_dir).select("doc_id", "page", "seq", F.lit("text").alias("category"), text.alias("text"), box.alias("bbox"), F.lit(10.0).alias("font_size"))


@query(f"WITH {COLUMNED} SELECT doc_id, page, seq, CAST(row_number() OVER (PARTITION BY doc_id, page ORDER BY seq % 2, seq) - 1 AS INT) AS position FROM columned")
def reading_order_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order.reading_order(_columned(spark, sf_dir)).select("doc_id", "page", "seq", "position")


@query(f"WITH {COLUMNED} SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY page, seq % 2, seq) - 1 AS INT) AS seq, page, CAST((page - 1) // 50 AS INT) AS split_no, text, 'text' AS category FROM columned")
def load_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole load step: lines of pages of two columns become items in reading order, page after page."""
    line = F.struct("seq", "page", F.lit(None).cast("string").alias("category"), "text", "bbox", "font_size")
    parsed = _columned(spark, sf_dir).groupBy(F.col("doc_id").alias("key")).agg(F.sort_array(F.collect_list(line)).alias("lines"))
    parsed = parsed.select("key", F.lit("a.pdf").alias("path"), F.lit("pdf").alias("ext"), F.lit(None).cast("string").alias("error"), "lines", F.array().cast(files.PAGES.removeprefix("pages ")).alias("pages"))
    return pipeline.load(parsed, pipeline.Config()).select("doc_id", "seq", "page", "split_no", "text", "category")


@query("""WITH s AS (SELECT l_orderkey AS doc_id, CAST(l_partkey % 3 + 1 AS INT) AS page, CAST(l_suppkey % 4 AS INT) AS line_no, row_number() OVER (PARTITION BY l_orderkey, l_partkey % 3, l_suppkey % 4 ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag) AS seq, l_linenumber * 40 + l_quantity / 2 AS x0, l_quantity AS w, CAST(8 + l_suppkey % 3 * 2 + l_linenumber % 2 AS DOUBLE) AS size, l_returnflag || CASE WHEN l_linenumber % 3 = 0 THEN ' ' ELSE '' END AS text FROM lineitem),
 g AS (SELECT *, lag(x0 + w) OVER k AS x1b, lag(size) OVER k AS sizeb, lag(text) OVER k AS textb, sum(length(text)) OVER (PARTITION BY doc_id, page, line_no, size) AS n, min(seq) OVER (PARTITION BY doc_id, page, line_no, size) AS f FROM s WINDOW k AS (PARTITION BY doc_id, page, line_no ORDER BY seq)),
 p AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page, line_no ORDER BY n DESC, f) AS best FROM g)
 SELECT doc_id, page, line_no AS seq, string_agg(CASE WHEN x0 - x1b > (size + sizeb) / 2 * 0.25 AND right(textb, 1) <> ' ' THEN ' ' || text ELSE text END, '' ORDER BY seq) AS text, min(x0) AS x0, max(x0 + w) AS x1, max(CASE WHEN best = 1 THEN size END) AS font_size FROM p GROUP BY doc_id, page, line_no""")
def span_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans made from line items, joined to lines."""
    x0 = F.col("l_linenumber") * 40 + F.col("l_quantity") / 2
    w = Window.partitionBy("l_orderkey", F.col("l_partkey") % 3, F.col("l_suppkey") % 4).orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag")
    spans = D.read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("doc_id"), (F.col("l_partkey") % 3 + 1).cast("int").alias("page"), (F.col("l_suppkey") % 4).cast("int").alias("line_no"), F.row_number().over(w).alias("seq"),
        F.concat("l_returnflag", F.when(F.col("l_linenumber") % 3 == 0, " ").otherwise("")).alias("text"), (8 + F.col("l_suppkey") % 3 * 2 + F.col("l_linenumber") % 2).cast("double").alias("size"),
        F.struct(x0.alias("x0"), F.lit(0.0).alias("y0"), (x0 + F.col("l_quantity")).alias("x1"), F.lit(9.0).alias("y1")).alias("bbox"),
    )
    return layout.span_lines(spans).select("doc_id", "page", "seq", "text", F.col("bbox.x0").alias("x0"), F.col("bbox.x1").alias("x1"), "font_size")


@query("""WITH f AS (SELECT o_custkey AS doc_id, 1 AS page, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS seq, CASE WHEN o_orderkey % 11 = 0 THEN ' ' ELSE o_orderpriority END AS text, CAST(o_orderkey % 97 AS DOUBLE) AS x, CAST(o_orderkey // 64 % 3 AS DOUBLE) AS y, CAST(8 + o_orderkey % 5 AS DOUBLE) AS size FROM orders),
 n AS (SELECT *, CASE WHEN abs(y - lag(y) OVER (PARTITION BY doc_id ORDER BY seq)) > 1 THEN 1 ELSE 0 END AS new FROM f WHERE trim(text) <> ''), l AS (SELECT *, CAST(sum(new) OVER (PARTITION BY doc_id ORDER BY seq) AS INT) AS line FROM n)
 SELECT doc_id, page, line AS seq, string_agg(text, '' ORDER BY seq) AS text, min_by(x, seq) AS x0, max_by(y, seq) AS y0, min_by(x, seq) + max_by(size, seq) / 2 * length(string_agg(text, '' ORDER BY seq)) AS x1, max_by(size, seq) AS font_size FROM l GROUP BY doc_id, page, line""")
def fragment_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text fragments made from orders, joined to lines where y steps."""
    k = F.col("o_orderkey")
    fragments = D.read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc_id"), F.lit(1).alias("page"), F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")).alias("seq"), F.when(k % 11 == 0, " ").otherwise(F.col("o_orderpriority")).alias("text"), (k % 97).cast("double").alias("x"), F.expr("cast(o_orderkey div 64 % 3 as double)").alias("y"), (8 + k % 5).cast("double").alias("font_size"))
    return layout.fragment_lines(fragments).select("doc_id", "page", "seq", "text", F.col("bbox.x0").alias("x0"), F.col("bbox.y0").alias("y0"), F.col("bbox.x1").alias("x1"), "font_size")


@query("SELECT p_partkey AS doc_id, 1 AS page, CAST(p_partkey AS DOUBLE) AS width, CAST(p_size AS DOUBLE) AS height FROM part")
def image_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PNG files as pages without lines, their sizes read from their headers in the plan."""
    number = lambda c: F.lpad(F.hex(c), 8, "0")
    content = F.unhex(F.concat(F.lit(stubs.PNG[:32]), number("p_partkey"), number(F.col("p_size").cast("bigint"))))
    parsed = files.parse(D.read(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"), F.lit("scan").alias("path"), content.alias("content")))
    return files.pages_of(parsed).select("doc_id", "page", models.png_size(F.col("image")).alias("s")).select("doc_id", "page", "s.width", "s.height")


@query(f"WITH {LINES} SELECT doc_id, page, CAST(row_number() OVER (PARTITION BY doc_id, page ORDER BY seq) - 1 AS INT) AS id, text, x0 FROM lines WHERE doc_id % 2 = 0")
def page_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a parser found on pages; pages without them have none."""
    word = F.struct("seq", F.struct("text", "bbox").alias("w"))
    pages = D.boxes_lines(spark, sf_dir).groupBy("doc_id", "page").agg(F.transform(F.sort_array(F.collect_list(word)), lambda x: x["w"]).alias("words"))
    return files.words_of(pages.withColumn("words", F.when(F.col("doc_id") % 2 == 0, F.col("words")))).select("doc_id", "page", "id", "text", F.col("bbox.x0").alias("x0"))


@query(f"""WITH {SECTIONS}, numbered AS (SELECT *, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY section) - 1 AS INT) AS chunk_no FROM filled)
 SELECT n.doc_id, n.chunk_no, count(*) AS n_boxes, round(sum(length(s.text) / (500.0 + s.page)), 6) AS rights FROM numbered n JOIN sec s ON s.doc_id = n.doc_id AND s.section = n.section WHERE n.doc_id % 3 = 0 GROUP BY n.doc_id, n.chunk_no""")
def pdf_page_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes of records as shares of their page: only files named .pdf have page sizes."""
    items = D.items_doc(spark, sf_dir)
    pages = items.select("doc_id", "page").distinct().select("doc_id", F.when(F.col("doc_id") % 3 == 0, "a/B.PDF").otherwise("a.html").alias("path"), "page", (500.0 + F.col("page")).alias("width"), F.lit(120.0).alias("height"))
    records = pipeline.run(items, pipeline.Config(chunk_size=0, reg_date=REG_DATE), files.page_sizes(pages))
    parsed = records.select("doc_id", F.col("i_chunk_on_doc").alias("chunk_no"), F.explode(F.from_json("chunk_bboxes", "array<struct<bbox: struct<r: double>>>")).alias("x"))
    return parsed.groupBy("doc_id", "chunk_no").agg(F.count("*").alias("n_boxes"), F.round(F.sum("x.bbox.r"), 6).alias("rights"))


@query("SELECT doc_id, base64(encode(text)) AS encoded FROM documents")
def base64_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.read(spark, sf_dir, "documents").select("doc_id", models.base64_of(F.encode("text", "utf-8")).alias("encoded"))


@query("SELECT p_partkey AS id, 1.0::DOUBLE AS same, 0.0::DOUBLE AS other, 2.0::DOUBLE * length(p_brand) / (2 * length(p_brand) + 3) AS longer FROM part")
def similarity_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ratio of a text with itself, with one that shares no character, and with itself and three more."""
    text = F.col("p_brand")
    return D.read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), T.similarity(text, text).alias("same"), T.similarity(text, F.lit("~~~")).alias("other"), T.similarity(text, F.concat(text, F.lit("~~~"))).alias("longer"))


# --- layout by models, with stand-ins for the services ------------------------------------------------

_NAMED = "CASE label WHEN 'Strange label' THEN 'text' ELSE replace(lower(label), '-', '_') END"
_LABEL = "(['" + "','".join(stubs.LABELS) + "'])[CAST((p.doc_id + p.page + k) % 7 + 1 AS INT)]"
PAGES = LINES + f""", pages AS (SELECT DISTINCT doc_id, page FROM lines),
 found AS (SELECT p.doc_id, p.page, CAST(k AS INT) AS region_no, {_LABEL} AS label, ((p.doc_id * 7 + p.page * 13 + k * 29) % 100) / 100.0::DOUBLE AS confidence, 120.0::DOUBLE * k AS l, 120.0::DOUBLE * k + 110 AS r FROM pages p, unnest(range(4)) AS u(k) WHERE p.page < 5),
 kept AS (SELECT doc_id, page, region_no, CASE WHEN category = 'title' THEN 'section_header' ELSE category END AS category, l, r FROM (SELECT *, {_NAMED} AS category FROM found) WHERE confidence >= CASE WHEN category IN ('title', 'code') THEN 0.45 ELSE 0.5 END),
 over AS (SELECT x.seq, g.region_no, g.category, g.l, row_number() OVER (PARTITION BY x.seq ORDER BY greatest(least(x.x1, g.r) - greatest(x.x0, g.l), 0) * greatest(least(x.y1, 700) - x.y0, 0) / ((x.x1 - x.x0) * (x.y1 - x.y0)) DESC, g.region_no) AS k FROM lines x JOIN kept g ON g.doc_id = x.doc_id AND g.page = x.page
   AND greatest(least(x.x1, g.r) - greatest(x.x0, g.l), 0) * greatest(least(x.y1, 700) - x.y0, 0) / ((x.x1 - x.x0) * (x.y1 - x.y0)) > 0.2)"""
SX, SY = f"({stubs.SEEN[0]} / {stubs.WIDTH}.0::DOUBLE * 150 / 72)", f"({stubs.SEEN[1]} / {stubs.HEIGHT}.0::DOUBLE * 150 / 72)"
SEEN = LINES + f""", pages AS (SELECT DISTINCT doc_id, page FROM lines),
 found AS (SELECT p.doc_id, p.page, CAST(k AS INT) AS region_no, {_LABEL} AS label, 250 * k / {SX} AS l, (250 * k + 230) / {SX} AS r, 1500 / {SY} AS b, CASE WHEN k = 2 THEN '' ELSE 'text ' || k END AS text FROM pages p, unnest(range(4)) AS u(k) WHERE p.page < 5),
 kept AS (SELECT *, {_NAMED} AS category FROM found),
 held AS (SELECT x.seq, g.region_no, g.category, row_number() OVER (PARTITION BY x.seq ORDER BY (g.r - g.l) * g.b, g.region_no) AS k FROM lines x JOIN kept g ON g.doc_id = x.doc_id AND g.page = x.page AND (x.x0 + x.x1) / 2 BETWEEN g.l AND g.r AND (x.y0 + x.y1) / 2 BETWEEN 0 AND g.b)"""


def _damaged(lines: DataFrame) -> DataFrame:
    return lines.withColumn("text", F.when(F.col("seq") % 4 == 0, F.concat("text", F.lit("\ufffd"))).otherwise(F.col("text")))


def _laid_out(name: str, spark: SparkSession, sf_dir: str, clients: models.Clients = stubs.CLIENTS) -> DataFrame:
    lines, pages = _damaged(D.boxes_lines(spark, sf_dir)), stubs.pages(spark, sf_dir)
    return models.strategy(name, clients).apply(lines, pages, None, clients).select("doc_id", "page", "seq", "category", "text")


_DAMAGED = "CASE WHEN x.seq % 4 = 0 THEN x.text || chr(65533) ELSE x.text END"


@query(f"WITH {PAGES} SELECT x.doc_id, x.page, x.seq, coalesce(o.category, 'text') AS category, {_DAMAGED} AS text FROM lines x LEFT JOIN over o ON o.seq = x.seq AND o.k = 1")
def layout_detector(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _laid_out("detector", spark, sf_dir)


@query(f"""WITH {PAGES}, tokens AS (SELECT doc_id, page, CAST(sum(len(string_split(text, ' '))) AS INT) AS n FROM lines GROUP BY doc_id, page), rows AS (SELECT x.*, o.region_no, o.category, o.l, row_number() OVER (PARTITION BY x.doc_id, x.page, o.region_no ORDER BY x.seq) AS first FROM lines x LEFT JOIN over o ON o.seq = x.seq AND o.k = 1)
 SELECT x.doc_id, x.page, x.seq, coalesce(x.category, 'text') AS category, CASE WHEN x.category = 'table' THEN '<table><tr><th>' || n || ' tokens</th><td colspan="2">a|b</td></tr></table>' ELSE {_DAMAGED} END AS text FROM rows x JOIN tokens USING (doc_id, page) WHERE x.category IS DISTINCT FROM 'table' OR first = 1""")
def layout_table_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _laid_out("detector", spark, sf_dir, stubs.WITH_TABLES)


@query(f"WITH {SEEN} SELECT x.doc_id, x.page, x.seq, coalesce(h.category, 'text') AS category, {_DAMAGED} AS text FROM lines x LEFT JOIN held h ON h.seq = x.seq AND h.k = 1")
def layout_vlm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _laid_out("vlm", spark, sf_dir)


@query(f"WITH {SEEN} SELECT doc_id, page, region_no AS seq, category, text FROM kept WHERE text <> ''")
def layout_vlm_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _laid_out("vlm_all", spark, sf_dir)


_READ = "'box [' || 250 * {0} || ', 0, ' || (250 * {0} + 230) || ', 1500]'"


@query(f"WITH {SEEN} SELECT doc_id, page, region_no AS seq, category, {_READ.format('region_no')} AS text FROM kept WHERE category <> 'picture' AND region_no > 0")
def layout_vlm_grounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _laid_out("vlm_grounding", spark, sf_dir)


@query(f"WITH {SEEN} SELECT x.doc_id, x.page, x.seq, coalesce(h.category, 'text') AS category, CASE WHEN x.seq % 4 = 0 AND h.region_no > 0 THEN {_READ.format('h.region_no')} ELSE {_DAMAGED} END AS text FROM lines x LEFT JOIN held h ON h.seq = x.seq AND h.k = 1")
def layout_vlm_auto(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _laid_out("vlm_auto", spark, sf_dir)


@query(f"WITH {SEEN} SELECT doc_id, page, region_no, round(l, 6) AS l, round(r, 6) AS r, round(b, 6) AS b, CAST(250 * region_no AS DOUBLE) AS rl, CAST(1500 AS DOUBLE) AS rb, '{models.GROUNDING_PROMPT}[' || 250 * region_no || ', 0, ' || (250 * region_no + 230) || ', 1500]' AS prompt FROM kept")
def vlm_region_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both boxes of each region, and the prompt that asks for its text."""
    found = models.vlm_regions(stubs.pages(spark, sf_dir), stubs.vlm)
    prompt = F.concat(F.lit(models.GROUNDING_PROMPT), layout.grounding_box(*[F.col(c) for c in ("rl", "rt", "rr", "rb")]))
    return found.select("doc_id", "page", "region_no", *[F.round(c, 6).alias(c) for c in "lrb"], "rl", "rb", prompt.alias("prompt"))


@query(f"""WITH {LINES}, pages AS (SELECT DISTINCT doc_id, page FROM lines), gate AS (SELECT doc_id, page FROM pages WHERE page < 5 AND (doc_id + page) % 2 = 0)
 SELECT x.doc_id, x.page, x.seq, x.text, x.x0 FROM lines x ANTI JOIN gate g ON g.doc_id = x.doc_id AND g.page = x.page UNION ALL SELECT doc_id, page, CAST(k AS INT), 'read ' || doc_id || ' ' || k, 10.0::DOUBLE * k * 72 / 150 FROM gate, unnest(range(page)) AS u(k)""")
def ocr_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with damaged glyphs and an image are read by OCR, the others keep their lines."""
    lines = D.boxes_lines(spark, sf_dir)
    lines = lines.withColumn("text", F.when((F.col("doc_id") + F.col("page")) % 2 == 0, F.concat("text", F.lit("GLYPH<1f>"))).otherwise(F.col("text")))
    read, _ = pipeline.read_again(lines, stubs.pages(spark, sf_dir), pipeline.Config(clients=stubs.CLIENTS))
    return read.select("doc_id", "page", "seq", F.replace("text", F.lit("GLYPH<1f>"), F.lit("")).alias("text"), F.col("bbox.x0").alias("x0"))


@query("SELECT * FROM (VALUES ('rule', false, false, false), ('detector', true, true, false), ('detector with tables', true, true, true), ('vlm', true, false, false), ('vlm_all', true, false, true), ('vlm_grounding', true, false, true), ('vlm_auto', true, false, true), ('no such layout', false, false, false)) t(layout, needs_image, needs_words, produces_items)")
def layout_strategies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each layout needs and gives; an unknown name is the rule layout."""
    chosen = [(n, models.strategy(n)) for n in (*models.STRATEGIES, "no such layout")] + [("detector with tables", models.strategy("detector", stubs.WITH_TABLES))]
    return spark.createDataFrame([(n, s.needs_image, s.needs_words, s.produces_items) for n, s in chosen], "layout string, needs_image boolean, needs_words boolean, produces_items boolean")


_AREA = "({0}.r - {0}.l) * ({0}.b - {0}.t)"
_BOTH = "greatest(least({0}.r, {1}.r) - greatest({0}.l, {1}.l), 0) * greatest(least({0}.b, {1}.b) - greatest({0}.t, {1}.t), 0)"


@query(f"""WITH RECURSIVE {CROWDED_REGIONS}, x AS (SELECT doc_id, page, region_no, CASE WHEN category = 'title' THEN 'section_header' ELSE category END AS category, confidence, l, t, r, b, (r - l) * (b - t) AS area FROM named WHERE confidence >= CASE WHEN category IN ('title', 'code') THEN 0.45 ELSE 0.5 END),
 g AS (SELECT *, {_GRP} AS grp, CASE WHEN category = 'picture' OR category = 'table' THEN 2.0 ELSE 1.3 END AS most, CASE WHEN category = 'picture' THEN 0.3 WHEN category = 'table' THEN 0.2 ELSE 0.05 END AS loss FROM x),
 e AS (SELECT p.region_no AS a, q.region_no AS b FROM g p JOIN g q ON p.doc_id = q.doc_id AND p.page = q.page AND p.grp = q.grp AND p.region_no <> q.region_no AND ({_BOTH.format("p", "q")} / (p.area + q.area - {_BOTH.format("p", "q")}) > 0.8 OR {_BOTH.format("p", "q")} / p.area > 0.8 OR {_BOTH.format("p", "q")} / q.area > 0.8)),
 reach(a, b) AS (SELECT region_no, region_no FROM g UNION SELECT reach.a, e.b FROM reach JOIN e ON e.a = reach.b), cluster AS (SELECT a AS region_no, min(b) AS c FROM reach GROUP BY a), m AS (SELECT g.*, c FROM g JOIN cluster USING (region_no)),
 cand AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY region_no) AS n FROM m p WHERE NOT EXISTS (SELECT 1 FROM m q WHERE q.c = p.c AND q.region_no <> p.region_no AND NOT (p.category = 'list_item' AND q.category = 'text' AND abs(1 - p.area / q.area) < 0.2) AND NOT (p.category = 'code' AND {_BOTH.format("p", "q")} / q.area > 0.8) AND p.area / q.area <= p.most AND q.confidence - p.confidence > p.loss)),
 walk AS (SELECT c, n, region_no, area, confidence FROM cand WHERE n = 1 UNION ALL SELECT w.c, k.n, CASE WHEN k.area > w.area AND w.confidence - k.confidence <= k.loss THEN k.region_no ELSE w.region_no END, CASE WHEN k.area > w.area AND w.confidence - k.confidence <= k.loss THEN k.area ELSE w.area END, CASE WHEN k.area > w.area AND w.confidence - k.confidence <= k.loss THEN k.confidence ELSE w.confidence END FROM walk w JOIN cand k ON k.c = w.c AND k.n = w.n + 1),
 best AS (SELECT c, max_by(region_no, n) AS region_no FROM walk GROUP BY c) SELECT m.doc_id, m.page, m.region_no, m.category, m.confidence, m.l, m.t, m.r, m.b FROM m JOIN (SELECT c, coalesce(b.region_no, c) AS region_no FROM (SELECT DISTINCT c FROM m) LEFT JOIN best b USING (c)) k USING (region_no)""")
def region_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlap removal, with the SQL walking each cluster as a recursion."""
    return layout.remove_overlaps(layout.filter_regions(D.crowded_regions(spark, sf_dir)))


# --- hooks, registries and the records' date -----------------------------------------------------------


@query(f"WITH {SECTIONS} SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY section) - 1 AS INT) AS chunk_no, lower({rendered('heading', 'body')}) || ' #' || (row_number() OVER (PARTITION BY doc_id ORDER BY section) - 1) AS text FROM filled")
def enrich_hooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A hook that changes items before chunking and one that changes chunks after it."""
    config = pipeline.Config(chunk_size=0, return_level="postprocess", pre_enrich=(lambda d: d.withColumn("text", F.lower("text")),), post_enrich=(lambda d: d.withColumn("text", F.concat("text", F.lit(" #"), F.col("chunk_no").cast("string"))),))
    return pipeline.run(D.items_doc(spark, sf_dir), config).select("doc_id", "chunk_no", "text")


@query(f"WITH {ITEMS} SELECT doc_id, page - 1 AS chunk_no, string_agg(text, ' / ' ORDER BY seq) AS text, page AS i_page FROM items GROUP BY doc_id, page")
def custom_chunker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chunker of the caller's own: one chunk a page."""

    def by_page(items: DataFrame, size: int, overlap: int) -> DataFrame:
        text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seq", "text"))), lambda x: x["text"]), " / ")
        return items.groupBy("doc_id", "page").agg(text.alias("text")).select("doc_id", (F.col("page") - 1).alias("chunk_no"), "text", F.col("page").alias("i_page"))

    config = pipeline.Config(chunker="pages", chunkers={"pages": by_page}, return_level="chunker")
    return pipeline.run(D.items_doc(spark, sf_dir), config)


@query("SELECT p_partkey AS doc_id, CAST(i AS INT) AS seq, 'code' AS category, [p_name, p_brand][i + 1] AS text FROM part, unnest(range(2)) AS r(i)")
def custom_parser(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A parser that is registered for a type of its own."""
    files.register_parser("pairs", lambda content: ((1, "code", x, files.NOWHERE, None) for x in content.decode().split("=")))
    rows = D.read(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"), F.lit("a").alias("path"), F.encode(F.concat("p_name", F.lit("="), "p_brand"), "utf-8").alias("content"))
    return files.lines_of(files.parse(rows, "pairs")).select("doc_id", "seq", "category", "text")


@query("SELECT p_partkey AS doc_id, CAST(i AS INT) AS seq, ['title', 'list_item', 'table'][i + 1] AS category, [p_name, p_brand, p_type][i + 1] AS text FROM part, unnest(range(3)) AS r(i)")
def load_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose format gives their category pass through the load step as they are."""
    kinds = zip(("title", "list_item", "table"), ("p_name", "p_brand", "p_type"), strict=True)
    box = F.struct(*[F.lit(0.0).alias(k) for k in ("x0", "y0", "x1", "y1")])
    lines = F.array(*[F.struct(F.lit(i).alias("seq"), F.lit(1).alias("page"), F.lit(k).alias("category"), F.col(c).alias("text"), box.alias("bbox"), F.lit(None).cast("double").alias("font_size")) for i, (k, c) in enumerate(kinds)])
    parsed = D.read(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"), F.lit("a.docx").alias("path"), F.lit("docx").alias("ext"), F.lit(None).cast("string").alias("error"), lines.alias("lines"), F.array().cast(files.PAGES.removeprefix("pages ")).alias("pages"))
    return pipeline.load(parsed, pipeline.Config()).select("doc_id", "seq", "category", "text")


@query("SELECT r_regionkey AS id, true AS shaped, true AS recent FROM region")
def record_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The date of records made now: ISO seconds with a Z, and not a day old."""
    now = metadata.utc_now()
    rows = D.read(spark, sf_dir, "region").select(F.col("r_regionkey").alias("id"), now.alias("t"))
    return rows.select("id", F.col("t").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ$").alias("shaped"), (F.abs(F.unix_timestamp(F.to_timestamp("t", "yyyy-MM-dd'T'HH:mm:ssX")) - F.unix_timestamp()) < 86400).alias("recent"))
