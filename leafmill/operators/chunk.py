"""Chunkers over items (doc_id, seq, page, category, text, bbox): one shuffle by doc_id each.

Items come in the order of seq. Chunks are (doc_id, chunk_no, text, i_page, e_page, bboxes).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.functions.text import render, window_starts
from leafmill.schemas import BBOX, HEADER

ENTRY = f"struct<page: int, bbox: {BBOX}, category: string>"
def _doc():
    return Window.partitionBy("doc_id")


def is_header():
    return F.coalesce(F.col("category") == HEADER, F.lit(False))


def carry_heading(items: DataFrame) -> DataFrame:
    """`heading`: text of the last section header so far; an empty one counts."""
    w = _doc().orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return items.withColumn("heading", F.last(F.when(is_header(), F.coalesce("text", F.lit(""))), ignorenulls=True).over(w))


def sections(items: DataFrame) -> DataFrame:
    """`section`: number of the section, which each header begins; 0 is what comes before the first."""
    w = _doc().orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return items.withColumn("section", F.sum(is_header().cast("int")).over(w).cast("int"))


def _numbered(rows: DataFrame, *order: str) -> DataFrame:
    return rows.withColumn("chunk_no", F.row_number().over(_doc().orderBy(*order)) - 1)


def _base(items: DataFrame) -> DataFrame:
    return carry_heading(items).where(~is_header() & (F.coalesce("text", F.lit("")) != ""))


def hierarchical(items: DataFrame) -> DataFrame:
    """A chunk for each body item with text, under the last heading."""
    rows = _base(items).select("doc_id", "seq", render(F.col("heading"), F.col("text")).alias("text"), F.col("page").alias("i_page"), F.col("page").alias("e_page"), F.lit(None).cast(f"array<{ENTRY}>").alias("bboxes"))
    return _numbered(rows, "seq").select("doc_id", "chunk_no", "text", "i_page", "e_page", "bboxes")


def smart(items: DataFrame, size: int = 0, overlap: int = 100, boxes: bool = True) -> DataFrame:
    """A chunk for each section; bodies longer than `size` are cut in windows, each under the heading, with the boxes it touches.

    Without `boxes`, where nobody reads them, only texts and pages are collected and bboxes is null.
    """
    if not boxes:
        return _sections_as_text(items, size, overlap)
    placed = sections(items).withColumn("text", F.coalesce("text", F.lit("")))
    before = Window.partitionBy("doc_id", "section").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.when(~is_header(), F.length("text") + 1).otherwise(0)).over(before), F.lit(0)).cast("int")
    entry = F.struct("page", "bbox", "category")
    body = F.struct("seq", start.alias("s"), (start + F.length("text")).alias("e"), "text", entry.alias("entry"))
    grouped = (
        placed.withColumn("body", F.when(~is_header(), body))
        .groupBy("doc_id", "section")
        .agg(
            F.max(F.when(is_header(), F.col("text"))).alias("heading"),
            F.collect_list(F.when(is_header(), entry)).alias("heads"),
            F.sort_array(F.collect_list("body")).alias("parts"),
            F.min("page").alias("i_page"),
            F.max("page").alias("e_page"),
        )
        .withColumn("body", F.array_join(F.transform("parts", lambda x: x["text"]), "\n"))
        .where(render(F.col("heading"), F.col("body")) != "")
    )
    if not size:
        whole = grouped.withColumn("bboxes", F.concat("heads", F.transform("parts", lambda x: x["entry"])))
        rows = whole.select("doc_id", "section", F.lit(0).alias("piece"), render(F.col("heading"), F.col("body")).alias("text"), "i_page", "e_page", "bboxes")
    else:
        starts = F.when(F.col("body") == "", F.array(F.lit(0))).otherwise(window_starts(F.col("n"), size, overlap))
        # Windows are cut and given their boxes before they are exploded, so no window carries the whole section; its length is counted once, not for each part of each window.
        spans = F.transform("parts", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["entry"].alias("entry")))
        touched = lambda s: F.transform(F.filter("spans", lambda x: (x["s"] < F.least(s + size, "n")) & (x["e"] > s)), lambda x: x["entry"])
        pieces = F.transform(starts, lambda s: F.struct(F.substring(F.col("body"), s + 1, F.lit(size)).alias("part"), touched(s).alias("boxes")))
        cut = grouped.withColumns({"n": F.length("body"), "spans": spans}).select("doc_id", "section", "heading", "heads", "i_page", "e_page", F.posexplode(pieces).alias("piece", "w"))
        rows = cut.select("doc_id", "section", "piece", render(F.col("heading"), F.col("w.part")).alias("text"), "i_page", "e_page", F.concat("heads", "w.boxes").alias("bboxes"))
    return _numbered(rows, "section", "piece").select("doc_id", "chunk_no", "text", "i_page", "e_page", "bboxes")


def _sections_as_text(items: DataFrame, size: int, overlap: int) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    grouped = sections(items).groupBy("doc_id", "section").agg(
        F.max(F.when(is_header(), text)).alias("heading"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.when(~is_header(), F.struct("seq", text.alias("text"))))), lambda x: x["text"]), "\n").alias("body"),
        F.min("page").alias("i_page"),
        F.max("page").alias("e_page"),
    )
    filled = grouped.where(render(F.col("heading"), F.col("body")) != "")
    if not size:
        rows = filled.select("doc_id", "section", F.lit(0).alias("piece"), render(F.col("heading"), F.col("body")).alias("text"), "i_page", "e_page")
    else:
        starts = F.when(F.col("body") == "", F.array(F.lit(0))).otherwise(window_starts(F.length("body"), size, overlap))
        pieces = F.transform(starts, lambda s: F.substring(F.col("body"), s + 1, F.lit(size)))
        rows = filled.select("doc_id", "section", "heading", "i_page", "e_page", F.posexplode(pieces).alias("piece", "part"))
        rows = rows.select("doc_id", "section", "piece", render(F.col("heading"), F.col("part")).alias("text"), "i_page", "e_page")
    return _numbered(rows, "section", "piece").select("doc_id", "chunk_no", "text", "i_page", "e_page", F.lit(None).cast(f"array<{ENTRY}>").alias("bboxes"))


#: Items that group_starts() looks at before it sets their starts aside.
STRIDE = 256


def group_starts(lengths: Column, size: int) -> Column:
    """Places in an array of lengths where a new group begins, if each takes items while they fit in `size`, joined by one character.

    A fold in two levels: a stride's starts are an array of their own, so adding one never copies more than a stride.
    """
    none = F.array().cast("array<int>")

    def take(a: Column, n: Column) -> Column:
        fits = (a["held"] >= 0) & (a["held"] + 1 + n <= size)
        return F.struct(F.when(fits, a["held"] + 1 + n).otherwise(n).alias("held"), (a["at"] + 1).alias("at"), F.when(fits, a["starts"]).otherwise(F.array_append(a["starts"], a["at"])).alias("starts"))

    def stride(a: Column, k: Column) -> Column:
        one = F.aggregate(F.slice(lengths, k * STRIDE + 1, F.lit(STRIDE)), F.struct(a["held"].alias("held"), (k * STRIDE).alias("at"), none.alias("starts")), take)
        # An array of one binds what is read twice.
        return F.element_at(F.transform(F.array(one), lambda x: F.struct(x["held"].alias("held"), F.array_append(a["starts"], x["starts"]).alias("starts"))), 1)

    strides = F.sequence(F.lit(0), F.floor((F.greatest(F.size(lengths), F.lit(1)) - 1) / STRIDE).cast("int"))
    return F.aggregate(strides, F.struct(F.lit(-1).cast("bigint").alias("held"), F.array().cast("array<array<int>>").alias("starts")), stride, lambda a: F.flatten(a["starts"]))


def hybrid(items: DataFrame, size: int = 0, overlap: int = 100) -> DataFrame:
    """Body items under equal headings merged in order while they fit in `size`, longer ones cut in windows.

    Merging never goes on past a change of the heading, so the runs between changes are folded alone; all of it is one shuffle by doc_id.
    """
    if not size:
        return hierarchical(items)
    if not 0 <= overlap < size:
        raise ValueError("a window needs 0 <= overlap < size")
    w = _doc().orderBy("seq")
    same = F.lag("seq").over(w).isNotNull() & F.col("heading").eqNullSafe(F.lag("heading").over(w))
    base = _base(items).select("doc_id", "seq", "heading", "text", "page", (~same).cast("int").alias("new"))
    runs = base.withColumn("run", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    grouped = runs.groupBy("doc_id", "run").agg(F.max("heading").alias("heading"), F.sort_array(F.collect_list(F.struct("seq", "text", "page"))).alias("rows"))
    folded = grouped.withColumn("lengths", F.transform("rows", lambda r: F.length(r["text"]).cast("bigint"))).withColumn("starts", group_starts(F.col("lengths"), size))

    def part(start: Column, k: Column) -> Column:
        end = F.coalesce(F.get("starts", k + 1), F.size("rows"))
        body = F.slice("rows", start + 1, end - start)
        bound = F.transform(F.array(body), lambda x: F.struct(F.array_join(F.transform(x, lambda r: r["text"]), "\n").alias("body"), F.array_min(F.transform(x, lambda r: r["page"])).alias("i_page"), F.array_max(F.transform(x, lambda r: r["page"])).alias("e_page")))
        return F.element_at(bound, 1)

    merged = folded.select("doc_id", "run", "heading", F.posexplode(F.transform("starts", part)).alias("g", "x")).select("doc_id", "run", "heading", "g", "x.*")
    fits = F.length(render(F.col("heading"), F.col("body"))) <= size
    starts = F.when(fits, F.array(F.lit(0))).otherwise(window_starts(F.length("body"), size, overlap))
    pieces = F.transform(starts, lambda s: F.when(fits, F.col("body")).otherwise(F.substring(F.col("body"), s + 1, F.lit(size))))
    rows = merged.select("doc_id", "run", "heading", "g", "i_page", "e_page", F.posexplode(pieces).alias("piece", "part"))
    rows = rows.select("doc_id", "run", "g", "piece", render(F.col("heading"), F.col("part")).alias("text"), "i_page", "e_page", F.lit(None).cast(f"array<{ENTRY}>").alias("bboxes"))
    return _numbered(rows, "run", "g", "piece").select("doc_id", "chunk_no", "text", "i_page", "e_page", "bboxes")


def whole_document(items: DataFrame, size: int, overlap: int) -> DataFrame:
    """Windows over a document's items joined by line ends."""
    docs = items.groupBy("doc_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seq", F.coalesce("text", F.lit("")).alias("t")))), lambda r: r["t"]), "\n").alias("body"), F.min("page").alias("i_page"), F.max("page").alias("e_page"))
    pieces = F.transform(window_starts(F.length("body"), size, overlap), lambda s: F.substring(F.col("body"), s + 1, F.lit(size)))
    return docs.select("doc_id", F.posexplode(pieces).alias("chunk_no", "text"), "i_page", "e_page").select("doc_id", "chunk_no", "text", "i_page", "e_page", F.lit(None).cast(f"array<{ENTRY}>").alias("bboxes"))


CHUNKERS = {"hierarchical": lambda items, size, overlap: hierarchical(items), "smart": smart, "hybrid": hybrid, "document": whole_document}
