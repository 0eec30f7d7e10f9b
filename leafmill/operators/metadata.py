"""Records for chunks: statistics, counters and normalised boxes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.functions.text import n_lines, n_words

def _doc():
    return Window.partitionBy("doc_id")


def utc_now() -> Column:
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def counters(chunks: DataFrame) -> DataFrame:
    """Place of each chunk in its first page and its document; all windows share one shuffle by doc_id."""
    page = Window.partitionBy("doc_id", "i_page")
    return chunks.withColumns({
        "n_page": F.max("e_page").over(_doc()),
        "i_chunk_on_page": F.row_number().over(page.orderBy("chunk_no")) - 1,
        "n_chunk_of_page": F.count("*").over(page).cast("int"),
        "i_chunk_on_doc": F.row_number().over(_doc().orderBy("chunk_no")) - 1,
        "n_chunk_of_doc": F.count("*").over(_doc()).cast("int"),
    })


def normalized_boxes(chunks: DataFrame, page_sizes: DataFrame) -> DataFrame:
    """chunk_bboxes: JSON of the boxes as shares of their page; null without boxes or sizes. page_sizes: doc_id, page, width, height."""
    entries = chunks.select("doc_id", "chunk_no", F.posexplode("bboxes").alias("k", "b")).where("b.bbox is not null").select("doc_id", "chunk_no", "k", "b", F.col("b.page").alias("page"))
    x = lambda f, by: (F.col(f"b.bbox.{f}") / F.col(by)).alias({"x0": "l", "y0": "t", "x1": "r", "y1": "b"}[f])
    box = F.struct(x("x0", "width"), x("y0", "height"), x("x1", "width"), x("y1", "height"), F.lit("TOPLEFT").alias("coord_origin"))
    sized = entries.join(page_sizes, ["doc_id", "page"]).select("doc_id", "chunk_no", F.struct("k", F.col("page"), box.alias("bbox"), F.col("b.category").alias("type")).alias("e"))
    joined = sized.groupBy("doc_id", "chunk_no").agg(F.to_json(F.transform(F.sort_array(F.collect_list("e")), lambda e: F.struct(e["page"].alias("page"), e["bbox"].alias("bbox"), e["type"].alias("type"))), {"ignoreNullFields": "false"}).alias("chunk_bboxes"))
    return chunks.drop("bboxes").join(joined, ["doc_id", "chunk_no"], "left")


def vectors(chunks: DataFrame, page_sizes: DataFrame | None = None, reg_date: str | None = None) -> DataFrame:
    """The record of each chunk."""
    boxed = normalized_boxes(chunks, page_sizes) if page_sizes is not None else chunks.drop("bboxes").withColumn("chunk_bboxes", F.lit(None).cast("string"))
    t = F.col("text")
    rows = counters(boxed).withColumns({"n_chars": F.length(t), "n_words": n_words(t), "n_lines": n_lines(t), "reg_date": F.lit(reg_date) if reg_date else utc_now()})
    return rows.select("doc_id", "text", "n_chars", "n_words", "n_lines", "i_page", "e_page", "n_page", "i_chunk_on_page", "n_chunk_of_page", "i_chunk_on_doc", "n_chunk_of_doc", "reg_date", "chunk_bboxes")


def simple_records(chunks: DataFrame) -> DataFrame:
    return chunks.select("doc_id", F.col("chunk_no").alias("chunk_id"), F.col("text").alias("content"), F.array("i_page", "e_page").alias("page_range"))


def totals(records: DataFrame) -> DataFrame:
    """Records and characters of each document."""
    return records.groupBy("doc_id").agg(F.count("*").alias("num_vectors"), F.sum("n_chars").alias("total_chars"))


def pixel_box(box: Column, width: Column, height: Column) -> Column:
    """Pixels of a normalised box; BOTTOMLEFT boxes are turned over."""
    flip = box["coord_origin"] == "BOTTOMLEFT"
    top, bottom = F.when(flip, 1 - box["t"]).otherwise(box["t"]), F.when(flip, 1 - box["b"]).otherwise(box["b"])
    return F.struct((box["l"] * width).alias("left"), (F.least(top, bottom) * height).alias("top"), ((box["r"] - box["l"]) * width).alias("width"), (F.abs(bottom - top) * height).alias("height"))


def pages_touched(chunks: DataFrame) -> DataFrame:
    pages = F.array_distinct(F.concat(F.coalesce(F.transform("bboxes", lambda b: b["page"]), F.array().cast("array<int>")), F.array("i_page", "e_page")))
    return chunks.select("doc_id", "chunk_no", F.explode(pages).alias("page"))
