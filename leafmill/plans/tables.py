"""Intermediate relations derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame, key: str) -> DataFrame:
    """rows in as many tasks as the session's shuffles have, before Python makes or reads files of them: by its bytes a table of millions of
    small rows would be one task or two."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def items_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents as items: ten to a page, short ones are headers."""
    rows = read(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("seq", "text"))
    y = (F.col("seq") % 10 * 12).cast("double")
    return rows.select("doc_id", "seq", F.expr("cast(seq div 10 + 1 as int)").alias("page"), F.when(F.length("text") <= 40, "section_header").otherwise("text").alias("category"), "text", F.struct(F.lit(0.0).alias("x0"), y.alias("y0"), F.length("text").cast("double").alias("x1"), (y + 10).alias("y1")).alias("bbox"))


def items_paged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """items_doc, moved down, with the source as header and the page number as footer of each page."""
    items = items_doc(spark, sf_dir)
    body = items.select("doc_id", "page", (F.col("seq") + 1000 * F.col("page")).alias("seq"), "category", "text", F.struct(F.lit(0.0).alias("x0"), (F.col("bbox.y0") + 40).alias("y0"), F.lit(500.0).alias("x1"), (F.col("bbox.y0") + 50).alias("y1")).alias("bbox"))
    pages = items.groupBy("doc_id").agg(F.max("page").alias("n")).join(read(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id").select("doc_id", "n", "source", F.explode(F.sequence(F.lit(1), "n")).alias("page"))

    def line(offset: int, text, top: float) -> DataFrame:
        return pages.select("doc_id", "page", (1000 * F.col("page") + offset).alias("seq"), F.lit("text").alias("category"), text.alias("text"), F.struct(F.lit(0.0).alias("x0"), F.lit(top).alias("y0"), F.lit(500.0).alias("x1"), F.lit(top + 8).alias("y1")).alias("bbox"))

    numbered = F.concat(F.lit("Page "), F.col("page").cast("string"), F.lit(" of "), F.col("n").cast("string"))
    return body.unionByName(line(-1, F.coalesce("source", F.lit("")), 0.0)).unionByName(line(999, numbered, 190.0))


def items_wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents cut every 60 characters and stripped, as text items, ten to a page."""
    from leafmill.functions.text import strip

    lines = read(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line", "t"))
    # Pieces are exploded, not the line with each of them.
    cut = lines.select("doc_id", "line", F.length("t").cast("double").alias("width"), F.posexplode(F.regexp_extract_all("t", F.lit("(?s).{1,60}"), F.lit(0))).alias("k", "part"))
    seq = F.col("line") * 10000 + F.col("k")
    return cut.select("doc_id", seq.alias("seq"), F.expr("cast(line div 10 + 1 as int)").alias("page"), F.lit("text").alias("category"), strip(F.col("part")).alias("text"), F.struct(F.lit(0.0).alias("x0"), F.col("k").cast("double").alias("y0"), F.col("width").alias("x1"), (F.col("k") + 1).cast("double").alias("y1")).alias("bbox"))


def corrupt_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with damaged characters, and glyph names in every fifth document."""
    rows = items_doc(spark, sf_dir)
    text = F.concat(F.replace("text", F.lit("thth"), F.lit("�")), F.when(F.col("doc_id") % 5 == 0, "GLYPH<41>").otherwise(""))
    return rows.withColumn("text", F.when(F.col("seq") % 3 == 0, text).otherwise(F.col("text")))


def boxes_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines at places given by the keys of part: forty a page and five pages a document, however many there are."""
    k = F.col("p_partkey")
    left, top = (k * 37 % 500).cast("double"), (k * 53 % 700).cast("double")
    return read(spark, sf_dir, "part").select(F.expr("p_partkey div 200").alias("doc_id"), F.expr("cast(p_partkey div 40 % 5 + 1 as int)").alias("page"), k.cast("int").alias("seq"), F.col("p_name").alias("text"), F.struct(left.alias("x0"), top.alias("y0"), (left + 20 + k % 60).alias("x1"), (top + 8 + k % 9).alias("y1")).alias("bbox"), (8 + k % 4 * 2).cast("double").alias("font_size"))


def boxes_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions at places given by the keys of customer: thirty a page, six of them in one place."""
    k = F.col("c_custkey")
    left, top = F.expr("cast(c_custkey div 6 * 41 % 480 as double)"), F.expr("cast(c_custkey div 6 * 59 % 640 as double)")
    label = F.element_at(F.array(*[F.lit(x) for x in ("Text", "Title", "List-item", "Table", "Picture", "Code", "Strange label")]), (k % 7 + 1).cast("int"))
    return read(spark, sf_dir, "customer").select(F.expr("c_custkey div 150").alias("doc_id"), F.expr("cast(c_custkey div 30 % 5 + 1 as int)").alias("page"), k.cast("int").alias("region_no"), label.alias("category"), ((k % 100) / 100.0).alias("confidence"), (left + k % 3).alias("l"), top.alias("t"), (left + 40 + k % 80).alias("r"), (top + 30 + k % 70).alias("b"))


def crowded_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of boxes_lines on fifty pages, however many there are."""
    k = F.col("seq")
    return boxes_lines(spark, sf_dir).withColumns({"doc_id": (k % 10).cast("bigint"), "page": F.expr("cast(seq div 10 % 5 + 1 as int)")})


def crowded_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions like those of boxes_regions on fifty pages, however many there are; a hundred numbers in a row begin in one place."""
    k = F.col("region_no")
    left, top = F.expr("cast(region_no div 100 * 41 % 480 as double)"), F.expr("cast(region_no div 100 * 59 % 640 as double)")
    return boxes_regions(spark, sf_dir).withColumns({"doc_id": (k % 10).cast("bigint"), "page": F.expr("cast(region_no div 10 % 5 + 1 as int)"), "l": left + k % 3, "t": top, "r": left + 40 + k % 80, "b": top + 30 + k % 70})


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as sheets of a hundred: twenty a block, each block with a caption and a head, and a blank row after it."""
    k = F.col("o_orderkey")
    rows = read(spark, sf_dir, "orders").select(F.expr("o_orderkey div 100").alias("doc_id"), F.expr("o_orderkey div 20 % 5").alias("b"), k, "o_orderpriority", "o_orderstatus")
    blocks = rows.select("doc_id", "b").distinct()
    one = lambda df, at, *cells: df.select("doc_id", (F.col("b") * 100 + at).alias("row_no"), F.array(*cells).alias("cells"))
    heads = one(blocks, 0, F.concat(F.lit("block "), F.col("b").cast("string")), F.lit(""), F.lit(""))
    names = one(blocks, 1, F.lit("key"), F.lit("priority"), F.lit("a<b & 'c'"))
    body = one(rows, k % 20 + 2, k.cast("string"), F.col("o_orderpriority"), F.concat(F.lit("<"), "o_orderstatus", F.lit(">")))
    blank = one(blocks, 99, F.lit(""), F.lit(" "), F.lit(""))
    return heads.unionByName(names).unionByName(body).unionByName(blank)


def structures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as tables of five times five cells: some cells span two columns, the first row is a header."""
    k = F.col("o_orderkey")
    token = F.array(F.struct(F.lit(2.0).alias("t"), F.lit(0.0).alias("l"), F.lit("x|y").alias("token")), F.struct(F.lit(1.0).alias("t"), F.lit(0.0).alias("l"), F.col("o_orderpriority").alias("token")))
    r, c = F.expr("cast(o_orderkey div 5 % 5 as int)"), (k % 5).cast("int")
    cell = F.struct(r.alias("start_row_offset_idx"), c.alias("start_col_offset_idx"), F.lit(1).alias("row_span"), F.when(k % 7 == 0, 2).otherwise(1).alias("col_span"), (r == 0).alias("column_header"), token.alias("text_cell_bboxes"))
    rows = read(spark, sf_dir, "orders").select(F.expr("o_orderkey div 25").alias("table_id"), F.struct(k.alias("k"), cell.alias("c")).alias("x"))
    return rows.groupBy("table_id").agg(F.transform(F.sort_array(F.collect_list("x")), lambda v: v["c"]).alias("cells")).select("table_id", F.lit(5).alias("num_rows"), F.lit(5).alias("num_cols"), "cells")
