"""Grids and table structures as HTML or Markdown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.functions.text import escape, strip


def is_blank(cells: Column) -> Column:
    return F.forall(cells, lambda x: strip(F.coalesce(x, F.lit(""))) == "")


def blocks(grid: DataFrame) -> DataFrame:
    """grid (doc_id, row_no, cells) without blank rows, with the number of the block that they separate."""
    w = Window.partitionBy("doc_id").orderBy("row_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = grid.withColumn("__blank", is_blank(F.col("cells"))).withColumn("__b", F.sum(F.col("__blank").cast("int")).over(w))
    return marked.where("not __blank").withColumn("block", F.dense_rank().over(Window.partitionBy("doc_id").orderBy("__b"))).drop("__blank", "__b")


def _row(cells: Column, tag: str) -> Column:
    return F.concat(F.lit("<tr>"), F.array_join(F.transform(cells, lambda x: F.concat(F.lit(f"<{tag}>"), escape(x), F.lit(f"</{tag}>"))), ""), F.lit("</tr>"))


def html_of(rows: Column) -> Column:
    """The table of an array of rows: a first row with one distinct cell is the caption, if others follow."""
    distinct = F.array_distinct(F.filter(F.get(rows, 0), lambda x: strip(x) != ""))
    captioned = (F.size(distinct) == 1) & (F.size(rows) > 1)
    start = F.when(captioned, 1).otherwise(0)
    head, body = F.get(rows, start), F.slice(rows, start + 2, F.greatest(F.size(rows) - start - 1, F.lit(0)))
    caption = F.when(captioned, F.concat(F.lit("<caption>"), escape(F.get(distinct, 0)), F.lit("</caption>"))).otherwise("")
    return F.concat(F.lit("<table>"), caption, F.lit("<thead>"), _row(head, "th"), F.lit("</thead><tbody>"), F.array_join(F.transform(body, lambda r: _row(r, "td")), ""), F.lit("</tbody></table>"))


def grid_tables(grid: DataFrame) -> DataFrame:
    """(doc_id, block, html) of each block of a grid."""
    rows = F.transform(F.sort_array(F.collect_list(F.struct("row_no", "cells"))), lambda r: r["cells"])
    return blocks(grid).groupBy("doc_id", "block").agg(rows.alias("rows")).select("doc_id", "block", html_of(F.col("rows")).alias("html"))


def fill_merged(cells: DataFrame, merged: DataFrame) -> DataFrame:
    """cells (doc_id, r, c, value) with the top-left value over each merged range (doc_id, r0, c0, r1, c1)."""
    covered = merged.select("doc_id", "r0", "c0", F.explode(F.sequence("r0", "r1")).alias("r"), "c1").select("doc_id", "r0", "c0", "r", F.explode(F.sequence("c0", "c1")).alias("c"))
    heads = covered.join(cells.select("doc_id", F.col("r").alias("r0"), F.col("c").alias("c0"), F.col("value").alias("fill")), ["doc_id", "r0", "c0"], "left")
    return cells.join(heads.select("doc_id", "r", "c", F.coalesce("fill", F.lit("")).alias("fill"), F.lit(True).alias("__in")), ["doc_id", "r", "c"], "left").select("doc_id", "r", "c", F.when(F.col("__in"), F.col("fill")).otherwise(F.coalesce("value", F.lit(""))).alias("value"))


def index_cells(structures: DataFrame) -> DataFrame:
    """One row for each start cell inside the table: of cells with one start the later wins; tokens by (t, l), joined by spaces.

    structures: table_id, num_rows, num_cols, cells (start_row_offset_idx, start_col_offset_idx, row_span, col_span, column_header, text_cell_bboxes).
    """
    rows = structures.select("table_id", "num_rows", "num_cols", F.posexplode("cells").alias("k", "c"))
    text = F.array_join(F.transform(F.sort_array(F.coalesce(F.transform("c.text_cell_bboxes", lambda t: F.struct(t["t"].alias("t"), t["l"].alias("l"), t["token"].alias("token"))), F.array().cast("array<struct<t: double, l: double, token: string>>"))), lambda t: t["token"]), " ")
    found = rows.select(
        "table_id", "num_rows", "num_cols", "k", F.col("c.start_row_offset_idx").alias("r"), F.col("c.start_col_offset_idx").alias("col"), F.greatest(F.coalesce("c.row_span", F.lit(1)), F.lit(1)).alias("rs"),
        F.greatest(F.coalesce("c.col_span", F.lit(1)), F.lit(1)).alias("cs"), F.coalesce("c.column_header", F.lit(False)).alias("head"), text.alias("text"),
    ).where("r >= 0 and r < num_rows and col >= 0 and col < num_cols")
    last = F.max_by(F.struct("rs", "cs", "head", "text"), "k")
    return found.groupBy("table_id", "num_rows", "num_cols", "r", "col").agg(last.alias("x")).select("table_id", "num_rows", "num_cols", "r", "col", "x.*")


def _slots(structures: DataFrame) -> DataFrame:
    sized = structures.where("num_rows > 0 and num_cols > 0")
    return sized.select("table_id", "num_cols", F.explode(F.expr("sequence(0, num_rows - 1)")).alias("r"), F.expr("sequence(0, num_cols - 1)").alias("cs")).select("table_id", "num_cols", "r", F.explode("cs").alias("col"))


def _render(slots: DataFrame, structures: DataFrame, row, join: str) -> DataFrame:
    lines = slots.groupBy("table_id", "r").agg(F.transform(F.sort_array(F.collect_list(F.struct("col", "x"))), lambda v: v["x"]).alias("xs"), F.max("head").alias("head"), F.first("num_cols").alias("num_cols"))
    out = row(lines).groupBy("table_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("r", "line"))), lambda v: v["line"]), join).alias("out"))
    return structures.select("table_id").join(out, "table_id", "left")


def structure_html(structures: DataFrame) -> DataFrame:
    """(table_id, html) with row and column spans; covered cells are left out."""
    cells = index_cells(structures)
    covered = cells.select("table_id", "r", "col", F.explode(F.expr("sequence(r, r + rs - 1)")).alias("rr"), "cs").select("table_id", "r", "col", "rr", F.explode(F.expr("sequence(col, col + cs - 1)")).alias("cc")).where("rr <> r or cc <> col").select("table_id", F.col("rr").alias("r"), F.col("cc").alias("col")).distinct()
    span = lambda name, c: F.when(F.col(c) > 1, F.concat(F.lit(f' {name}="'), F.col(c).cast("string"), F.lit('"'))).otherwise("")
    tag = F.when(F.col("head"), "th").otherwise("td")
    cell = F.when(F.col("rs").isNull(), "<td></td>").otherwise(F.concat(F.lit("<"), tag, span("rowspan", "rs"), span("colspan", "cs"), F.lit(">"), escape(F.col("text")), F.lit("</"), tag, F.lit(">")))
    slots = _slots(structures).join(covered, ["table_id", "r", "col"], "left_anti").join(cells.drop("num_rows", "num_cols"), ["table_id", "r", "col"], "left").withColumn("x", cell)
    # Rows whose cells are all covered still are rows.
    rows = _slots(structures).select("table_id", "r", "num_cols").distinct()
    lines = rows.join(slots.groupBy("table_id", "r").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("col", "x"))), lambda v: v["x"]), "").alias("l")), ["table_id", "r"], "left")
    out = lines.select("table_id", "r", F.concat(F.lit("<tr>"), F.coalesce("l", F.lit("")), F.lit("</tr>")).alias("line")).groupBy("table_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("r", "line"))), lambda v: v["line"]), "").alias("out"))
    return structures.select("table_id").join(out, "table_id", "left").select("table_id", F.coalesce(F.concat(F.lit("<table>"), F.col("out"), F.lit("</table>")), F.lit("")).alias("html"))


def structure_markdown(structures: DataFrame) -> DataFrame:
    """(table_id, markdown): spans are blank but for their start; a rule follows the first header row, if there is one."""
    cells = index_cells(structures).drop("num_rows", "num_cols")
    slots = _slots(structures).join(cells, ["table_id", "r", "col"], "left").withColumn("x", F.replace(F.coalesce("text", F.lit("")), F.lit("|"), F.lit("\\|")))
    first = F.min(F.when(F.col("head"), F.col("r"))).over(Window.partitionBy("table_id"))

    def row(lines: DataFrame) -> DataFrame:
        line = F.concat(F.lit("| "), F.array_join("xs", " | "), F.lit(" |"))
        rule = F.concat(F.lit("\n| "), F.array_join(F.array_repeat(F.lit("---"), F.col("num_cols")), " | "), F.lit(" |"))
        return lines.withColumn("line", F.concat(line, F.when(F.col("r") == first, rule).otherwise("")))

    return _render(slots, structures, row, "\n").select("table_id", F.coalesce("out", F.lit("")).alias("markdown"))
