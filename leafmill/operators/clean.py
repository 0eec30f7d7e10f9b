"""Repeated headers and footers, and paragraphs that were split."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafmill.functions.text import strip

#: Pages needed, height of the bands, share of pages that repeat a line.
MIN_PAGES, BAND, REPEAT = 3, 0.1, 0.6
PAGE_NUMBER = r"(?iU)^[\-\s]*(page\s*)?\d+(\s*(of|/)\s*\d+)?[\-\s]*$"


def _split(items: DataFrame) -> DataFrame:
    return items if "split_no" in items.columns else items.withColumn("split_no", F.lit(0))


def strip_headers_footers(items: DataFrame) -> DataFrame:
    """items without the lines that repeat at the top or the bottom of enough pages of their split.

    Every step is a window inside a split, so items are shuffled once, by (doc_id, split_no).
    """
    whole, page = ["doc_id", "split_no"], ["doc_id", "split_no", "page"]
    by = Window.partitionBy
    rows = _split(items).repartition(*whole).withColumn("__key", strip(F.coalesce("text", F.lit(""))))
    rows = rows.withColumn("__key", F.when(F.col("__key").rlike(PAGE_NUMBER), F.lit("\x00page")).otherwise(F.col("__key")))
    top, bottom = F.min("bbox.y0").over(by(*page)), F.max("bbox.y1").over(by(*page))
    banded = rows.withColumns({"__top": top, "__bottom": bottom}).withColumn("__band", F.greatest(F.col("__bottom") - F.col("__top"), F.lit(1.0)) * BAND)
    kind = F.when(F.col("bbox.y1") <= F.col("__top") + F.col("__band"), "h").when(F.col("bbox.y0") >= F.col("__bottom") - F.col("__band"), "f")
    kinds = banded.withColumn("__kind", F.when(F.col("__key") != "", kind)).drop("__top", "__bottom", "__band")
    # The first banded line of a key on a page says which of the two it is there.
    first = F.row_number().over(by(*page, "__key").orderBy(F.col("__kind").isNull(), "seq"))
    once = kinds.withColumn("__kind", F.when(first == 1, F.col("__kind")))
    count = lambda k: F.count(F.when(F.col("__kind") == k, 1)).over(by(*whole, "__key"))
    counted = once.withColumns({"__n": F.greatest(count("h"), count("f")), "__pages": F.size(F.collect_set("page").over(by(*whole)))})
    stay = (F.col("__pages") < MIN_PAGES) | (F.col("__n") < F.greatest(F.lit(2), F.round(REPEAT * F.col("__pages"))))
    return counted.where(stay).select(*items.columns)


def merge_paragraphs(items: DataFrame) -> DataFrame:
    """Adjacent text items joined where one ends and the next begins inside a sentence.

    Each link depends on two neighbours only, so links are a lag and groups a running sum. What a line says about
    its ends is a few booleans, and only these are passed to its neighbours. A head keeps its page; its box takes in the members on
    that page. Items are taken as stripped texts, in the order of page and seq.
    """
    w = Window.partitionBy("doc_id", "split_no").orderBy("page", "seq")
    t, text = F.col("text"), F.col("category") == "text"
    # What a pattern over the whole line would say is in its trimmed ends: the last or first character, and that no line ends inside.
    space_ = F.lit(" \t\n\x0b\f\r")
    left, right = F.ltrim(t, space_), F.rtrim(t, space_)
    small = lambda c: (c >= "a") & (c <= "z")
    last = F.right(right, F.lit(1))
    ends = text & (F.length(right) > 1) & (small(last) | last.isin(",", "-")) & ~right.contains("\n")
    begins = text & (F.length(left) > 1) & small(F.left(left, F.lit(1))) & ~left.contains("\n")
    word = lambda pattern: F.regexp_extract(t, pattern, 1).rlike(r"(?U)^[\p{L}\p{N}]+$")
    hyphen = ends & t.endswith("-")
    sure = lambda c: F.coalesce(c, F.lit(False))
    rows = _split(items).withColumns({"__ends": sure(ends), "__begins": sure(begins), "__hyphen": sure(hyphen)}).withColumn("__half", F.when(F.col("__hyphen"), word(r"(?U)(\w+)\W*$")).otherwise(False))
    before = lambda c: F.coalesce(F.lag(c).over(w), F.lit(False))
    linked = rows.withColumns({"__link": F.col("__begins") & before("__ends"), "__after": before("__hyphen"), "__other": before("__half")})
    # A hyphen between two halves of a word goes; one after something else stays, without a space; all others get a space.
    linked = linked.withColumn("__joins", F.when(F.col("__other") & F.col("__begins"), word(r"(?U)^\W*(\w+)")).otherwise(False))
    cut = F.coalesce(F.lead("__joins").over(w), F.lit(False))
    grouped = linked.withColumns({"__cut": cut, "__group": F.sum((~F.col("__link")).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))})
    part = F.concat(F.when(F.col("__link") & ~F.col("__after"), " ").otherwise(""), F.when(F.col("__cut"), F.expr("substring(text, 1, length(text) - 1)")).otherwise(t))
    at = F.struct("page", "seq")
    # A head has the least page; the boxes on it are those with the least page of all that have a box, if that is the head's.
    side = lambda k: F.when(F.col("bbox").isNotNull(), k)
    first, far = (F.struct("page", F.col(f"bbox.{k}").alias("v")) for k in ("x0", "y0")), (F.struct((-F.col("page")).alias("page"), F.col(f"bbox.{k}").alias("v")) for k in ("x1", "y1"))
    (x0, y0), (x1, y1) = ([F.min(side(c)) for c in first], [F.max(side(c)) for c in far])
    box = F.struct(x0["v"].alias("x0"), y0["v"].alias("y0"), x1["v"].alias("x1"), y1["v"].alias("y1"))
    out = grouped.withColumn("__part", part).groupBy("doc_id", "split_no", "__group").agg(
        F.min(at)["seq"].alias("seq"),
        F.min("page").alias("page"),
        F.min_by("category", at).alias("category"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("page", "seq", "__part"))), lambda x: x["__part"]), "").alias("text"),
        F.when(x0["page"] == F.min("page"), box).alias("bbox"),
    )
    return out.select(*[c for c in ("doc_id", "split_no", "seq", "page", "category", "text", "bbox") if c in items.columns])
