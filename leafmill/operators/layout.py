"""Categories of lines and regions: geometry as joins inside a page.

lines: doc_id, page, seq, text, bbox, font_size; regions: doc_id, page, region_no, category, confidence, l, t, r, b.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.functions.text import strip, to_category
from leafmill.operators import graph, grid
from leafmill.store import written

#: Headings are so much larger than the body; overlap of lines and of regions; thresholds.
HEADING_RATIO, LINE_OVERLAP, REGION_OVERLAP, FULL_PAGE = 1.2, 0.2, 0.8, 0.9
LOW_CONFIDENCE = ("section_header", "title", "code", "checkbox_selected", "checkbox_unselected", "form", "key_value_region", "document_index")
WRAPPERS = ("form", "key_value_region", "table", "document_index")
OVERLAP_PARAMS = {"regular": (1.3, 0.05), "picture": (2.0, 0.3), "wrapper": (2.0, 0.2)}


def body_size(lines: DataFrame) -> DataFrame:
    """`body`: the most frequent font size over 0 of the page; the smallest of equals."""
    size = Window.partitionBy("doc_id", "page", "font_size")
    page = Window.partitionBy("doc_id", "page")
    counted = lines.withColumn("__n", F.when(F.col("font_size") > 0, F.count("*").over(size)))
    return counted.withColumn("body", F.max(F.when(F.col("__n").isNotNull(), F.struct("__n", (-F.col("font_size")).alias("s")))).over(page)).withColumn("body", -F.col("body.s")).drop("__n")


def rule_layout(lines: DataFrame, body: bool = False) -> DataFrame:
    """lines with `category`, by their size against the page's body; with that size as `body` if asked for."""
    found = body_size(lines).withColumn("category", F.when(F.col("font_size") >= HEADING_RATIO * F.col("body"), "section_header").otherwise("text"))
    return found if body else found.drop("body")


def filter_regions(regions: DataFrame, width: float | None = None, height: float | None = None) -> DataFrame:
    """Normalised labels, thresholds by category, titles as section headers, and no pictures of a whole page."""
    least = F.when(F.col("category").isin(*LOW_CONFIDENCE), 0.45).otherwise(0.5)
    out = regions.withColumn("category", to_category(F.col("category"))).where(F.col("confidence") >= least).withColumn("category", F.when(F.col("category") == "title", "section_header").otherwise(F.col("category")))
    if width and height:
        out = out.where(~((F.col("category") == "picture") & ((F.col("r") - F.col("l")) * (F.col("b") - F.col("t")) > FULL_PAGE * width * height)))
    return out


PAGE = ["doc_id", "page"]


def area(box: str) -> Column:
    at = lambda c: F.col(f"{box}.{c}" if box else c)
    return (at("r") - at("l")) * (at("b") - at("t"))


def shared_area(a: str = "a", b: str = "b") -> Column:
    w = F.least(F.col(f"{a}.r"), F.col(f"{b}.r")) - F.greatest(F.col(f"{a}.l"), F.col(f"{b}.l"))
    h = F.least(F.col(f"{a}.b"), F.col(f"{b}.b")) - F.greatest(F.col(f"{a}.t"), F.col(f"{b}.t"))
    return F.greatest(w, F.lit(0.0)) * F.greatest(h, F.lit(0.0))


BOX = ["l", "t", "r", "b"]


def _best(lines: DataFrame, keys: list[str], pairs: DataFrame, rank: Column, carry: tuple[str, ...]) -> DataFrame:
    """lines with region_no and the columns `carry` of the region of the least rank, then number; null where there is none. Pairs have the
    lines' `keys` and the region's number and columns as a struct `first`."""
    best = pairs.groupBy(*PAGE, *keys).agg(F.min(F.struct(rank.alias("rank"), F.col("b.first").alias("first")))["first"].alias("first"))
    return lines.join(best, [*PAGE, *keys], "left").withColumns({c: F.col(f"first.{c}") for c in ("region_no", *carry)}).drop("first", *keys)


def _different(regions: DataFrame, carry: tuple[str, ...]) -> DataFrame:
    """The boxes of regions, each once a page, with the least number and its columns as a struct `first`: of regions in one place only that one can be matched."""
    return regions.groupBy(*PAGE, *BOX).agg(F.min(F.struct("region_no", *carry)).alias("first"))


def match_overlap(lines: DataFrame, regions: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """region_no of the region that covers most of each line, if over LINE_OVERLAP; the first of equals. carry: more columns of that region.

    Boxes that are equal are compared once, so the work follows the different ones of a page.
    """
    own = ["__l", "__t", "__r", "__b"]
    placed = lines.withColumns({k: F.col(f"bbox.{x}") for k, x in zip(own, ("x0", "y0", "x1", "y1"), strict=True)})
    boxes = placed.select(*PAGE, *[F.col(k).alias(c) for k, c in zip(own, BOX, strict=True)]).distinct()
    share = shared_area() / area("a")
    pairs = grid.sharing(boxes, _different(regions, carry), PAGE).where(share > LINE_OVERLAP)
    return _best(placed, own, pairs.select(*PAGE, *[F.col(f"a.{c}").alias(k) for k, c in zip(own, BOX, strict=True)], "a", "b"), -share, carry)


def match_center(lines: DataFrame, regions: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """region_no of the smallest region that holds each line's centre, edges included; the first of equals. carry: more columns of that region. Equal centres and boxes are compared once."""
    placed = lines.withColumns({"__x": (F.col("bbox.x0") + F.col("bbox.x1")) / 2, "__y": (F.col("bbox.y0") + F.col("bbox.y1")) / 2})
    centres = placed.select(*PAGE, F.col("__x").alias("x"), F.col("__y").alias("y")).distinct()
    pairs = grid.holding(centres, _different(regions, carry), PAGE)
    return _best(placed, ["__x", "__y"], pairs.select(*PAGE, F.col("a.x").alias("__x"), F.col("a.y").alias("__y"), "b"), area("b"), carry)


def group_of(category: Column) -> Column:
    return F.when(category == "picture", "picture").when(category.isin(*WRAPPERS), "wrapper").otherwise("regular")


def _overlapping(boxes: DataFrame) -> DataFrame:
    """Pairs a and b of boxes (PAGE, grp, region_no, l, t, r, b) of one group that overlap or contain one another, each once, a the smaller.

    Either means that they share over REGION_OVERLAP of the smaller one, so the larger one holds its centre.
    """
    keys = [*PAGE, "grp"]
    solid = boxes.where("r > l and b > t")
    centres = solid.select(*keys, "region_no", *BOX, ((F.col("l") + F.col("r")) / 2).alias("x"), ((F.col("t") + F.col("b")) / 2).alias("y"))
    both = shared_area()
    near = (both / (area("a") + area("b") - both) > REGION_OVERLAP) | (both / area("a") > REGION_OVERLAP) | (both / area("b") > REGION_OVERLAP)
    smaller = (area("a") < area("b")) | ((area("a") == area("b")) & (F.col("a.region_no") < F.col("b.region_no")))
    return grid.holding(centres, solid, keys).where(smaller & near)


def _copies(regions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Regions as (PAGE, grp, region_no, l, t, r, b), and of those in one place and group only the first."""
    boxes = regions.select(*PAGE, group_of(F.col("category")).alias("grp"), "region_no", *BOX)
    return boxes, boxes.groupBy(*PAGE, "grp", *BOX).agg(F.min("region_no").alias("region_no"))


def overlap_edges(regions: DataFrame) -> DataFrame:
    """(doc_id, page, a, b): pairs of regions of one group that overlap or contain one another. Different boxes are compared, their copies join the pairs."""
    boxes, first = _copies(regions)
    own = boxes.where("r > l and b > t").join(first.withColumnRenamed("region_no", "first"), [*PAGE, "grp", *BOX]).select(*PAGE, "first", "region_no")
    side = lambda c: own.withColumnsRenamed({"first": f"f{c}", "region_no": c})
    pairs = _overlapping(first).select(*PAGE, F.col("a.region_no").alias("fa"), F.col("b.region_no").alias("fb"))
    apart = pairs.join(side("a"), [*PAGE, "fa"]).join(side("b"), [*PAGE, "fb"]).select(*PAGE, F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    same = side("a").withColumnRenamed("fa", "first").join(side("b").withColumnRenamed("fb", "first"), [*PAGE, "first"]).where("a < b").select(*PAGE, "a", "b")
    return apart.unionByName(same)


def _clusters(regions: DataFrame) -> DataFrame:
    """(doc_id, page, region_no, label) of the regions that overlap others: the least number of those that overlap_edges() connects. Copies follow the first of them."""
    boxes, first = _copies(regions)
    members = boxes.where("r > l and b > t").join(first.withColumnRenamed("region_no", "first"), [*PAGE, "grp", *BOX]).select(*PAGE, "first", "region_no")
    label = graph.components(_overlapping(first).select(*PAGE, F.col("a.region_no").alias("a"), F.col("b.region_no").alias("b")), PAGE)
    alone = members.groupBy(*PAGE, "first").agg(F.count("*").alias("n"))
    found = alone.join(label.withColumnRenamed("node", "first"), [*PAGE, "first"], "left").where("n > 1 or label is not null").select(*PAGE, "first", F.coalesce("label", "first").alias("label"))
    return members.join(found, [*PAGE, "first"]).select(*PAGE, "region_no", "label")


def _stands_back(c: str, other: str, exceptions: bool = True) -> Column:
    """Whether region c gives way to another of its cluster: it is hardly larger and clearly less sure, unless it is a list item
    as large as a text or code around the other."""
    grp, (regular, picture, wrapper) = F.col(f"{c}.grp"), OVERLAP_PARAMS.values()
    most, loss = (F.when(grp == "picture", picture[i]).when(grp == "wrapper", wrapper[i]).otherwise(regular[i]) for i in (0, 1))
    ratio = area(c) / area(other)
    as_list = (F.col(f"{c}.category") == "list_item") & (F.col(f"{other}.category") == "text") & (F.abs(1 - ratio) < 0.2)
    as_code = (F.col(f"{c}.category") == "code") & (shared_area(c, other) / area(other) > REGION_OVERLAP)
    surer = (ratio <= most) & (F.col(f"{other}.confidence") - F.col(f"{c}.confidence") > loss)
    return surer & ~as_list & ~as_code if exceptions else surer


def _able(members: DataFrame, cluster: list[str]) -> DataFrame:
    """The members of clusters that give way to no other.

    One gives way to a surer one that is not much smaller, so those are asked first than which none is both surer and larger, among texts and among
    others. List items and codes for which one of the first would have sufficed but for an exception are then held against the rest: list items against
    each area of a text with its best confidence, codes against all.
    """

    def giving_way(rows: DataFrame, others: DataFrame, how: str, exceptions: bool = True) -> DataFrame:
        c, o = rows.alias("c"), others.alias("o")
        same = (F.col("c.region_no") != F.col("o.region_no")) & _stands_back("c", "o", exceptions)
        for k in cluster:
            same = same & (F.col(f"c.{k}") == F.col(f"o.{k}"))
        return c.join(o, same, how)

    size, sure = area(""), F.col("confidence")
    w = Window.partitionBy(*cluster, F.col("category") == "text").orderBy(sure.desc(), size.desc(), "region_no").rowsBetween(Window.unboundedPreceding, -1)
    first = members.where(sure.isNotNull()).withColumn("__most", F.max(size).over(w)).where(F.col("__most").isNull() | (size > F.col("__most"))).drop("__most")
    first = written(first, "first")
    left = written(giving_way(members, first, "left_anti"), "able")
    excepted = written(giving_way(left.where(F.col("category").isin("list_item", "code")), first, "left_semi", False), "excepted")
    texts = members.where("category = 'text'").withColumn("__area", size)
    surest = Window.partitionBy(*cluster, "__area").orderBy(sure.desc_nulls_last(), "region_no")
    texts = texts.withColumn("__n", F.row_number().over(surest)).where("__n = 1").drop("__n", "__area")
    gone = giving_way(excepted.where("category = 'list_item'"), texts, "left_semi").unionByName(giving_way(excepted.where("category = 'code'"), members, "left_semi"))
    return left.join(gone.select(*PAGE, "region_no"), [*PAGE, "region_no"], "left_anti")


def remove_overlaps(regions: DataFrame) -> DataFrame:
    """regions without those that another of their cluster stands for.

    Clusters are what overlap_edges() connects. Of a cluster stays, among the regions that give way to no other, the first
    one unless a later one is larger and not clearly less sure; where all give way, the first of the cluster. A region that
    overlaps no other stays.
    """
    regions = written(regions, "regions")
    members = written(regions.withColumn("grp", group_of(F.col("category"))).join(_clusters(regions), [*PAGE, "region_no"]), "clusters")
    cluster = [*PAGE, "label"]
    able = _able(members, cluster)
    loss = F.create_map(*[x for k, v in OVERLAP_PARAMS.items() for x in (F.lit(k), F.lit(v[1]))])[F.first("grp")]
    candidates = able.groupBy(*cluster).agg(F.sort_array(F.collect_list(F.struct("region_no", area("").alias("area"), "confidence"))).alias("able"), loss.alias("loss"))
    better = lambda best, x: (x["area"] > best["area"]) & (best["confidence"] - x["confidence"] <= F.col("loss"))
    chosen = F.aggregate(F.slice("able", 2, F.size("able")), F.get("able", 0), lambda best, x: F.when(better(best, x), x).otherwise(best))
    best = candidates.select(*cluster, chosen["region_no"].alias("best"))
    # The label is the least number of the cluster.
    gone = members.select(*cluster, "region_no").join(best, cluster, "left").where(F.col("region_no") != F.coalesce("best", "label"))
    return regions.join(gone.select(*PAGE, "region_no"), [*PAGE, "region_no"], "left_anti").select(*regions.columns)


def table_items(lines: DataFrame, regions: DataFrame, tables: DataFrame) -> DataFrame:
    """Lines with region_no as items; the lines of a table region become one, with its HTML (tables: doc_id, page, region_no, html) and box."""
    r = regions.select("doc_id", "page", "region_no", F.col("category").alias("region"), F.struct(F.col("l").alias("x0"), F.col("t").alias("y0"), F.col("r").alias("x1"), F.col("b").alias("y1")).alias("region_box"))
    rows = lines.join(r, ["doc_id", "page", "region_no"], "left").join(tables, ["doc_id", "page", "region_no"], "left")
    first = F.row_number().over(Window.partitionBy("doc_id", "page", "region_no").orderBy("seq"))
    kept = rows.withColumn("__n", F.when(F.col("region") == "table", first).otherwise(1)).where("__n = 1")
    table = F.coalesce(F.col("region") == "table", F.lit(False))
    text = F.when(table & (F.coalesce("html", F.lit("")) != ""), F.col("html")).otherwise(F.col("text"))
    return kept.select("doc_id", "page", "seq", F.coalesce("region", F.lit("text")).alias("category"), text.alias("text"), F.when(table, F.col("region_box")).otherwise(F.col("bbox")).alias("bbox"))


def word_tokens(lines: DataFrame) -> DataFrame:
    """(doc_id, page, seq, id, token, l, t, r, b): words of each line, as wide as their characters with one for each gap; ids count up by page."""
    words = F.expr(r"filter(split(text, '(?U)\\s+'), x -> x <> '')")
    rows = lines.select("doc_id", "page", "seq", "bbox", F.posexplode(words).alias("k", "token"))
    line = Window.partitionBy("doc_id", "page", "seq")
    before = F.coalesce(F.sum(F.length("token") + 1).over(line.orderBy("k").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum(F.length("token") + 1).over(line) - 1
    width = F.col("bbox.x1") - F.col("bbox.x0")
    placed = rows.withColumns({"l": F.col("bbox.x0") + width * before / total, "r": F.col("bbox.x0") + width * (before + F.length("token")) / total, "t": F.col("bbox.y0"), "b": F.col("bbox.y1")})
    return placed.withColumn("id", F.row_number().over(Window.partitionBy("doc_id", "page").orderBy("seq", "k")) - 1).select("doc_id", "page", "seq", "id", "token", "l", "t", "r", "b")


def rescale(value: Column, dpi: int = 150) -> Column:
    """Pixels at `dpi` as points."""
    return value / (dpi / 72)


def smart_resize(h: Column, w: Column, factor: int = 28, least: int = 3136, most: int = 11289600) -> Column:
    """(height, width) in multiples of `factor` with an area between the limits; null for sizes of 0 or too long shapes."""
    by = lambda f, x: f(x / factor) * factor
    h0, w0 = F.greatest(F.lit(factor), by(F.bround, h)), F.greatest(F.lit(factor), by(F.bround, w))
    shrink, grow = F.sqrt(h * w / most), F.sqrt(F.lit(least) / (h * w))
    small = lambda x: F.greatest(F.lit(factor), by(F.floor, x / shrink))
    size = lambda x, x0: F.when(h0 * w0 > most, small(x)).when(h0 * w0 < least, by(F.ceil, x * grow)).otherwise(x0)
    bad = (h <= 0) | (w <= 0) | (F.greatest(h, w) / F.least(h, w) > 200)
    return F.when(~bad, F.struct(size(h, h0).cast("int").alias("height"), size(w, w0).cast("int").alias("width")))


def grounding_box(l: Column, t: Column, r: Column, b: Column) -> Column:  # noqa: E741
    return F.concat(F.lit("["), F.concat_ws(", ", *[F.bround(x).cast("int").cast("string") for x in (l, t, r, b)]), F.lit("]"))


REGION_JSON = "array<struct<bbox: array<double>, category: string, text: string>>"


def parse_regions(content: Column) -> Column:
    """The regions in a model's answer: unfenced, from the first bracket, closed after the last whole element; [] if none."""
    fenced = F.regexp_extract(content, r"(?s)```(?:json)?\s*(.*?)```", 1)
    body = F.when(fenced != "", fenced).otherwise(content)
    cut = F.when(F.instr(body, "[") > 0, F.rtrim(F.regexp_extract(body, r"(?s)(\[.*)", 1))).otherwise("[]")
    closed = F.when(cut.endswith("]"), cut).when(cut.contains("}"), F.concat(F.regexp_extract(cut, r"(?s)^(.*\})", 1), F.lit("]"))).otherwise("[]")
    found = F.from_json(closed, REGION_JSON)
    good = F.filter(found, lambda e: (F.size(e["bbox"]) == 4) & F.forall(e["bbox"], lambda v: v.isNotNull()) & (F.coalesce(e["category"], F.lit("")) != ""))
    return F.coalesce(good, F.array().cast(REGION_JSON))


def span_lines(spans: DataFrame) -> DataFrame:
    """Lines of spans (doc_id, page, line_no, seq, text, size, bbox): texts with a space where the gap asks for one, the box of all, the size of most characters.

    A gap asks for a space if it is over a quarter of the two sizes' mean and neither side has one. Of sizes with as many
    characters the one found first counts. Blank lines go.
    """
    line = Window.partitionBy("doc_id", "page", "line_no")
    w = line.orderBy("seq")
    before = lambda c: F.lag(c).over(w)
    gap = F.col("bbox.x0") - before("bbox")["x1"]
    space = (gap > (F.col("size") + before("size")) / 2 * 0.25) & ~before("text").endswith(" ") & ~F.col("text").startswith(" ")
    weight, first = F.sum(F.length("text")).over(Window.partitionBy("doc_id", "page", "line_no", "size")), F.min("seq").over(Window.partitionBy("doc_id", "page", "line_no", "size"))
    rows = spans.withColumns({"__part": F.concat(F.when(space, " ").otherwise(""), F.col("text")), "__size": F.struct(weight.alias("n"), (-first).alias("first"), F.col("size").alias("size"))})
    box = F.struct(F.min("bbox.x0").alias("x0"), F.min("bbox.y0").alias("y0"), F.max("bbox.x1").alias("x1"), F.max("bbox.y1").alias("y1"))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seq", "__part"))), lambda x: x["__part"]), "")
    made = rows.groupBy("doc_id", "page", "line_no").agg(text.alias("text"), box.alias("bbox"), F.max("__size")["size"].alias("font_size"))
    return made.where(strip(F.col("text")) != "").withColumnRenamed("line_no", "seq")


def fragment_lines(fragments: DataFrame) -> DataFrame:
    """Lines of text fragments (doc_id, page, seq, text, x, y, font_size): a step in y of more than a point begins a line.

    Blank fragments don't count. A line starts at its first fragment and has the y and size of its last; its width is
    half that size a character.
    """
    w = Window.partitionBy("doc_id", "page").orderBy("seq")
    rows = fragments.where(strip(F.coalesce("text", F.lit(""))) != "")
    new = F.coalesce(F.abs(F.col("y") - F.lag("y").over(w)) > 1, F.lit(False))
    rows = rows.withColumn("__new", new).withColumn("__line", F.sum(F.col("__new").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seq", "text"))), lambda x: x["text"]), "")
    made = rows.groupBy("doc_id", "page", "__line").agg(text.alias("text"), F.min_by("x", "seq").alias("x"), F.max_by(F.struct("y", "font_size"), "seq").alias("e"))
    size = F.col("e.font_size")
    box = F.struct(F.col("x").alias("x0"), F.col("e.y").alias("y0"), (F.col("x") + size / 2 * F.length("text")).alias("x1"), (F.col("e.y") + size).alias("y1"))
    return made.select("doc_id", "page", F.col("__line").cast("int").alias("seq"), "text", box.alias("bbox"), size.alias("font_size"))
