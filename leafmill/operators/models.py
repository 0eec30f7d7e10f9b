"""Layout, OCR and table structure by model services, as plans around one Arrow call for each batch of pages.

pages: doc_id, page, image (binary, null without one). lines: doc_id, page, seq, text, bbox, font_size. A client is a
function without arguments that is run once in each task and gives a callable: list of row dicts -> list of answers,
one for each row. HTTP clients are below; tests and queries pass stubs. What comes back is relational from there on: regions are exploded,
filtered, deduplicated and joined to lines by operators.layout.

A page without image isn't sent anywhere: its lines are `text`, or it has no items where a model gives the text.
Repeated pages are asked for again; empty tables ask for nothing.
"""

from __future__ import annotations

import base64
import json
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions.text import corrupted, strip, to_category
from leafmill.operators import layout, tables
from leafmill.store import written

Answers = Callable[[list[dict]], list]
Client = Callable[[], Answers]

#: Pixels of an inch at which pages are rendered, and fixed values of the model's prompts.
DPI = 150
CATEGORY_NAMES = "['Caption', 'Footnote', 'Formula', 'List-item', 'Page-footer', 'Page-header', 'Picture', 'Section-header', 'Table', 'Text', 'Title']"
LAYOUT_PROMPT = (
    "Please output the layout information from this PDF image, including each layout's bbox and its category. The bbox should be in the format [x1, y1, x2, y2]. "
    f"The layout categories for the PDF document include {CATEGORY_NAMES}. Do not output the corresponding text. The layout result should be in JSON format."
)
ALL_PROMPT = (
    "Please output the layout information from the PDF image, including each layout element's bbox, its category, and the corresponding text content within the bbox.\n\n"
    f"1. Bbox format: [x1, y1, x2, y2]\n\n2. Layout Categories: The possible categories are {CATEGORY_NAMES}.\n\n3. Text Extraction & Formatting Rules:\n"
    "    - Picture: For the 'Picture' category, the text field should be omitted.\n    - Formula: Format its text as LaTeX.\n    - Table: Format its text as HTML.\n"
    "    - All Others (Text, Title, etc.): Format their text as Markdown.\n\n4. Constraints:\n    - The output text must be the original text from the image, with no translation.\n"
    "    - All layout elements must be sorted according to human reading order.\n\n5. Final Output: The entire output must be a single JSON array."
)
GROUNDING_PROMPT = "Extract text from the given bounding box on the image (format: [x1, y1, x2, y2]).\nBounding Box:\n"

BOX = "l double, t double, r double, b double"
REGION = f"doc_id bigint, page int, region_no int, label string, confidence double, {BOX}"
TOKEN = "array<struct<t: double, l: double, token: string>>"
CELL = f"struct<start_row_offset_idx: int, start_col_offset_idx: int, row_span: int, col_span: int, column_header: boolean, text_cell_bboxes: {TOKEN}>"


# --- HTTP clients -----------------------------------------------------------------------------------


def post(url: str, body: dict, timeout: float = 60, key: str | None = None) -> dict:
    """The JSON answer to a JSON body."""
    headers = {"Content-Type": "application/json", "Accept": "application/json"} | ({"Authorization": f"Bearer {key}"} if key else {})
    with urllib.request.urlopen(urllib.request.Request(url, json.dumps(body).encode(), headers), timeout=timeout) as answer:
        return json.load(answer)


def encoded(image: bytes) -> str:
    return base64.b64encode(bytes(image)).decode()


def base64_of(image: Column) -> Column:
    """The same inside a plan, without line ends."""
    return F.translate(F.base64(image), "\r\n", "")


@dataclass(frozen=True)
class Vlm:
    """A chat-completions service that is shown an image: rows with `image` and `prompt` -> texts."""

    url: str
    key: str | None = None
    model: str | None = None
    timeout: float = 60
    max_tokens: int = 16384
    temperature: float = 0.1
    top_p: float = 0.9
    repetition_penalty: float | None = 1.15
    prefix: str = ""
    send: Callable = post

    def body(self, image: bytes, prompt: str) -> dict:
        shown = [{"type": "image_url", "image_url": {"url": f"data:image/png;base64,{encoded(image)}"}}, {"type": "text", "text": self.prefix + prompt}]
        optional = {"model": self.model, "repetition_penalty": self.repetition_penalty}
        return {"messages": [{"role": "user", "content": shown}], "max_completion_tokens": self.max_tokens, "temperature": self.temperature, "top_p": self.top_p} | {k: v for k, v in optional.items() if v is not None}

    def text(self, image: bytes, prompt: str) -> str:
        """A server that doesn't know max_completion_tokens answers 400 and is asked once more in older terms."""
        body = self.body(image, prompt)
        try:
            answer = self.send(self.url, body, self.timeout, self.key)
        except urllib.error.HTTPError as e:
            if e.code != 400:
                raise
            answer = self.send(self.url, {("max_tokens" if k == "max_completion_tokens" else k): v for k, v in body.items()}, self.timeout, self.key)
        return answer["choices"][0]["message"]["content"]

    def __call__(self) -> Answers:
        return lambda rows: [self.text(r["image"], r["prompt"]) for r in rows]


@dataclass(frozen=True)
class Detector:
    """Rows with `image` -> lists of label, confidence, l, t, r, b in pixels."""

    url: str
    timeout: float = 60
    send: Callable = post

    def __call__(self) -> Answers:
        return lambda rows: [self.send(f"{self.url.rstrip('/')}/detect", {"images": [encoded(r["image"])]}, self.timeout)["results"][0] for r in rows]


@dataclass(frozen=True)
class Ocr:
    """Rows with `image` -> lists of text and box in pixels; the shortest of texts, scores and boxes counts."""

    url: str
    timeout: float = 60
    send: Callable = post

    def __call__(self) -> Answers:
        def page(image: bytes) -> list[dict]:
            found = self.send(f"{self.url.rstrip('/')}/ocr", {"file": encoded(image), "fileType": 1, "visualize": False}, self.timeout)["result"]["ocrResults"][0]["prunedResult"]
            return [{"text": t, "box": list(b)} for t, _, b in zip(*(found.get(k, []) for k in ("rec_texts", "rec_scores", "rec_boxes")), strict=False)]

        return lambda rows: [page(r["image"]) for r in rows]


@dataclass(frozen=True)
class Structure:
    """Rows with `image`, `boxes` and `tokens` in pixels -> for each box num_rows, num_cols and cells."""

    url: str
    timeout: float = 60
    send: Callable = post

    def __call__(self) -> Answers:
        return lambda rows: [self.send(f"{self.url.rstrip('/')}/structure", {"images": [encoded(r["image"])], "tables": [r["boxes"]], "tokens": [r["tokens"]]}, self.timeout)["results"][0] for r in rows]


# --- the calls ----------------------------------------------------------------------------------------


def answered(rows: DataFrame, client: Client, into: Callable[[dict, object], list[dict]], schema: str) -> DataFrame:
    """The rows that into(row, answer) gives for each row of `rows`; the client is made once in each task.

    They are written: a service is asked once about a row, however often its answers are read.
    """
    names = [f.name for f in rows.sparkSession.createDataFrame([], schema).schema]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = client()
        for batch in batches:
            asked = batch.to_dict("records")
            if out := [x for r, a in zip(asked, call(asked), strict=True) for x in into(r, a)]:
                yield pd.DataFrame(out, columns=names)

    return written(rows.mapInPandas(run, schema), "answers")


def shown(pages: DataFrame) -> DataFrame:
    return pages.where("image is not null").select("doc_id", F.col("page").cast("int").alias("page"), "image")


def detect(pages: DataFrame, client: Client, dpi: int = DPI) -> DataFrame:
    """Regions that a detector finds, in points and in the order of its answer."""
    into = lambda r, found: [{"doc_id": r["doc_id"], "page": r["page"], "region_no": i, "label": x["label"], "confidence": float(x["confidence"])} | {k: float(x[k]) for k in "ltrb"} for i, x in enumerate(found)]
    found = answered(shown(pages), client, into, REGION)
    return found.select("doc_id", "page", "region_no", F.col("label").alias("category"), "confidence", *[layout.rescale(F.col(k), dpi).alias(k) for k in "ltrb"])


def ocr_lines(pages: DataFrame, client: Client, dpi: int = DPI) -> DataFrame:
    """Lines that OCR reads, in points; font_size is 0."""
    into = lambda r, found: [{"doc_id": r["doc_id"], "page": r["page"], "seq": i, "text": x["text"]} | dict(zip("ltrb", map(float, x["box"]), strict=True)) for i, x in enumerate(found)]
    found = answered(shown(pages), client, into, f"doc_id bigint, page int, seq int, text string, {BOX}")
    box = F.struct(*[layout.rescale(F.col(k), dpi).alias(n) for k, n in zip("ltrb", ("x0", "y0", "x1", "y1"), strict=True)])
    return found.select("doc_id", "page", "seq", "text", box.alias("bbox"), F.lit(0.0).alias("font_size"))


def read_text(rows: DataFrame, client: Client, keys: list[str]) -> DataFrame:
    """`keys` and `answer`, what a VLM says to the image and prompt of each row."""
    schema = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys)
    return answered(rows.select(*keys, "image", "prompt"), client, lambda r, a: [{k: r[k] for k in keys} | {"answer": a}], f"{schema}, answer string")


def png_size(image: Column) -> Column:
    """(width, height) of a PNG by its header, else null."""
    number = lambda at: F.conv(F.hex(F.substring(image, at, 4)), 16, 10).cast("double")
    png = (F.hex(F.substring(image, 1, 8)) == "89504E470D0A1A0A") & (F.length(image) >= 24)
    return F.when(png, F.struct(number(17).alias("width"), number(21).alias("height")))


def vlm_regions(pages: DataFrame, client: Client, prompt: str = LAYOUT_PROMPT, dpi: int = DPI) -> DataFrame:
    """Regions that a VLM finds: category, text, l, t, r, b in points, and rl, rt, rr, rb as the model gave them.

    The model sees the page resized, so its pixels are brought to those of the image and then to points. Both boxes are
    in one row: what the model is asked about a region later needs its own pixels. A page whose shape no resize allows has no regions.
    """
    asked = shown(pages).withColumn("prompt", F.lit(prompt))
    found = read_text(asked, client, ["doc_id", "page"]).select("doc_id", "page", F.posexplode(layout.parse_regions(F.col("answer"))).alias("region_no", "x"))
    size = png_size(F.col("image"))
    resized = layout.smart_resize(F.col("size.height"), F.col("size.width"))
    sizes = shown(pages).select("doc_id", "page", size.alias("size")).withColumn("seen", resized)
    sizes = sizes.where("size is null or seen is not null").select("doc_id", "page", F.coalesce(F.col("seen.width") / F.col("size.width"), F.lit(1.0)).alias("sx"), F.coalesce(F.col("seen.height") / F.col("size.height"), F.lit(1.0)).alias("sy"))
    raw = [F.get("x.bbox", i).alias(f"r{k}") for i, k in enumerate("ltrb")]
    rows = found.select("doc_id", "page", "region_no", F.col("x.category").alias("label"), F.col("x.text").alias("text"), *raw).join(sizes, ["doc_id", "page"])
    points = [(F.col(f"r{k}") / (F.col("sx" if k in "lr" else "sy") * (dpi / 72))).alias(k) for k in "ltrb"]
    return rows.select("doc_id", "page", "region_no", to_category(F.col("label")).alias("category"), "text", *points, "rl", "rt", "rr", "rb")


def grounded(regions: DataFrame, pages: DataFrame, client: Client) -> DataFrame:
    """regions with `answer`, the stripped text that a VLM reads in each region's box."""
    keys = ["doc_id", "page", "region_no"]
    prompt = F.concat(F.lit(GROUNDING_PROMPT), layout.grounding_box(F.col("rl"), F.col("rt"), F.col("rr"), F.col("rb")))
    asked = regions.select(*keys, prompt.alias("prompt")).join(shown(pages), ["doc_id", "page"])
    return regions.join(read_text(asked, client, keys).withColumn("answer", strip(F.col("answer"))), keys, "left")


# --- strategies ---------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Clients:
    detector: Client | None = None
    vlm: Client | None = None
    ocr: Client | None = None
    structure: Client | None = None
    dpi: int = DPI

    def of(self, name: str) -> Client:
        found = getattr(self, name)
        if found is None:
            raise ValueError(f"this layout needs a client for {name}")
        return found


def _box(*names: str) -> Column:
    return F.struct(*[F.col(n).cast("double").alias(k) for n, k in zip(names, ("x0", "y0", "x1", "y1"), strict=True)]).alias("bbox")


def _categories(lines: DataFrame, matched: DataFrame) -> DataFrame:
    return matched.select(*lines.columns, F.coalesce("region", F.lit("text")).alias("category"))


def _named(regions: DataFrame) -> DataFrame:
    """regions with their category as `region`, which a match carries to the lines."""
    return regions.withColumn("region", F.col("category"))


def _without_category(lines: DataFrame) -> DataFrame:
    return lines.drop("category")


def rule(lines: DataFrame, pages: DataFrame, words: DataFrame | None, clients: Clients) -> DataFrame:
    return layout.rule_layout(_without_category(lines))


def detector(lines: DataFrame, pages: DataFrame, words: DataFrame | None, clients: Clients) -> DataFrame:
    """Categories of the detected region that covers most of each line. With a structure service, tables become one item each."""
    lines = _without_category(lines)
    found = detect(pages, clients.of("detector"), clients.dpi)
    size = png_size(F.col("image"))
    area = shown(pages).select("doc_id", "page", (layout.rescale(size["width"], clients.dpi) * layout.rescale(size["height"], clients.dpi)).alias("__area"))
    kept = layout.filter_regions(found).join(area, ["doc_id", "page"]).where(~F.coalesce((F.col("category") == "picture") & ((F.col("r") - F.col("l")) * (F.col("b") - F.col("t")) > layout.FULL_PAGE * F.col("__area")), F.lit(False))).drop("__area")
    regions = layout.remove_overlaps(kept)
    if clients.structure is None:
        return _categories(lines, layout.match_overlap(lines, _named(regions), ("region",)))
    html = table_html(regions, pages, words if words is not None else layout.word_tokens(lines).select("doc_id", "page", "id", F.col("token").alias("text"), _box("l", "t", "r", "b")), clients)
    return layout.table_items(layout.match_overlap(lines, regions), regions, html).withColumn("font_size", F.lit(None).cast("double"))


def table_html(regions: DataFrame, pages: DataFrame, words: DataFrame, clients: Clients) -> DataFrame:
    """(doc_id, page, region_no, html) of the table regions, by one call of the structure service for each page."""
    scale = clients.dpi / 72
    pixels = lambda *c: F.array(*[F.col(x) * scale for x in c])
    boxes = regions.where("category = 'table'").groupBy("doc_id", "page").agg(F.sort_array(F.collect_list(F.struct("region_no", pixels("l", "t", "r", "b").alias("box")))).alias("tables"))
    tokens = words.groupBy("doc_id", "page").agg(F.sort_array(F.collect_list(F.struct("id", "text", pixels("bbox.x0", "bbox.y0", "bbox.x1", "bbox.y1").alias("bbox")))).alias("tokens"))
    asked = boxes.join(shown(pages), ["doc_id", "page"]).join(tokens, ["doc_id", "page"], "left").select("doc_id", "page", "image", F.col("tables.region_no").alias("numbers"), F.col("tables.box").alias("boxes"), "tokens")
    def client() -> Answers:
        call = clients.of("structure")()
        token = lambda t: {"id": int(t["id"]), "text": t["text"], "bbox": list(map(float, t["bbox"]))}
        return lambda rows: call([r | {"boxes": [list(map(float, b)) for b in r["boxes"]], "tokens": [token(t) for t in ([] if r["tokens"] is None else r["tokens"])]} for r in rows])

    def into(r: dict, found: list[dict]) -> list[dict]:
        cell = lambda c: {k: c.get(k) for k in ("start_row_offset_idx", "start_col_offset_idx", "row_span", "col_span", "column_header")} | {"text_cell_bboxes": [{"t": float(t["t"]), "l": float(t["l"]), "token": t["token"]} for t in c.get("text_cell_bboxes") or []]}
        return [{"doc_id": r["doc_id"], "page": r["page"], "region_no": int(n), "num_rows": s["num_rows"], "num_cols": s["num_cols"], "cells": [cell(c) for c in s["cells"]]} for n, s in zip(r["numbers"], found, strict=False)]

    built = answered(asked, client, into, f"doc_id bigint, page int, region_no int, num_rows int, num_cols int, cells array<{CELL}>")
    table = F.struct("doc_id", "page", "region_no")
    return tables.structure_html(built.select(table.alias("table_id"), "num_rows", "num_cols", "cells")).select("table_id.*", "html")


def vlm(lines: DataFrame, pages: DataFrame, words: DataFrame | None, clients: Clients) -> DataFrame:
    """Categories of the smallest region of a VLM that holds each line's centre."""
    lines = _without_category(lines)
    regions = vlm_regions(pages, clients.of("vlm"), LAYOUT_PROMPT, clients.dpi)
    return _categories(lines, layout.match_center(lines, _named(regions), ("region",)))


def _region_items(regions: DataFrame, text: Column) -> DataFrame:
    rows = regions.withColumn("text", strip(F.coalesce(text, F.lit("")))).where("text <> ''")
    return rows.select("doc_id", "page", F.col("region_no").alias("seq"), "text", _box("l", "t", "r", "b"), F.lit(None).cast("double").alias("font_size"), "category")


def vlm_all(lines: DataFrame, pages: DataFrame, words: DataFrame | None, clients: Clients) -> DataFrame:
    """The regions' own texts as items; the lines don't count."""
    return _region_items(vlm_regions(pages, clients.of("vlm"), ALL_PROMPT, clients.dpi), F.col("text"))


def vlm_grounding(lines: DataFrame, pages: DataFrame, words: DataFrame | None, clients: Clients) -> DataFrame:
    """The text of each region but pictures, by a call of its own: calls for one page run in parallel."""
    regions = vlm_regions(pages, clients.of("vlm"), LAYOUT_PROMPT, clients.dpi).where("category <> 'picture'")
    return _region_items(grounded(regions, pages, clients.of("vlm")), F.col("answer"))


def vlm_auto(lines: DataFrame, pages: DataFrame, words: DataFrame | None, clients: Clients) -> DataFrame:
    """As vlm(); only damaged lines inside a region are read again, from their region's box."""
    lines = _without_category(lines)
    regions = vlm_regions(pages, clients.of("vlm"), LAYOUT_PROMPT, clients.dpi)
    matched = written(layout.match_center(lines, _named(regions), ("region",)), "matched")
    damaged = matched.where(corrupted(F.col("text")) & F.col("region_no").isNotNull()).select("doc_id", "page", "region_no").distinct()
    again = grounded(regions.join(damaged, ["doc_id", "page", "region_no"], "left_semi"), pages, clients.of("vlm")).select("doc_id", "page", "region_no", "answer")
    rows = matched.join(again, ["doc_id", "page", "region_no"], "left")
    text = F.when(corrupted(F.col("text")), F.coalesce(F.nullif("answer", F.lit("")), F.col("text"))).otherwise(F.col("text"))
    return rows.select(*[text.alias("text") if c == "text" else F.col(c) for c in lines.columns], F.coalesce("region", F.lit("text")).alias("category"))


@dataclass(frozen=True)
class Strategy:
    """What a layout needs of a page, and whether it gives items of its own (which keep their order)."""

    apply: Callable
    needs_image: bool = False
    needs_words: bool = False
    produces_items: bool = False


STRATEGIES = {
    "rule": Strategy(rule),
    "detector": Strategy(detector, needs_image=True, needs_words=True),
    "vlm": Strategy(vlm, needs_image=True),
    "vlm_all": Strategy(vlm_all, needs_image=True, produces_items=True),
    "vlm_grounding": Strategy(vlm_grounding, needs_image=True, produces_items=True),
    "vlm_auto": Strategy(vlm_auto, needs_image=True, produces_items=True),
}


def strategy(name: str, clients: Clients | None = None) -> Strategy:
    """The strategy of that name, `rule` if there is none. A detector with a structure service gives items."""
    found = STRATEGIES.get(name, STRATEGIES["rule"])
    if found.apply is detector and clients is not None and clients.structure is not None:
        return Strategy(detector, needs_image=True, needs_words=True, produces_items=True)
    return found
