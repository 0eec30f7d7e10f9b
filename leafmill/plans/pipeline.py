"""The document pipeline: load, preprocess, enrich, chunk, postprocess, enrich, records.

Each step is a DataFrame plan, so asking for an earlier level runs nothing that comes after it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafmill.functions.text import bad_chars, corrupted, garbled, normalize_typography
from leafmill.operators import chunk, clean, metadata, models, order
from leafmill.sources import files

LEVELS = ("loader", "chunker", "postprocess", "build_metadata")
Hook = Callable[[DataFrame], DataFrame]
OCR_MODES = ("auto", "force", "disable")


@dataclass(frozen=True)
class Config:
    """layout: a name of models.STRATEGIES, any other is `rule`; ocr: one of OCR_MODES, any other is `auto`; clients: the services these call."""

    chunker: str = "smart"
    chunk_size: int = 1000
    over_lap: int = 100
    max_page_split: int = 50
    layout: str = "rule"
    ocr: str = "auto"
    clients: models.Clients = field(default_factory=models.Clients)
    reorder: bool = True
    return_level: str = "build_metadata"
    reg_date: str | None = None
    preprocess: tuple[Hook, ...] = ()
    pre_enrich: tuple[Hook, ...] = ()
    postprocess: tuple[Hook, ...] = ()
    post_enrich: tuple[Hook, ...] = ()
    chunkers: dict[str, Callable] = field(default_factory=dict)
    metadata: Callable[[DataFrame], DataFrame] | None = None

    @staticmethod
    def merged(*parts: dict) -> Config:
        """Later parts win."""
        values: dict = {}
        for p in parts:
            values |= p
        return Config(**values)


def needs_ocr(lines: DataFrame, pages: DataFrame, mode: str = "auto") -> DataFrame:
    """pages (doc_id, page) with `ocr`: never, always, or where there are no lines or the glyphs are damaged."""
    damaged = lines.groupBy("doc_id", "page").agg((F.max(garbled(F.col("text"))) | (F.sum(bad_chars(F.col("text"))) > 3)).alias("damaged"))
    auto = pages.join(damaged, ["doc_id", "page"], "left").withColumn("ocr", F.coalesce("damaged", F.lit(True)))
    rule = {"disable": F.lit(False), "force": F.lit(True)}.get(mode, F.col("ocr"))
    return auto.withColumn("ocr", rule).drop("damaged")


def apply_hooks(df: DataFrame, hooks: tuple[Hook, ...]) -> DataFrame:
    for hook in hooks:
        df = df.transform(hook)
    return df


def read_again(lines: DataFrame, pages: DataFrame, config: Config) -> tuple[DataFrame, DataFrame]:
    """lines with those of pages that the gate sends to OCR replaced by what it reads, and these pages (doc_id, page)."""
    shown = pages.where("image is not null")
    gate = needs_ocr(lines.select("doc_id", "page", "text"), shown.select("doc_id", "page"), config.ocr).where("ocr").select("doc_id", "page")
    read = models.ocr_lines(shown.join(gate, ["doc_id", "page"], "left_semi"), config.clients.of("ocr"), config.clients.dpi)
    return lines.join(gate, ["doc_id", "page"], "left_anti").select(*read.columns).unionByName(read), gate


def analysed(lines: DataFrame, pages: DataFrame, config: Config) -> DataFrame:
    """Items of lines without category, by OCR and the layout of config; flow lines in reading order where the layout keeps lines."""
    lines = lines.select("doc_id", "page", "seq", "text", "bbox", "font_size")
    strategy, words = models.strategy(config.layout, config.clients), None
    if strategy.needs_words and config.clients.structure is not None:
        words = files.words_of(pages)
    if config.ocr != "disable" and config.clients.ocr is not None:
        lines, again = read_again(lines, pages, config)
        if words is not None:  # words of such a page are those that OCR was to replace
            words = words.join(again, ["doc_id", "page"], "left_anti")
    if words is not None:  # pages without words of their own: their lines are cut
        cut = models.layout.word_tokens(lines.join(words.select("doc_id", "page").distinct(), ["doc_id", "page"], "left_anti"))
        words = words.unionByName(cut.select("doc_id", "page", "id", F.col("token").alias("text"), models._box("l", "t", "r", "b")))
    items = strategy.apply(lines, pages, words, config.clients).select("doc_id", "page", "seq", "category", "text", "bbox")
    if strategy.produces_items or not config.reorder:
        return items
    # Dummy boxes have no order of their own: only pages with geometry are put in order.
    shaped = items.withColumn("__shaped", F.max(F.col("bbox.x1") > F.col("bbox.x0")).over(Window.partitionBy("doc_id", "page")))
    moved = order.reading_order(shaped.where("__shaped").drop("__shaped")).withColumn("seq", F.col("position")).drop("position")
    return shaped.where("not coalesce(__shaped, false)").drop("__shaped").unionByName(moved)


def load(parsed: DataFrame, config: Config) -> DataFrame:
    """Items of parsed files: native categories as they are, the rest by OCR and layout, then cleaning per split.

    seq counts up over a document, page by page.
    """
    return load_lines(files.lines_of(parsed.where("error is null")), files.pages_of(parsed), config)


def load_lines(lines: DataFrame, pages: DataFrame, config: Config) -> DataFrame:
    """load() of lines and pages as they are, whatever parsed them."""
    columns = ["doc_id", "page", "seq", "category", "text", "bbox"]
    given = lines.where("category is not null").select(*columns)
    items = given.unionByName(analysed(lines.where("category is null"), pages, config)).withColumn("text", normalize_typography(F.col("text")))
    numbered = items.withColumn("seq", F.row_number().over(Window.partitionBy("doc_id").orderBy("page", "seq")) - 1)
    split = files.split_pages(numbered, config.max_page_split)
    return clean.merge_paragraphs(clean.strip_headers_footers(split.select("doc_id", "split_no", "seq", "page", "category", "text", "bbox")))


def run(items: DataFrame, config: Config | None = None, page_sizes: DataFrame | None = None) -> DataFrame:
    """The DataFrame of config.return_level for items."""
    config = config or Config()
    if config.return_level not in LEVELS:
        raise ValueError(f"return_level is one of {', '.join(LEVELS)}")
    chunkers = chunk.CHUNKERS | config.chunkers
    if config.chunker not in chunkers:
        raise ValueError(f"unknown chunker {config.chunker}")
    items = apply_hooks(apply_hooks(items, config.preprocess), config.pre_enrich)
    if config.return_level == "loader":
        return items
    # Boxes are collected only where a later step may read them.
    unread = config.return_level == "build_metadata" and page_sizes is None and not (config.metadata or config.postprocess or config.post_enrich)
    more = {"boxes": False} if unread and chunkers[config.chunker] is chunk.smart else {}
    chunks = chunkers[config.chunker](items, config.chunk_size, config.over_lap, **more)
    if config.return_level == "chunker":
        return chunks
    chunks = apply_hooks(apply_hooks(chunks, config.postprocess), config.post_enrich)
    if config.return_level == "postprocess":
        return chunks
    return config.metadata(chunks) if config.metadata else metadata.vectors(chunks, page_sizes, config.reg_date)


def process(spark: SparkSession, path: str, config: Config | None = None) -> DataFrame:
    """Records of the files under `path`; those of PDFs have their boxes as shares of the page."""
    config = config or Config()
    lines, pages = files.read_lines(spark, path, config.max_page_split)
    return run(load_lines(lines, pages, config), config, files.page_sizes(pages))


def fixed_pipeline(spark: SparkSession, path: str, size: int = 1000, overlap: int = 100) -> DataFrame:
    """A pipeline without configuration: rule layout, no OCR, sections, records."""
    return process(spark, path, Config(chunker="smart", chunk_size=size, over_lap=overlap, ocr="disable"))


def trim_and_drop(chunks: DataFrame) -> DataFrame:
    """A postprocess hook: stripped texts, empty ones dropped."""
    from leafmill.functions.text import strip

    return chunks.withColumn("text", strip(F.col("text"))).where("text <> ''")


def write_records(records: DataFrame, path: str, form: str = "json") -> None:
    records.write.mode("overwrite").format(form).save(path)


def dump(records: DataFrame) -> DataFrame:
    """(doc_id, json): the records of each document as one JSON object."""
    fields = [c for c in records.columns if c != "doc_id"]
    packed = F.sort_array(F.collect_list(F.struct("i_chunk_on_doc", F.struct(*fields).alias("v"))))
    return records.groupBy("doc_id").agg(F.to_json(F.struct(F.first("doc_id").alias("source"), F.transform(packed, lambda x: x["v"]).alias("vectors"))).alias("json"))


__all__ = ["Config", "corrupted", "dump", "load", "needs_ocr", "process", "run", "trim_and_drop", "write_records"]
