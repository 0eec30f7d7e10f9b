"""Stand-ins for model services: what they answer follows from the keys of a page, so SQL can say the same."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.operators.models import DPI, GROUNDING_PROMPT, Answers, Clients
from leafmill.plans import tables as D

LABELS = ("Text", "Title", "List-item", "Table", "Picture", "Code", "Strange label")
#: Pixels of the pages' images; a model sees them in SEEN.
WIDTH, HEIGHT = 1240, 1754
SEEN = (1232, 1764)
PNG = f"89504E470D0A1A0A0000000D49484452{WIDTH:08X}{HEIGHT:08X}"


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages of boxes_lines with the head of a PNG as image; page 5 has none."""
    found = D.boxes_lines(spark, sf_dir).select("doc_id", "page").distinct()
    return found.withColumn("image", F.when(F.col("page") < 5, F.unhex(F.lit(PNG))))


def boxes(doc_id: int, page: int) -> list[dict]:
    """Four upright strips side by side, in points."""
    return [{"label": LABELS[(doc_id + page + k) % 7], "confidence": (doc_id * 7 + page * 13 + k * 29) % 100 / 100, "l": 120.0 * k, "t": 0.0, "r": 120.0 * k + 110, "b": 700.0} for k in range(4)]


def detector() -> Answers:
    scale = DPI / 72
    return lambda rows: [[x | {k: x[k] * scale for k in "ltrb"} for x in boxes(r["doc_id"], r["page"])] for r in rows]


def ocr() -> Answers:
    return lambda rows: [[{"text": f"read {r['doc_id']} {k}", "box": [10.0 * k, 20.0 * k, 100.0, 20.0 * k + 15]} for k in range(r["page"])] for r in rows]


def vlm() -> Answers:
    """Regions in whole pixels as the model sees them; text in region k is `text k`, blank where k is 2; a box that is asked for is read aloud."""

    def answer(r: dict) -> str:
        if r["prompt"].startswith(GROUNDING_PROMPT):
            box = r["prompt"].removeprefix(GROUNDING_PROMPT)
            return "  " if box.startswith("[0,") else f" box {box} "
        return "```json\n" + json.dumps([{"bbox": [250 * k, 0, 250 * k + 230, 1500], "category": LABELS[(r["doc_id"] + r["page"] + k) % 7], "text": "" if k == 2 else f"text {k}"} for k in range(4)]) + "\n```"

    return lambda rows: [answer(r) for r in rows]


def structure() -> Answers:
    """Every table has one row: a cell over the number of tokens of the page and one that spans two columns."""
    token = lambda x: [{"t": 0.0, "l": 0.0, "token": x}]
    cell = lambda c, span, x: {"start_row_offset_idx": 0, "start_col_offset_idx": c, "row_span": 1, "col_span": span, "column_header": c == 0, "text_cell_bboxes": token(x)}
    return lambda rows: [[{"num_rows": 1, "num_cols": 3, "cells": [cell(0, 1, f"{len(r['tokens'])} tokens"), cell(1, 2, "a|b")]} for _ in r["boxes"]] for r in rows]


CLIENTS = Clients(detector=detector, vlm=vlm, ocr=ocr)
WITH_TABLES = Clients(detector=detector, vlm=vlm, ocr=ocr, structure=structure)
