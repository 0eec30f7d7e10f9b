"""Schemas of the intermediate relations, and the legal categories."""

from __future__ import annotations

#: The legal categories of items.
CATEGORIES = (
    "caption", "chart", "footnote", "formula", "list_item", "page_footer", "page_header", "picture", "section_header", "table",
    "text", "title", "document_index", "code", "checkbox_selected", "checkbox_unselected", "form", "key_value_region", "grading_scale", "handwritten_text",
    "empty_value", "paragraph", "reference", "field_region", "field_heading", "field_item", "field_key", "field_value", "field_hint", "marker",
)
HEADER = "section_header"
FLOW = ("text", "section_header", "title", "list_item")

BBOX = "struct<x0: double, y0: double, x1: double, y1: double>"
ITEM = f"doc_id bigint, seq int, page int, category string, text string, bbox {BBOX}"
