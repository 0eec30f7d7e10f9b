"""Small literal cases of the document operators."""

import random
import time
import urllib.error
import uuid

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from leafmill.functions import text as T
from leafmill.operators import chunk, clean, layout, metadata, models, order
from leafmill.plans import pipeline, stubs
from leafmill.schemas import BBOX, ITEM
from leafmill.sources import files

SECTIONED = [("section_header", 1, "Harbour"), ("text", 1, "Ships lie at the east quay."), ("text", 2, "Cranes stand to the west."), ("section_header", 3, "Lighthouse"), ("text", 3, "It burns from dusk.")]


def items(spark, rows):
    return spark.createDataFrame([(1, i, p, c, t, (0.0, float(i), 9.0, float(i + 1))) for i, (c, p, t) in enumerate(rows)], ITEM)


def got(df):
    return [(r["text"], r["i_page"], r["e_page"]) for r in df.orderBy("chunk_no").collect()]


def test_hierarchical(spark):
    assert got(chunk.hierarchical(items(spark, SECTIONED))) == [("Harbour, Ships lie at the east quay.", 1, 1), ("Harbour, Cranes stand to the west.", 2, 2), ("Lighthouse, It burns from dusk.", 3, 3)]


def test_smart(spark):
    df = items(spark, SECTIONED)
    assert [x[1:] for x in got(chunk.smart(df, 0))] == [(1, 2), (3, 3)]
    pieces = got(chunk.smart(df, 10, 2))
    assert len(pieces) > 2 and {x[1:] for x in pieces} == {(1, 2), (3, 3)}
    assert got(chunk.smart(items(spark, [("section_header", 1, "Alone")]), 10, 0)) == [("Alone", 1, 1)]
    cut = chunk.smart(items(spark, [("section_header", 1, "H"), ("text", 1, "a" * 10), ("text", 1, "b" * 10)]), 10, 0).orderBy("chunk_no").collect()
    assert cut[0]["bboxes"][-1]["bbox"]["y0"] == 1 and cut[-1]["bboxes"][-1]["bbox"]["y0"] == 2


def test_hybrid(spark):
    df = items(spark, SECTIONED)
    assert [x[1:] for x in got(chunk.hybrid(df, 1000, 100))] == [(1, 2), (3, 3)]
    assert len(got(chunk.hybrid(df, 0))) == 3


def test_hybrid_groups_of_long_documents(spark):
    """Over a stride of items under one heading, headings that come again, a heading that is empty and items longer than a group."""
    pick = random.Random(9)
    rows = [("text", 1 + i // 50, "x" * pick.randrange(1, 60)) for i in range(3 * chunk.STRIDE + 5)]
    for i in (3, 4, 300, 301, 305, 600):
        rows.insert(i, ("section_header", 7, pick.choice(["H", "H", ""])))
    heading, want, held = None, [], None
    for c, p, t in rows:
        if c == "section_header":
            heading = t
        elif held and held[0] == heading and held[1] + 1 + len(t) <= 50:
            held[1] += 1 + len(t)
            held[2].append((t, p))
        else:
            held = [heading, len(t), [(t, p)]]
            want.append(held)
    found = got(chunk.hybrid(items(spark, rows), 50, 10))
    texts = [(h, "\n".join(t for t, _ in g), min(p for _, p in g), max(p for _, p in g)) for h, _, g in want]
    flat = []
    for h, body, a, b in texts:
        whole = ", ".join(x for x in (h, body) if x)
        cuts = [body] if len(whole) <= 50 else [body[s : s + 50] for s in range(0, max(1, len(body) - 10), 40)]
        flat += [(", ".join(x for x in (h, c) if x), a, b) for c in cuts]
    assert found == flat


def test_smart_without_boxes(spark):
    df = items(spark, SECTIONED)
    for size in (0, 10):
        assert got(chunk.smart(df, size, 2, boxes=False)) == got(chunk.smart(df, size, 2))


def test_windows_that_never_end_are_refused(spark):
    with pytest.raises(ValueError):
        chunk.smart(items(spark, SECTIONED), 10, 10).collect()


def test_headers_and_footers(spark):
    rows = [(1, p * 10 + k, p, "text", t, (0.0, y, 9.0, y + 8)) for p in range(1, 6) for k, (t, y) in enumerate([("Head", 0.0), (f"body {p}", 20.0), (f"more {p}x", 100.0), (f"Page {p} of 5", 290.0)])]
    kept = clean.strip_headers_footers(spark.createDataFrame(rows, ITEM)).collect()
    assert {r["text"].split()[0] for r in kept} == {"body", "more"}
    few = clean.strip_headers_footers(spark.createDataFrame([r for r in rows if r[2] < 3], ITEM))
    assert few.count() == 8


def test_paragraphs(spark):
    merge = lambda *rows: [r["text"] for r in clean.merge_paragraphs(items(spark, rows)).orderBy("seq").collect()]
    assert merge(("text", 1, "gulls nest on the break-"), ("text", 2, "water in spring.")) == ["gulls nest on the breakwater in spring."]
    assert merge(("text", 1, "when the tide is out,"), ("text", 1, "boats rest on mud.")) == ["when the tide is out, boats rest on mud."]
    assert len(merge(("text", 1, "Nets dry."), ("text", 1, "ropes too"))) == 2
    assert len(merge(("text", 1, "a depth of"), ("formula", 1, "d = 3t"), ("text", 1, "is enough"))) == 3


def read(boxes):
    return list(order.read_along(np.array(boxes, float).reshape(-1, 4).T))


def test_reading_order():
    banner, east, west = (5, 1, 305, 21), [(165, 30, 300, 44), (165, 50, 300, 64), (165, 70, 290, 84)], [(5, 31, 150, 45), (5, 52, 140, 66)]
    assert read([*east, banner, *west]) == [3, 0, 1, 2, 4, 5]
    assert read([banner, *[(a, b + 2, c, d + 2) for a, b, c, d in east], *west]) == [0, 4, 5, 1, 2, 3]
    assert read([(0, 0, 0, 0)] * 3) == [0, 1, 2] and read([]) == [] and read([(0, 0, 1, 1)]) == [0]
    assert read([(5, 100, 305, 120), *east[:2], *[(5, a[1], 150, a[3]) for a in east[:2]]]) == [3, 4, 1, 2, 0]


def links_one_by_one(boxes):
    wide = lambda a, b: a[0] < b[2] and b[0] < a[2]
    n = range(len(boxes))
    return {(i, j) for i in n for j in n if i != j and boxes[i][3] <= boxes[j][1] and wide(boxes[i], boxes[j]) and not any(k not in (i, j) and boxes[i][3] <= c[1] and c[3] <= boxes[j][1] and (wide(boxes[i], c) or wide(boxes[j], c)) for k, c in enumerate(boxes))}


@pytest.mark.parametrize("solid", [True, False])
def test_links_of_lines(solid):
    """The sweep and the comparison of all pairs against the rule itself; without `solid` some lines have no width or height, or less."""
    pick = random.Random(4)
    for _ in range(300):
        boxes = []
        for _ in range(pick.randrange(1, 14)):
            x, y = pick.randrange(12), pick.randrange(12)
            boxes.append((x, y, x + (pick.randrange(1, 6) if solid else pick.randrange(-1, 5)), y + (pick.randrange(1, 4) if solid else pick.randrange(-1, 3))))
        sides = np.array(boxes, float).T
        want = links_one_by_one(boxes)
        for way in [order.links, *([order.swept] if solid else []), order.compared]:
            found = list(zip(*(x.tolist() for x in (way(sides) if way is order.links else way(*sides))), strict=True))
            assert len(found) == len(set(found)) and set(found) == want


def test_long_pages_are_read(spark):
    """Ten thousand lines of a page in fifty columns, shuffled: columns are read from left to right; a note follows the line before it."""
    schema = f"doc_id bigint, page int, seq int, category string, bbox {BBOX}"
    boxes = [(20.0 * c, 10.0 * r, 20.0 * c + 15, 10.0 * r + 8) for c in range(50) for r in range(200)]
    place = list(range(len(boxes)))
    random.Random(1).shuffle(place)
    rows = [(1, 1, 2 * i, "text", boxes[p]) for i, p in enumerate(place)] + [(1, 1, 2 * i + 1, "footnote", boxes[0]) for i in range(0, len(place), 500)]
    found = {r["seq"]: r["position"] for r in order.reading_order(spark.createDataFrame(rows, schema)).select("seq", "position").collect()}
    assert sorted(found.values()) == list(range(len(rows)))
    assert [place[s // 2] for s in sorted((s for s in found if s % 2 == 0), key=found.get)] == list(range(len(boxes)))
    assert all(found[s] == found[s - 1] + 1 for s in found if s % 2)


def test_pages_keep_what_cannot_move(spark):
    schema = f"doc_id bigint, page int, seq int, category string, bbox {BBOX}"
    rows = [(1, 1, 0, "page_header", (0.0, 0.0, 90.0, 8.0)), (1, 1, 1, "text", (0.0, 40.0, 90.0, 50.0)), (1, 1, 2, "formula", (0.0, 0.0, 0.0, 0.0)), (1, 1, 3, "title", (0.0, 20.0, 90.0, 30.0)), (1, 2, 0, "formula", (0.0, 9.0, 1.0, 10.0)), (1, 2, 1, "text", (0.0, 0.0, 1.0, 1.0))]
    found = order.reading_order(spark.createDataFrame(rows, schema)).orderBy("page", "position").collect()
    assert [(r["page"], r["seq"]) for r in found] == [(1, 0), (1, 3), (1, 1), (1, 2), (2, 0), (2, 1)]


REGION = "doc_id bigint, page int, region_no int, category string, confidence double, l double, t double, r double, b double"


def scattered(n, seed, wide=60.0, side=1000.0, large=0.02):
    """Boxes of a page, some of them as large as the page, some without area."""
    pick = random.Random(seed)
    out = []
    for i in range(n):
        l, t = pick.uniform(-50, side), pick.uniform(-50, side)
        w, h = (side, side) if pick.random() < large else (0.0, 5.0) if pick.random() < 0.05 else (pick.uniform(1, wide), pick.uniform(1, wide))
        out.append((1, 1 + i % 2, i, pick.choice(["text", "table", "picture", "code", "list_item"]), round(pick.random(), 2), l, t, l + w, t + h))
    return out


def test_boxes_that_share_area(spark):
    """Each pair once, by the grid, against all pairs; boxes beyond the grid's ends and of all sizes."""
    from leafmill.operators import grid

    a, b = scattered(150, 1), scattered(150, 2) + [(1, 1, 900, "text", 0.5, -1e9, -1e9, 1e9, 1e9), (1, 2, 901, "text", 0.5, 1e6, 1e6, 1e6 + 9, 1e6 + 9)]
    a += [(1, 2, 902, "text", 0.5, 1e6 + 4, 1e6 + 4, 2e6, 2e6), (1, 1, 903, "text", None, None, 0.0, 1.0, 1.0)]
    left, right = spark.createDataFrame(a, REGION), spark.createDataFrame(b, REGION)
    found = [(r["a"]["region_no"], r["b"]["region_no"]) for r in grid.sharing(left, right, ["doc_id", "page"]).collect()]
    solid = lambda x: x[5] is not None and x[7] > x[5] and x[8] > x[6]
    want = {(x[2], y[2]) for x in a for y in b if solid(x) and solid(y) and x[1] == y[1] and x[5] < y[7] and y[5] < x[7] and x[6] < y[8] and y[6] < x[8]}
    assert len(found) == len(set(found)) and set(found) == want
    points = spark.createDataFrame([(1, x[1], x[2], x[5], x[6]) for x in a if x[5] is not None], "doc_id bigint, page int, seq int, x double, y double")
    held = [(r["a"]["seq"], r["b"]["region_no"]) for r in grid.holding(points, right, ["doc_id", "page"]).collect()]
    assert len(held) == len(set(held)) and set(held) == {(x[2], y[2]) for x in a for y in b if x[5] is not None and x[1] == y[1] and y[5] <= x[5] <= y[7] and y[6] <= x[6] <= y[8]}


def test_candidates_follow_the_boxes_not_their_square(spark):
    """With as many boxes on as much paper, four times the boxes meet about four times as often."""
    from leafmill.operators import grid

    def met(n, side):
        df = spark.createDataFrame(scattered(n, 3, side=side, large=0.0), REGION)
        return grid.placed(df.where("r > l and b > t"), ["doc_id", "page"], "a").where("level = a.own").join(grid.placed(df.where("r > l and b > t"), ["doc_id", "page"], "b"), ["doc_id", "page", "level", "cx", "cy"]).count()

    assert met(2000, 2000.0) < 6 * met(500, 1000.0)


def test_overlapping_regions(spark):
    schema = "doc_id bigint, page int, region_no int, category string, confidence double, l double, t double, r double, b double"
    rows = [(1, 1, 0, "text", 0.9, 0.0, 0.0, 100.0, 10.0), (1, 1, 1, "list_item", 0.88, 0.0, 0.0, 101.0, 10.0), (1, 1, 2, "picture", 0.9, 0.0, 0.0, 100.0, 10.0), (1, 1, 3, "text", 0.9, 0.0, 50.0, 10.0, 60.0)]
    kept = layout.remove_overlaps(spark.createDataFrame(rows, schema)).collect()
    assert {r["region_no"] for r in kept} == {1, 2, 3}


def test_large_pages_lose_their_overlaps(spark):
    """Ten thousand regions of a page in clusters of four, and a chain of boxes that only touch their neighbours."""
    rows = [(1, 1, 4 * k + i, "text", 0.9 - 0.1 * i, 30.0 * (k % 100), 30.0 * (k // 100), 30.0 * (k % 100) + 20 + 0.1 * i, 30.0 * (k // 100) + 20) for k in range(2500) for i in range(4)]
    rows += [(1, 2, i, "text", 0.5 + i / 1024, 1.0 * i, 0.0, 1.0 * i + 20, 10.0) for i in range(60)]
    kept = layout.remove_overlaps(spark.createDataFrame(rows, REGION)).collect()
    assert {r["region_no"] for r in kept if r["page"] == 1} == {4 * k for k in range(2500)}
    # All are as large, so each gives way to one that is surer by over 0.05; of the last ones none is larger than the first of them.
    assert {r["region_no"] for r in kept if r["page"] == 2} == {8}


def test_words(spark):
    schema = f"doc_id bigint, page int, seq int, text string, bbox {BBOX}"
    out = layout.word_tokens(spark.createDataFrame([(1, 1, 0, "x yz", (0.0, 0.0, 60.0, 8.0))], schema)).orderBy("id").collect()
    assert [r["token"] for r in out] == ["x", "yz"] and abs((out[1]["r"] - out[1]["l"]) / (out[0]["r"] - out[0]["l"]) - 2) < 1e-9


def test_text_rules(spark):
    df = spark.createDataFrame([("a⁄b ‘x’ •", "a\nb\r\nc", " a b　")], "a string, b string, c string")
    r = df.select(T.normalize_typography(F.col("a")).alias("a"), T.n_lines(F.col("b")).alias("b"), T.n_words(F.col("c")).alias("c"), T.strip(F.col("c")).alias("d")).first()
    assert tuple(r) == ("a/b 'x' ·", 3, 2, "a b")


def test_records(spark):
    chunks = spark.createDataFrame([(1, 0, "tide table", 1, 1), (1, 1, "low water", 1, 1), (1, 2, "high water\nat noon", 2, 3)], "doc_id bigint, chunk_no int, text string, i_page int, e_page int").withColumn("bboxes", F.lit(None).cast(f"array<{chunk.ENTRY}>"))
    rows = metadata.vectors(chunks, reg_date="x").orderBy("i_chunk_on_doc").collect()
    assert [r["i_chunk_on_page"] for r in rows] == [0, 1, 0] and [r["n_chunk_of_page"] for r in rows] == [2, 2, 1]
    assert rows[0]["n_chunk_of_doc"] == 3 and rows[0]["n_page"] == 3 and (rows[2]["n_words"], rows[2]["n_lines"]) == (4, 2)


def test_levels(spark):
    with pytest.raises(ValueError):
        pipeline.run(items(spark, SECTIONED), pipeline.Config(return_level="nothing"))
    assert pipeline.Config.merged({"chunk_size": 5}, {"chunk_size": 7}).chunk_size == 7


def test_records_are_written_as_json(spark, tmp_path):
    records = pipeline.run(items(spark, SECTIONED), pipeline.Config(reg_date="x"))
    pipeline.write_records(records, str(tmp_path / "out"))
    assert sorted(r["text"] for r in spark.read.json(str(tmp_path / "out")).collect()) == sorted(r["text"] for r in records.collect())


def test_paragraphs_keep_to_their_page_order(spark):
    """Lines whose numbers begin anew on each page are told apart by the page."""
    rows = [(1, i, p, "text", f"Berth {p}{i}.", (0.0, 10.0 * i, 9.0, 10.0 * i + 5)) for p in (2, 1) for i in range(3)]
    merged = clean.merge_paragraphs(spark.createDataFrame(rows, ITEM)).orderBy("page", "seq").collect()
    assert [r["text"] for r in merged] == [f"Berth {p}{i}." for p in (1, 2) for i in range(3)]


def test_load_keeps_pages_apart(spark):
    lines = [(i, p, None, f"Berth {p}{i}.", (0.0, 20.0 * i, 90.0, 20.0 * i + 10), 10.0) for p in (1, 2) for i in range(3)]
    schema = f"key bigint, path string, {files.LINES}, {files.PAGES}"
    parsed = spark.createDataFrame([(5, "a.pdf", "pdf", None, lines, [])], schema)
    assert [r["text"] for r in pipeline.load(parsed, pipeline.Config()).orderBy("seq").collect()] == [f"Berth {p}{i}." for p in (1, 2) for i in range(3)]


def test_scanned_pages_are_read(spark):
    """An image without lines goes to OCR unless it is disabled; without a client nothing is asked."""
    png = stubs.PNG
    parsed = files.parse(spark.createDataFrame([(3, "scan", bytes.fromhex(png))], "key bigint, path string, content binary"))
    texts = lambda **more: [r["text"] for r in pipeline.load(parsed, pipeline.Config(**more)).orderBy("seq").collect()]
    assert texts(clients=stubs.CLIENTS) == ["read 3 0"]
    assert texts(clients=stubs.CLIENTS, ocr="disable") == [] == texts()
    assert texts(clients=stubs.CLIENTS, ocr="disable", layout="vlm_all") == ["text 0", "text 1", "text 3"]
    with pytest.raises(ValueError):
        texts(layout="vlm_all")


def test_clients_of_services():
    sent = []

    def send(url, body, timeout, key=None):
        sent.append((url, body, key))
        if "max_completion_tokens" in body:
            raise urllib.error.HTTPError(url, 400, "", None, None)
        found = {"rec_texts": ["a", "b"], "rec_scores": [1.0], "rec_boxes": [[0, 0, 1, 1], [1, 1, 2, 2]]}
        return {"choices": [{"message": {"content": "said"}}], "results": [[{"label": "Text"}]], "result": {"ocrResults": [{"prunedResult": found}]}}

    assert models.Vlm("u", key="k", model="m", send=send)()([{"image": b"x", "prompt": "p"}]) == ["said"]
    first, second = sent[0][1], sent[1][1]
    assert first.pop("max_completion_tokens") == second.pop("max_tokens") and first == second and sent[0][2] == "k"
    assert first["messages"][0]["content"][0]["image_url"]["url"] == "data:image/png;base64,eA=="
    assert models.Detector("u/", send=send)()([{"image": b"x"}]) == [[{"label": "Text"}]] and sent[-1][0] == "u/detect"
    assert models.Ocr("u", send=send)()([{"image": b"x"}]) == [[{"text": "a", "box": [0, 0, 1, 1]}]]
    assert models.Structure("u", send=send)()([{"image": b"x", "boxes": [[0.0] * 4], "tokens": []}]) == [[{"label": "Text"}]]

    def refuse(url, body, timeout, key=None):
        raise urllib.error.HTTPError(url, 500, "", None, None)

    with pytest.raises(urllib.error.HTTPError):
        models.Vlm("u", send=refuse)()([{"image": b"x", "prompt": "p"}])


@pytest.mark.parametrize("name, calls", [("detector", 40), ("vlm", 40), ("vlm_all", 40), ("vlm_grounding", 40 + 4 * 40), ("vlm_auto", 40)])
def test_a_service_is_asked_once_about_a_page(spark, tmp_path, name, calls):
    """Grounding asks once more for each region; here no region is a picture, and no line is damaged."""
    seen = tmp_path / name
    seen.mkdir()

    def counting(client):
        def made():
            call = client()

            def answers(rows):
                for _ in rows:
                    (seen / uuid.uuid4().hex).touch()
                return call(rows)

            return answers

        return made

    pages = spark.range(40).select(F.col("id").alias("doc_id"), F.lit(1).alias("page"), F.unhex(F.lit(stubs.PNG)).alias("image"))
    lines = pages.select("doc_id", "page", F.lit(0).alias("seq"), F.lit("a").alias("text"), F.struct(*[F.lit(float(v)).alias(k) for k, v in (("x0", 1), ("y0", 1), ("x1", 9), ("y1", 9))]).alias("bbox"), F.lit(9.0).alias("font_size"))
    vlm = lambda: lambda rows: [stubs.vlm()([r | {"doc_id": 1, "page": 6}])[0].replace("Picture", "Text") for r in rows]
    out = models.strategy(name).apply(lines, pages, None, models.Clients(detector=counting(stubs.detector), vlm=counting(vlm)))
    assert out.count() == len(out.collect())
    assert len(list(seen.iterdir())) == calls


def test_empty_relations(spark):
    lines = spark.createDataFrame([], f"doc_id bigint, page int, seq int, text string, bbox {BBOX}, font_size double")
    pages = spark.createDataFrame([], "doc_id bigint, page int, image binary")
    for name in models.STRATEGIES:
        assert models.strategy(name).apply(lines, pages, None, stubs.CLIENTS).count() == 0
    assert clean.strip_headers_footers(spark.createDataFrame([], ITEM)).count() == clean.merge_paragraphs(spark.createDataFrame([], ITEM)).count() == 0


def test_crowded_pages(spark, tmp_path):
    """Parts and customers of a large table meet on fifty pages: no page is cut, and lines and regions in one place are compared once and joined whole."""
    from leafmill import catalog
    from leafmill.plans import tables as D

    for table, key, copies, columns in (("part", "p_partkey", 4, "p_name"), ("customer", "c_custkey", 4, "c_name")):
        rows = spark.range(300).select(F.col("id").alias(key), F.concat(F.lit("n"), F.col("id").cast("string")).alias(columns))
        rows.write.parquet(f"{tmp_path}/{table}.parquet")
    assert D.crowded_lines(spark, str(tmp_path)).groupBy("doc_id", "page").count().select("count").distinct().collect() == [(6,)]
    assert D.crowded_regions(spark, str(tmp_path)).select("doc_id", "page").distinct().count() == 50
    found = catalog.QUERIES["region_overlap_edges"](spark, str(tmp_path)).count()
    assert found == duckdb.connect().execute(f"create view customer as from '{tmp_path}/customer.parquet/*.parquet'; {catalog.ORACLES['region_overlap_edges']}").df().shape[0] > 0


def test_copies_of_boxes(spark):
    """Six copies of each of four lines: each sees every copy of the line below it, none of its own place, and finds the same region."""
    rows = [(1, 1, 10 * k + i, (0.0, 20.0 * k, 50.0, 20.0 * k + 10)) for k in range(4) for i in range(6)]
    lines = spark.createDataFrame(rows, f"doc_id bigint, page int, seq int, bbox {BBOX}")
    found = {(r["above"], r["below"]) for r in order.edges(lines).collect()}
    assert found == {(10 * k + i, 10 * k + 10 + j) for k in range(3) for i in range(6) for j in range(6)}
    regions = spark.createDataFrame([(1, 1, n, "text", 0.9, 0.0, 20.0 * k, 50.0, 20.0 * k + 10) for n, k in enumerate((0, 0, 1, 1))], REGION)
    for match in (layout.match_overlap, layout.match_center):
        assert {(r["seq"] // 10, r["region_no"]) for r in match(lines, regions).collect()} == {(0, 0), (1, 2), (2, None), (3, None)}
    assert {(r["a"], r["b"]) for r in layout.overlap_edges(regions).collect()} == {(0, 1), (2, 3)}


@pytest.mark.parametrize("seed", range(3))
def test_who_gives_way(spark, seed):
    """Regions of crowded pages against the rule itself, one region after another."""
    pick = random.Random(seed)
    rows = []
    for i in range(400):
        l, t = pick.randrange(0, 120), pick.randrange(0, 120)
        rows.append((1, 1 + i % 2, i, pick.choice(["text", "table", "list_item", "code", "code", "picture"]), pick.randrange(40) / 40, float(l), float(t), float(l + pick.choice((30, 32, 60))), float(t + pick.choice((30, 33, 60)))))
    group = lambda x: "picture" if x[3] == "picture" else "wrapper" if x[3] == "table" else "regular"
    size = lambda x: (x[7] - x[5]) * (x[8] - x[6])
    both = lambda x, y: max(0, min(x[7], y[7]) - max(x[5], y[5])) * max(0, min(x[8], y[8]) - max(x[6], y[6]))
    label = {x[2]: x[2] for x in rows}
    pairs = [(x, y) for x in rows for y in rows if x[2] < y[2] and x[1] == y[1] and group(x) == group(y) and both(x, y) / min(size(x), size(y)) > 0.8]
    assert {(r["a"], r["b"]) for r in layout.overlap_edges(spark.createDataFrame(rows, REGION)).collect()} == {(x[2], y[2]) for x, y in pairs}
    for _ in rows:
        for x, y in pairs:
            label[x[2]] = label[y[2]] = min(label[x[2]], label[y[2]])
    kept = set()
    for c in set(label.values()):
        own = [x for x in rows if label[x[2]] == c]

        def back(x, y):
            most, loss = {"regular": (1.3, 0.05), "picture": (2.0, 0.3), "wrapper": (2.0, 0.2)}[group(x)]
            ratio = size(x) / size(y)
            as_list = x[3] == "list_item" and y[3] == "text" and abs(1 - ratio) < 0.2
            return not as_list and not (x[3] == "code" and both(x, y) / size(y) > 0.8) and ratio <= most and y[4] - x[4] > loss

        able = [x for x in own if not any(x is not y and back(x, y) for y in own)] or own[:1]
        best, loss = able[0], {"regular": 0.05, "picture": 0.3, "wrapper": 0.2}[group(own[0])]
        for x in able[1:]:
            if size(x) > size(best) and best[4] - x[4] <= loss:
                best = x
        kept.add(best[2])
    assert {r["region_no"] for r in layout.remove_overlaps(spark.createDataFrame(rows, REGION)).collect()} == kept


def test_pages_share_batches(spark):
    """Pages of one task, cut by batches of seven rows, are placed as each page alone: many in a batch, and one over many batches; a null page is a page."""
    schema = f"doc_id bigint, page int, seq int, category string, bbox {BBOX}"
    pick = random.Random(3)
    rows = []
    for page, n in [(1, 2), (2, 3), (3, 40), (4, 1), (None, 5), (5, 120)]:
        place = list(range(n))
        pick.shuffle(place)
        rows += [(1, page, i, "text", (0.0, 10.0 * p, 50.0, 10.0 * p + 8)) for i, p in enumerate(place)]
    want = {(r[1], r[2]): int(r[4][1] / 10) for r in rows}
    kept = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        plan = order.reading_order(spark.createDataFrame(rows, schema))
        found = {(r["page"], r["seq"]): r["position"] for r in plan.collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", kept)
    assert found == want
    assert "FlatMapGroupsInArrow" not in plan._jdf.queryExecution().toString()  # one call of Python a page was most of the cost


def test_windows_of_a_long_section(spark):
    """A section of 400 lines in 1111 windows, each with the boxes that it touches: the section is measured once, so it takes no minute."""
    lines = [(1, k, k // 10, "section_header" if k == 0 else "text", f"h{k}" if k == 0 else "ä" * 499 if k % 7 else "") for k in range(401)]
    items = spark.createDataFrame(lines, "doc_id bigint, seq int, page int, category string, text string").withColumn("bbox", F.struct(F.col("seq").cast("double").alias("x0"), F.lit(0.0).alias("y0"), F.lit(1.0).alias("x1"), F.lit(1.0).alias("y1")))
    start = time.time()
    found = [(r["text"], [int(b["bbox"]["x0"]) for b in r["bboxes"]]) for r in chunk.smart(items, 200, 20).orderBy("chunk_no").collect()]
    assert time.time() - start < 10
    body, at, spans = "\n".join(x[4] for x in lines[1:]), 0, []
    for _, k, _, _, text in lines[1:]:
        spans.append((k, at, at + len(text)))
        at += len(text) + 1
    want = []
    for s in range(0, max(len(body) - 200 + 179, 0) // 180 * 180 + 1, 180):
        e = min(s + 200, len(body))
        want.append(("h0, " + body[s:e], [0] + [k for k, a, b in spans if a < e and b > s]))
    assert found == want
