"""format("documents"): what is listed, read, written and seen."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, StringEndsWith

from leafmill.plans import pipeline
from leafmill.plans import tables as D
from leafmill.sources import datasource, files


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in/sub").mkdir(parents=True)
    for name, text in {"a.md": "# Head\n\ntext", "b.txt": "One.\n\nTwo.", "sub/c.html": "<html><p>Three</p></html>", "sub/d.txt": "<!DOCTYPE html><h1>Four</h1>", "e.bin": "?", "_hidden.md": "no", "f.docx": "PK\x03\x04"}.items():
        (tmp_path / "in" / name).write_text(text)
    return str(tmp_path / "in")


def read(reader):
    return [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]


def test_filters_decide_which_files_are_read(folder, monkeypatch):
    seen = []
    for kind in ("md", "txt", "html"):
        monkeypatch.setitem(files.PARSERS, kind, lambda content, parse=files.PARSERS[kind], kind=kind: seen.append(kind) or parse(content))
    reader = datasource.DocumentsReader({"path": folder})
    left = [GreaterThan(("page",), 0)]
    assert list(reader.pushFilters([EqualTo(("ext",), "html"), *left])) == left
    assert {r["text"] for r in read(reader)} == {"Three", "Four"} and seen == ["html", "html"]
    seen.clear()
    reader = datasource.DocumentsReader({"path": folder})
    assert list(reader.pushFilters([StringEndsWith(("path",), ".txt"), In(("ext",), ("txt", "md"))])) == []
    assert [len(p.paths) for p in reader.partitions()] == [2] and [r["text"] for r in read(reader)] == ["One.", "Two."] and seen == ["txt"]
    assert [len(p.paths) for p in datasource.DocumentsReader({"path": folder, "bytes": "1"}).partitions()] == [1] * 6


def test_rows_are_those_of_the_parser(spark, folder):
    datasource.register(spark)
    found = spark.read.format("documents").option("bytes", 20).load(folder)
    parsed = files.read_files(spark, folder)
    want = {(r["path"].split("/")[-1], r["ext"], r["seq"], r["category"], r["text"], r["font_size"]) for r in parsed.select("path", "ext", F.explode("lines").alias("x")).select("path", "ext", "x.*").collect() if "_hidden" not in r["path"]}
    assert {(r["path"].split("/")[-1], r["ext"], r["seq"], r["category"], r["text"], r["font_size"]) for r in found.where("error is null").collect()} == want
    assert {r["path"].split("/")[-1]: r["error"].split(":")[0] for r in found.where("error is not null").collect()} == {"e.bin": "ValueError", "f.docx": "BadZipFile"}
    assert found.where("ext = 'md' and path like '%a.md'").count() == 2 and found.where("ext = 'md' and ext = 'txt'").count() == 0
    assert spark.read.format("documents").load(f"file://{folder}").where("ext is null").count() == 2
    os.makedirs(f"{folder}/none")
    assert spark.read.format("documents").load(f"{folder}/none").count() == 0


def test_records_as_documents(spark, sf_dir, tmp_path):
    """One JSON document for each document, the same as dump() makes; another job adds to them or takes their place."""
    records = pipeline.run(D.items_doc(spark, sf_dir), pipeline.Config(reg_date="x"))
    out = str(tmp_path / "out")
    datasource.write_documents(records, out)
    found = {f: json.load(open(os.path.join(d, f), encoding="utf-8")) for d, _, names in os.walk(out) for f in names if f.endswith(".json")}
    assert found == {f"{r['doc_id']}.json": json.loads(r["json"]) for r in pipeline.dump(records).collect()}
    one = records.where("doc_id = 1")
    datasource.write_documents(one, out)
    assert [f for _, _, names in os.walk(out) for f in names if f.endswith(".json")] == ["1.json"]
    datasource.write_documents(records.where("doc_id = 2"), out, "append")
    assert sorted(f for _, _, names in os.walk(out) for f in names if f.endswith(".json")) == ["1.json", "2.json"]
    datasource.write_documents(records.limit(0), out)
    assert not [f for _, _, names in os.walk(out) for f in names if f.endswith(".json")]


def test_a_failed_job_leaves_nothing(spark, tmp_path):
    datasource.register(spark)
    out = str(tmp_path / "out")
    good = spark.range(50).selectExpr("id div 10 as doc_id", "cast(id % 10 as int) as i_chunk_on_doc", "'a' as text")
    datasource.write_documents(good, out)
    before = sorted(f for _, _, names in os.walk(out) for f in names)
    bad = good.withColumn("text", F.expr("if(doc_id = 3 and i_chunk_on_doc = 9, raise_error('no'), text)"))
    with pytest.raises(Exception, match="no"):
        datasource.write_documents(bad, out)
    assert sorted(f for _, _, names in os.walk(out) for f in names) == before and not os.listdir(f"{out}/_temporary")
    with pytest.raises(Exception, match="together"):
        good.coalesce(1).orderBy("i_chunk_on_doc").write.format("documents").mode("append").save(out)
    assert sorted(f for _, _, names in os.walk(out) for f in names) == before


def test_a_long_document_is_a_stream(spark, tmp_path):
    """200,000 records of one document, over many batches."""
    out = str(tmp_path / "out")
    datasource.write_documents(spark.range(200_000).selectExpr("cast(7 as bigint) as doc_id", "cast(id as int) as i_chunk_on_doc", "concat('t', id) as text"), out)
    (made,) = [json.load(open(os.path.join(d, f), encoding="utf-8")) for d, _, names in os.walk(out) for f in names if f.endswith(".json")]
    assert made["source"] == 7 and [v["i_chunk_on_doc"] for v in made["vectors"]] == list(range(200_000))


def test_documents_are_read_back_by_folder(spark, tmp_path):
    """Two hundred documents, one to a file, are read by as many tasks as wrote them, and by none where there is none."""
    out, schema = str(tmp_path / "out"), "source bigint, vectors array<struct<i_chunk_on_doc: int, text: string>>"
    records = spark.range(600).selectExpr("id div 3 as doc_id", "cast(id % 3 as int) as i_chunk_on_doc", "if(id % 3 = 1, null, concat('ä \\n \"', id)) as text")
    datasource.write_documents(records, f"file://{out}")
    datasource.write_documents(records.where("doc_id < 5").withColumn("doc_id", F.col("doc_id") + 1000), out, "append")
    read = datasource.read_documents(spark, f"file://{out}", schema)
    assert read.rdd.getNumPartitions() == len([x for x in os.listdir(out) if x.startswith("part-")]) <= 8
    want = [(d + more, [(k, None if k == 1 else f'ä \n "{3 * d + k}') for k in range(3)]) for n, more in ((200, 0), (5, 1000)) for d in range(n)]
    assert [(r["source"], [tuple(v) for v in r["vectors"]]) for r in read.orderBy("source").collect()] == want
    datasource.write_documents(records.limit(0), out)
    assert datasource.read_documents(spark, out, schema).count() == 0
