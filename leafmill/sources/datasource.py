"""Document files as a data source, and records as a sink of JSON documents: spark.read and write with format("documents").

Reading   One row a line: path, ext, error, page, seq, category, text, bbox, font_size; a file that can't be parsed is a row with an
          error. Files are dealt to tasks by their bytes (option `bytes`). Filters on path keep files from being listed to tasks; filters
          on ext keep them from being read: only their first bytes (or an archive's directory) are looked at.
Writing   Records of a document become one JSON document {"source": doc_id, "vectors": [...]}, record after record as they come. Tasks write
          to folders that readers don't see; the commit moves the folders of the tasks that count, so a failed task or job leaves nothing visible.

Paths are opened through the file system of their scheme; local paths need none. Call register() once in a session.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, StringContains, StringEndsWith, StringStartsWith, WriterCommitMessage
from pyspark.sql.types import StructType

from leafmill.sources import files

#: Bytes of files that one task reads at least, unless it is the last one; rows of a batch.
BYTES, ROWS = 128 << 20, 1000
#: Bytes of JSON documents that are read back together, at least; one larger document is a batch of its own.
READ = 8 << 20
SCHEMA = f"path string, ext string, error string, page int, seq int, category string, text string, bbox {files.BOX}, font_size double"
_ARROW = pa.schema([("path", pa.string()), ("ext", pa.string()), ("error", pa.string()), ("page", pa.int32()), ("seq", pa.int32()), ("category", pa.string()), ("text", pa.string()), ("bbox", pa.struct([(k, pa.float64()) for k in ("x0", "y0", "x1", "y1")])), ("font_size", pa.float64())])
#: What a filter on a path says about it.
_TESTS = {EqualTo: lambda p, v: p == v, In: lambda p, v: p in v, StringStartsWith: str.startswith, StringEndsWith: str.endswith, StringContains: lambda p, v: v in p}


def _store(path: str):
    """The file system of a path, the path there, and what comes before it."""
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path.rstrip("/"), ""
    store, name = fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))
    name = name.rstrip("/")
    at = path.find(name)
    return store, name, path[:at] if at > 0 else ""


@dataclass
class Files(InputPartition):
    paths: list[str]


class DocumentsReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.bytes = options["path"], int(options.get("bytes", BYTES))
        self.on_path: list = []
        self.kinds: set[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            column = getattr(f, "attribute", None)
            if column == ("path",) and type(f) in _TESTS:
                self.on_path.append((type(f), f.value))
            elif column == ("ext",) and isinstance(f, (EqualTo, In)):
                kinds = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.kinds = kinds if self.kinds is None else self.kinds & kinds
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        """Files in the order of their paths, as many to a task as make up its bytes."""
        from pyarrow import fs

        store, name, before = _store(self.path)
        found = [store.get_file_info(name)] if store.get_file_info(name).is_file else store.get_file_info(fs.FileSelector(name, recursive=True))
        hidden = lambda p: any(x.startswith(("_", ".")) for x in p[len(name) :].split("/"))
        tasks, held, size = [], [], 0
        for f in sorted((f for f in found if f.is_file and not hidden(f.path)), key=lambda f: f.path):
            path = before + f.path
            if not all(_TESTS[kind](path, value) for kind, value in self.on_path):
                continue
            held.append(path)
            size += f.size or 0
            if size >= self.bytes:
                tasks.append(Files(held))
                held, size = [], 0
        return tasks + [Files(held)] * bool(held) or [Files([])]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        for path in partition.paths:
            for row in self._rows(path):
                rows.append(row)
                if len(rows) >= ROWS:
                    yield pa.RecordBatch.from_pylist(rows, _ARROW)
                    rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _ARROW)

    def _rows(self, path: str) -> Iterator[dict]:
        ext, done = None, 0
        store, name, _ = _store(path)
        try:
            with store.open_input_file(name) as f:
                ext = files.sniff_file(path, f)
                if self.kinds is not None and ext not in self.kinds:
                    return
                if ext not in files.PARSERS:
                    raise ValueError(f"no parser for {ext}")
                f.seek(0)
                content = f.read()
            # Whole, so that a file that breaks off is an error and nothing else.
            lines = [x for x in files.PARSERS[ext](content) if not isinstance(x, files.Page)]
        except Exception as e:  # one bad file is a row with an error, not a failed job
            if self.kinds is None or ext in self.kinds:
                yield {"path": path, "ext": ext, "error": f"{type(e).__name__}: {e}"}
            return
        for page, category, text, box, size in lines:
            yield {"path": path, "ext": ext, "page": page, "seq": done, "category": category, "text": text, "bbox": dict(zip(("x0", "y0", "x1", "y1"), box, strict=True)), "font_size": size}
            done += 1


@dataclass
class Written(WriterCommitMessage):
    folder: str | None
    documents: int


class DocumentsWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite, self.job = options["path"], overwrite, uuid.uuid4().hex

    def _hidden(self, name: str) -> str:
        return f"{name}/_temporary/{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, name, _ = _store(self.path)
        folder, out, source, seen = uuid.uuid4().hex, None, None, 0
        base = f"{self._hidden(name)}/{folder}"
        names: set = set()
        encode = json.JSONEncoder(ensure_ascii=False, separators=(",", ":"), default=str).encode
        try:
            for batch in iterator:
                for record in batch.to_pylist():
                    doc = record.pop("doc_id")
                    if out is None or doc != source:
                        if doc in names:
                            raise ValueError(f"records of {doc} don't come together")
                        if out is not None:
                            out.write(b"]}")
                            out.close()
                        if not seen:
                            store.create_dir(base, recursive=True)
                        out, source, first = store.open_output_stream(f"{base}/{doc}.json"), doc, True
                        names.add(doc)
                        out.write(b'{"source":%s,"vectors":[' % json.dumps(doc).encode())
                        seen += 1
                    out.write(b"," * (not first) + encode({k: v for k, v in record.items() if v is not None}).encode())
                    first = False
            if out is not None:
                out.write(b"]}")
        finally:
            if out is not None:
                out.close()
        return Written(folder if seen else None, seen)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        from pyarrow import fs

        store, name, _ = _store(self.path)
        store.create_dir(name, recursive=True)
        old = [x for x in store.get_file_info(fs.FileSelector(name)) if x.base_name != "_temporary"] if self.overwrite else []
        for x in old:
            (store.delete_file if x.is_file else store.delete_dir)(x.path)
        for m in messages:
            if m is not None and m.folder:
                store.move(f"{self._hidden(name)}/{m.folder}", f"{name}/part-{m.folder}")
        self._clean(store, name)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        store, name, _ = _store(self.path)
        self._clean(store, name)

    def _clean(self, store, name: str) -> None:
        from pyarrow import fs

        if store.get_file_info(self._hidden(name)).type != fs.FileType.NotFound:
            store.delete_dir(self._hidden(name))


class Documents(DataSource):
    @classmethod
    def name(cls) -> str:
        return "documents"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return DocumentsReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return DocumentsWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Make format("documents") known in this session, with filters pushed into it."""
    spark.dataSource.register(Documents)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def write_documents(records: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A JSON document for each document of records, under `path`: a document's records meet in one task and are written in order as they pass."""
    register(records.sparkSession)
    records.repartition("doc_id").sortWithinPartitions("doc_id", "i_chunk_on_doc").write.format("documents").mode(mode).save(path)


def read_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The JSON documents that write_documents() left under `path`, a row of `schema` for each.

    A file for each document is too much for a list on the driver, and with the cost that Spark counts for opening one, thirty files would be a task.
    So the driver lists the folders that writing tasks committed; a task lists and reads the files of one.
    """
    from pyarrow import fs

    store, name, before = _store(path)
    folders = sorted(before + x.path for x in store.get_file_info(fs.FileSelector(name)) if x.type == fs.FileType.Directory and x.base_name.startswith("part-"))

    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for k in batch.column(0).to_pylist():
                store, name, _ = _store(folders[k])
                held, size = [], 0
                for f in store.get_file_info(fs.FileSelector(name)):
                    with store.open_input_file(f.path) as file:
                        held.append(file.read())
                    size += len(held[-1])
                    if size >= READ:
                        yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary()).cast(pa.string())], ["json"])
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary()).cast(pa.string())], ["json"])

    found = spark.range(0, len(folders), 1, max(1, len(folders))).mapInArrow(run, "json string")
    return found.select(F.from_json("json", schema).alias("r")).select("r.*")
