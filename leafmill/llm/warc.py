"""WARC archives with an index first, read back by coalesced byte ranges.

write   Records go to .warc.gz files (one gzip member each) in the shared folder: a response with its
        payload, or a revisit that names the response with the same payload digest. For each record an
        index row has the archive, offset, length, URL and digest.
read    The index rows wanted are sorted by archive and offset; ranges less than GAP bytes apart become
        one read of SPAN bytes at most (a longer record is read alone).

Null html is the empty payload, null url the empty URI. Of records with equal payloads of at least
`least` bytes, those with the largest page_id are responses and the others revisit it; a repeated row
with that very page_id is a response too. Null page_ids are below all others, and a row with one is a
revisit without target only if some page_id that isn't null has its payload. Empty tables give empty
indexes. Other columns are ignored.

A task writes to files with names of its own, and only the index rows of tasks that committed are
kept, so an attempt that is lost leaves files that nothing refers to.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.llm.shared import materialize, new_path, whole_text

#: Bytes between two records that are read rather than skipped, bytes of one read, bytes of an archive.
GAP, SPAN, ARCHIVE = 1 << 16, 8 << 20, 1 << 30
#: Tasks that read archives at most.
TASKS = 20_000
#: A fixed date keeps archives alike from run to run.
DATE = "2020-01-01T00:00:00Z"
INDEX = "archive string, offset bigint, length bigint, url string, digest string, page_id bigint"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One record, without compression."""
    kind = "revisit" if revisit else "response"
    body = b"" if revisit else b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}", f"WARC-Target-URI: {re.sub(r'[\r\n]', ' ', url)}",
        f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}",
    ]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}>"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    body = rest[: int(fields["Content-Length"])]
    return fields, body.partition(b"\r\n\r\n")[2] if fields["WARC-Type"] == "response" else b""


def page_number(urn: str) -> int | None:
    digits = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def digests(pages: DataFrame) -> DataFrame:
    """page_id, sha (the payload's SHA-1 in hexadecimal digits) and payload_bytes of every row."""
    return pages.select("page_id", whole_text("html").alias("html")).select("page_id", F.sha1(F.encode("html", "utf-8")).alias("sha"), F.octet_length("html").cast("bigint").alias("payload_bytes"))


def revisits(found: DataFrame, least: int = 0) -> DataFrame:
    """page_id and sha (of revisits) and the page_id of the response with the same payload."""
    top = found.where(F.col("payload_bytes") >= least).groupBy("sha").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").drop("n")
    return found.where(F.col("payload_bytes") >= least).join(top, "sha").where(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select("page_id", "sha", "refers_to").distinct()


def write(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write every row as a record; the index of the archives."""
    spark = pages.sparkSession
    folder = new_path(spark, "warc")
    refers = revisits(materialize(digests(pages), "digests"), least)
    rows = pages.select("page_id", whole_text("url").alias("url"), whole_text("html").alias("html")).withColumn("sha", F.sha1(F.encode("html", "utf-8")))
    # Each key on the right is one row: page_id keeps a hot payload's rows apart.
    refers = refers.withColumn("revisit", F.lit(True)).select(F.col("page_id").alias("r_id"), F.col("sha").alias("r_sha"), "refers_to", "revisit")
    joined = rows.join(refers, F.col("page_id").eqNullSafe(F.col("r_id")) & (F.col("sha") == F.col("r_sha")), "left").select("page_id", "url", "html", "refers_to", F.coalesce("revisit", F.lit(False)).alias("revisit"), "sha")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        out, name, at = None, "", 0
        try:
            for batch in batches:
                index = []
                for page_id, url, html, refers_to, revisit, sha in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if out is None or at >= ARCHIVE:
                        if out is not None:
                            out.close()
                        name, at = f"{base}/{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(name, compression=None)
                    payload = html.encode("utf-8", "surrogatepass")
                    digest = base64.b32encode(bytes.fromhex(sha)).decode()
                    data = gzip.compress(record(page_id, url, payload, digest, refers_to, revisit), 1, mtime=0)
                    out.write(data)
                    index.append((name, at, len(data), url, digest, page_id))
                    at += len(data)
                if index:
                    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*index, strict=True), kinds, strict=True)], ["archive", "offset", "length", "url", "digest", "page_id"])
        finally:
            if out is not None:
                out.close()

    return materialize(joined.mapInArrow(run, INDEX), "warc-index").withColumn("store", F.lit(folder))


def coalesced(ranges: Iterable[tuple[int, int]], gap: int = GAP, span: int = SPAN) -> Iterator[list[tuple[int, int]]]:
    """Sorted (offset, length) in runs that are read at once."""
    run: list[tuple[int, int]] = []
    for offset, length in ranges:
        if run and (offset - sum(run[-1]) > gap or offset + length - run[0][0] > span):
            yield run
            run = []
        run.append((offset, length))
    if run:
        yield run


def read(index: DataFrame, wanted: Column | None = None, payload: bool = True) -> DataFrame:
    """The records that index rows (those of `wanted`) point to: page_id, url, record_type, digest, payload_bytes, refers_to, and the payload if asked for.

    A response's digest and length are taken from the payload that was read.
    """
    rows = index if wanted is None else index.where(wanted)
    # Slices of an archive go to tasks of their own: SPAN-sized ones keep the reads whole and no archive in one task.
    placed = rows.select("store", "archive", "offset", "length", F.expr(f"offset div {8 * SPAN}").alias("slice"))
    # So many tasks in any case: the index is small, what its rows point to isn't.
    tasks = max(1, min(TASKS, placed.select("archive", "slice").distinct().count()))
    placed = placed.repartition(tasks, "archive", "slice").sortWithinPartitions("archive", "offset")
    schema = "page_id bigint, url string, record_type string, digest string, payload_bytes bigint, refers_to bigint" + ", payload binary" * payload

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            stores, archives, offsets, lengths = (batch.column(i).to_pylist() for i in range(4))
            start = 0
            while start < len(archives):
                end = start
                while end < len(archives) and archives[end] == archives[start]:
                    end += 1
                store, _ = fs.FileSystem.from_uri(stores[start])
                with store.open_input_file(archives[start]) as f:
                    for run_ in coalesced(zip(offsets[start:end], lengths[start:end], strict=True)):
                        first = run_[0][0]
                        data = f.read_at(sum(run_[-1]) - first, first)
                        out = []
                        for offset, length in run_:
                            fields, body = parse(zlib.decompress(data[offset - first : offset - first + length], 31))
                            response = fields["WARC-Type"] == "response"
                            digest = digest_of(body) if response else fields["WARC-Payload-Digest"].removeprefix("sha1:")
                            size = len(body) if response else int(fields["X-Payload-Length"])
                            out.append((page_number(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], fields["WARC-Type"], digest, size, page_number(fields.get("WARC-Refers-To", "<urn:page:>"))) + (body if response else None,) * payload)
                        kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary())
                        names = ["page_id", "url", "record_type", "digest", "payload_bytes", "refers_to", "payload"][: 6 + payload]
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=False)], names)
                start = end

    return placed.mapInArrow(run, schema)
