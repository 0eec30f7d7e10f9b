"""Token ids in binary files of patched frame-of-reference blocks.

A file holds the ids of a run of documents in ascending doc_id order:

    header   magic "PFR1", block size, ids, blocks, documents (little-endian, 4 + 4 + 8 + 4 + 4 bytes)
    blocks   each: minimum u32, count u32, width u8, exceptions u16, pad u8; (value - minimum) mod
             2**width, packed in `width` bits each; places of the exceptions u16 and what lies above
             the width u32
    index    byte offset u64 of each block
    docs     doc_id i64, first id u64, ids u64 of each document

The width of a block is that of its PERCENTILE-th largest value above the minimum; larger values
go to the exception list. A reader finds the block of an id by the index and decodes it alone.

Files lie in the shared folder under names of their own; a row of the index names each. Only the rows of tasks that
committed are kept, so an attempt that is lost leaves a file that nothing refers to. Null texts are empty: their ids are
the end id alone. Repeated doc_ids follow one another in the order of their texts' hashes, and may lie in several files. An
empty table gives no files and no rows. Null doc_ids are kept and come first. Other columns are ignored.
"""

from __future__ import annotations

import itertools
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafmill.llm.shared import materialize, new_path, whole_text
from leafmill.llm.tokenizing import END_ID, Encoder, batches, vocabulary

MAGIC = b"PFR1"
BLOCK = 1024
PERCENTILE = 90
#: A shard ends after the document with which it has so many ids.
SHARD_IDS = 4 << 20
HEAD, BLOCK_HEAD = struct.Struct("<4sIQII"), np.dtype([("low", "<u4"), ("n", "<u4"), ("width", "u1"), ("exceptions", "<u2"), ("pad", "u1")])
#: Tasks that read files at most.
FILES_READ = 20_000
#: Blocks that are packed or unpacked at once.
AT_ONCE = 256


def _widths(above: np.ndarray, percentile: int) -> np.ndarray:
    """Bits of the percentile-th value of each row."""
    at = min(above.shape[1] - 1, max(0, -(-above.shape[1] * percentile // 100) - 1))
    return np.frexp(np.partition(above, at, axis=1)[:, at].astype(float))[1].astype(np.uint8)


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of unsigned values, `width` bits each, as rows of bytes: the lowest bits first. Eight values of up to 16 bits go through two words."""
    rows, n = values.shape
    size = (n * width + 7) // 8
    if width > 16:
        bits = ((values[:, :, None] >> np.arange(width, dtype=np.uint32)) & 1).astype(np.uint8)
        return np.packbits(bits.reshape(rows, n * width), axis=1, bitorder="little")
    eights = np.zeros((rows, -(-n // 8) * 8), np.uint64)
    eights[:, :n] = values
    eights = eights.reshape(rows, -1, 2, 4)
    low, high = (sum((eights[:, :, k, i] << np.uint64(i * width) for i in range(1, 4)), eights[:, :, k, 0]) for k in (0, 1))
    words = np.stack([low | (high << np.uint64(4 * width) if width < 16 else np.uint64(0)), high >> np.uint64(64 - 4 * width)], axis=-1)
    return words.view(np.uint8)[:, :, :width].reshape(rows, -1)[:, :size]


def _unpack(data: np.ndarray, n: int, width: int) -> np.ndarray:
    """Rows of n values that _pack() made rows of bytes of."""
    rows = len(data)
    if width > 16:
        padded = np.zeros((rows, n, 32), np.uint8)
        padded[:, :, :width] = np.unpackbits(data, axis=1, count=n * width, bitorder="little").reshape(rows, n, width)
        return np.packbits(padded, axis=2, bitorder="little").reshape(rows, -1).view("<u4")
    groups = -(-n // 8)
    flat = np.zeros((rows, groups * width), np.uint8)
    flat[:, : data.shape[1]] = data
    words = np.zeros((rows * groups, 16), np.uint8)
    words[:, :width] = flat.reshape(-1, width)
    low, high = words.view(np.uint64).T
    half = np.uint64((1 << 4 * width) - 1)
    pair = low & half, (low >> np.uint64(4 * width) | high << np.uint64(64 - 4 * width) if width < 16 else high) & half
    shifts = np.arange(4, dtype=np.uint64) * np.uint64(width)
    out = np.stack(pair, axis=1)[:, :, None] >> shifts & np.uint64((1 << width) - 1)
    return out.reshape(rows, -1)[:, :n].astype(np.uint32)


def encode_blocks(ids: np.ndarray, block: int = BLOCK, percentile: int = PERCENTILE) -> tuple[bytes, np.ndarray]:
    """The blocks of ids (unsigned, up to 32 bits), and the offset of each from the first."""
    if not 0 < block <= 65536:
        raise ValueError("a block has 1 to 65,536 ids")
    parts: list[bytes] = []
    whole = len(ids) // block
    spans = [(s, min(whole, s + AT_ONCE) - s, block) for s in range(0, whole, AT_ONCE)] + ([(whole, 1, len(ids) - whole * block)] if len(ids) % block else [])
    for first, rows, n in spans:
        values = ids[first * block : first * block + rows * n].reshape(rows, n).astype(np.uint32)
        low = values.min(axis=1)
        above = values - low[:, None]
        widths = _widths(above, percentile)
        out: list[bytes] = [b""] * rows
        for w in np.unique(widths):
            own = np.flatnonzero(widths == w)
            v, w = above[own], int(w)
            packed = _pack(v & np.uint32((1 << w) - 1), w) if w else np.zeros((len(own), 0), np.uint8)
            over = v >> np.uint32(w) if w < 32 else np.zeros_like(v)
            for k, i in enumerate(own):
                places = np.flatnonzero(over[k])
                if len(places) > 65535:  # only in a block of 65,536
                    raise ValueError("too many exceptions for a block")
                head = np.array([(low[i], n, w, len(places), 0)], BLOCK_HEAD).tobytes()
                out[i] = head + packed[k].tobytes() + places.astype("<u2").tobytes() + over[k][places].astype("<u4").tobytes()
        parts += out
    return b"".join(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])[:-1].astype("<u8") if parts else np.zeros(0, "<u8")


def decode_block(data: memoryview | bytes, at: int) -> np.ndarray:
    """The ids of the block that starts at byte `at`."""
    low, n, width, exceptions, _ = np.frombuffer(data, BLOCK_HEAD, 1, at)[0].tolist()
    at += BLOCK_HEAD.itemsize
    size = (n * width + 7) // 8
    out = np.zeros(n, np.uint32)
    if width:
        out[:] = _unpack(np.frombuffer(data, np.uint8, size, at)[None], n, width)[0]
    if exceptions:
        places = np.frombuffer(data, "<u2", exceptions, at + size)
        out[places] |= np.frombuffer(data, "<u4", exceptions, at + size + 2 * exceptions) << np.uint32(width)
    return out + np.uint32(low)


def write_shard(ids: np.ndarray, doc_ids: list[int], counts: list[int], block: int = BLOCK, percentile: int = PERCENTILE) -> bytes:
    blocks, starts = encode_blocks(ids, block, percentile)
    firsts = np.concatenate([[0], np.cumsum(counts)])[:-1]
    docs = np.zeros(len(doc_ids), [("doc", "<i8"), ("first", "<u8"), ("n", "<u8")])
    docs["doc"], docs["first"], docs["n"] = doc_ids, firsts, counts
    return HEAD.pack(MAGIC, block, len(ids), len(starts), len(doc_ids)) + blocks + (starts + HEAD.size).astype("<u8").tobytes() + docs.tobytes()


class Shard:
    """Random access to the ids of a shard."""

    def __init__(self, data: bytes):
        self.data = data
        magic, self.block, self.n_ids, n_blocks, n_docs = HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a shard")
        tail = len(data) - 24 * n_docs
        self.starts = np.frombuffer(data, "<u8", n_blocks, tail - 8 * n_blocks)
        self.docs = np.frombuffer(data, [("doc", "<i8"), ("first", "<u8"), ("n", "<u8")], n_docs, tail)
        self.held: tuple[int, np.ndarray] = (-1, np.zeros(0, np.uint32))

    def read(self, first: int, n: int) -> np.ndarray:
        parts = []
        for b in range(first // self.block, (first + n - 1) // self.block + 1 if n else 0):
            if self.held[0] != b:
                self.held = (b, decode_block(self.data, int(self.starts[b])))
            parts.append(self.held[1][max(0, first - b * self.block) : first + n - b * self.block])
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


    def all(self) -> np.ndarray:
        """Every id; blocks of one width are unpacked together."""
        raw, starts = np.frombuffer(self.data, np.uint8), self.starts.astype(np.int64)
        heads = np.ascontiguousarray(raw[starts[:, None] + np.arange(BLOCK_HEAD.itemsize)]).view(BLOCK_HEAD)[:, 0]
        out = np.zeros((len(starts), self.block), np.uint32)
        kinds = heads["n"].astype(np.int64) << 8 | heads["width"]
        for kind in np.unique(kinds).tolist():
            n, width = kind >> 8, kind & 255
            own = np.flatnonzero(kinds == kind)
            size = (n * width + 7) // 8
            for a in range(0, len(own) if width else 0, AT_ONCE):
                part = own[a : a + AT_ONCE]
                out[part, :n] = _unpack(raw[starts[part][:, None] + BLOCK_HEAD.itemsize + np.arange(size)], n, width)
            for i in own[heads["exceptions"][own] > 0].tolist():
                at, m = int(starts[i]) + BLOCK_HEAD.itemsize + size, int(heads["exceptions"][i])
                places = np.frombuffer(self.data, "<u2", m, at)
                out[i, places] |= np.frombuffer(self.data, "<u4", m, at + 2 * m) << np.uint32(width)
        return (out + heads["low"][:, None]).ravel()[: self.n_ids]


#: part: the task that wrote the file, in order of its documents; seq: its number there.
INDEX = "part bigint, seq bigint, null_docs bigint, n_ids bigint, store string, file string"


def write_ids(docs: DataFrame, tokenizer: str | None = None, block: int = BLOCK, percentile: int = PERCENTILE, special_as_text: bool = False) -> DataFrame:
    """Write the ids of every text, each with the end id, and return the index of the files.

    One range shuffle of the texts puts the documents in order; each task then encodes and writes its run. Rows of one
    doc_id, or of none, are told apart by text and row, so that none of them fills a task.
    """
    path, folder = tokenizer or vocabulary("byte_bpe_50k.json"), new_path(docs.sparkSession, "pfor-files")

    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        encode = Encoder(path, special_as_text).encode_batch
        held: list[bytes] = []
        doc_ids: list[int | None] = []
        part, seq = TaskContext.get().partitionId(), 0
        end = np.array([END_ID], "<u2").tobytes()
        size = 0

        def flush() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), "<u2")
            name = f"{base}/{part:06d}-{seq:06d}-{uuid.uuid4().hex}.pfr"
            with store.open_output_stream(name, compression=None) as out:
                out.write(write_shard(ids, [d or 0 for d in doc_ids], [len(h) // 2 for h in held], block, percentile))
            row = [[part], [seq], [sum(d is None for d in doc_ids)], [len(ids)], [folder], [name]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, (pa.int64(),) * 4 + (pa.string(),) * 2, strict=True)], ["part", "seq", "null_docs", "n_ids", "store", "file"])

        for batch in rows:
            texts, ids = (batch.column(i).to_pylist() for i in range(2))
            for a, b in batches(texts):
                for data, doc in zip(encode(texts[a:b]), ids[a:b], strict=True):
                    held.append(data + end)
                    doc_ids.append(doc)
                    size += len(held[-1]) // 2
                    if size >= SHARD_IDS:
                        yield flush()
                        held, doc_ids, seq, size = [], [], seq + 1, 0
        if held:
            yield flush()

    rows = docs.select(whole_text().alias("text"), "doc_id").withColumns({"__h": F.xxhash64("text"), "__row": F.monotonically_increasing_id()})
    ordered = rows.repartitionByRange("doc_id", "__h", "__row").sortWithinPartitions("doc_id", "__h", "__row").select("text", "doc_id")
    return materialize(ordered.mapInArrow(run, INDEX), "pfor")


def read_ids(index: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 of every document, from the files."""
    # The driver adds up one number for each task that wrote; the files of a task are added up where they are.
    totals = {r["part"]: r["n"] for r in index.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}
    parts = sorted(totals)
    before = dict(zip(parts, itertools.accumulate([0, *[totals[p] for p in parts]]), strict=False))
    order = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = index.select("null_docs", "store", "file", "part", (F.sum("n_ids").over(order) - F.col("n_ids")).alias("base"))

    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in rows:
            for nulls, folder, file, part, base in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                store, _ = fs.FileSystem.from_uri(folder)
                with store.open_input_file(file) as f:
                    shard = Shard(f.read())
                found = shard.all().astype("<u4").tobytes()
                crcs = [zlib.crc32(found[4 * a : 4 * (a + n)]) for a, n in zip(shard.docs["first"].tolist(), shard.docs["n"].tolist(), strict=True)]
                ids = [None] * nulls + shard.docs["doc"][nulls:].tolist()
                columns = [pa.array(ids, pa.int64()), pa.array(shard.docs["first"].astype(np.int64) + base + before[part]), pa.array(shard.docs["n"].astype(np.int64)), pa.array(crcs, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    # So many tasks in any case: the index is small, what its rows point to isn't.
    return placed.repartition(max(1, min(FILES_READ, index.count())), "file").mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
