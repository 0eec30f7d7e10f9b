"""Removal of repeated byte strings by a column-wise multi-document suffix construction.

Every byte covered by a `length`-byte string that also starts anywhere else goes.

anchors   In each window of `length` bytes, the `gram`-byte string with the least hash (leftmost of
          equals) is its anchor: equal windows have equal anchors at equal offsets. A run of windows with
          one anchor is a segment; anchors are counted alone first, and only segments whose anchor is found twice
          go on: one row each with the anchor's hash and a 128-bit hash of the segment. Equal segments are
          counted before they meet, so thousands of copies become one row with a count.
columns   Only anchors found with two or more different segments need bytes. One copy of each such
          segment is a document of the construction, aligned at its anchor. Columns are read from right to
          left; each round inserts one symbol of every document, sorts the documents by (symbol, order so
          far) and updates the common prefixes of neighbours. The symbols a round sorts are the collection's
          Burrows-Wheeler transform for that column. Suffixes of different columns aren't merged, as equal
          windows always lie in the same column: that keeps each round linear in the number of documents,
          where the unaligned form rewrites all columns inserted so far. The columns of a construction are a
          file in the shared folder, written once in the order of the rounds and read on by one column in each.
hot       An anchor with over HOT different segments (a passage in many contexts) isn't brought to one
          task but cut by what its segments have around the anchor: see hot_covers().
spans   A prefix of `length` or more bytes common to neighbours marks both windows; covers go back to all
          occurrences of a segment, and the union of a document's covers is removed.

Matches never cross documents; strings are judged on the input. Null and empty texts, and those
shorter than `length`, lose nothing; kept_sha256 is then that of the text. Repeated rows are copies
like any other, so all of them lose their text. Tables without rows give none. Rows are told apart
by doc_id (which may be null) and 128 bits of the text's SHA-256. Other columns stay in remove(), whatever their names.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.llm.shared import delete, discard, materialize, new_path, packed, release, text_key, unpacked, whole_text

LENGTH, GRAM = 400, 32
#: Windows of a text that are looked at together.
SPAN = 1 << 18
#: Segments of one construction; the last anchor's may add HOT.
ROWS = 2048
#: Different segments of an anchor that meet in one task; those of anchors with more are cut into slices of SLICE windows.
HOT, SLICE = 512, 24
COVER = "h bigint, s bigint, cover array<int>"
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    if len(_powers.get(base, ())) < n:
        x = np.full(max(n, 1 << 12), base, np.uint64)
        x[0] = 1
        _powers[base] = np.multiply.accumulate(x)
    return _powers[base][:n]


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of each `gram`-byte string of data."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power(_BASE, n), out=sums[1:])
    h = (sums[gram:] - sums[: n - gram + 1]) * _power(_INVERSE, n - gram + 1)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each run of `width` values."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    rows = padded.reshape(-1, width)
    before = np.minimum.accumulate(rows, axis=1).ravel()
    after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[: n - width + 1], before[width - 1 : n])


def segments(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[int, int, int, int]]:
    """(anchor hash, first byte, bytes, anchor's offset there) of each segment of data."""
    mask = np.uint64((1 << 20) - 1)
    for base in range(0, len(data) - length + 1, SPAN):
        part = data[base : base + SPAN + length - 1]
        h = gram_hashes(part, gram)
        place = np.arange(len(h), dtype=np.uint64)
        anchor = (sliding_least((h & ~mask) | place, length - gram + 1) & mask).astype(np.int64)  # never falls
        starts = np.concatenate([[0], np.flatnonzero(np.diff(anchor)) + 1])
        ends = np.append(starts[1:], len(anchor))
        own = anchor[starts]
        yield from zip(h[own].view(np.int64).tolist(), (starts + base).tolist(), (ends - starts + length - 1).tolist(), (own - starts).tolist(), strict=True)


class Columns:
    """A file of the columns of aligned rows (byte + 1; 0: nothing there), from the last to the first, read once in that order."""

    def __init__(self, folder: str, rows: list[bytes], starts: np.ndarray, width: int):
        from pyarrow import fs

        self.store, base = fs.FileSystem.from_uri(folder)
        self.store.create_dir(base, recursive=True)
        self.name, self.bytes = f"{base}/{uuid.uuid4().hex}.columns", 2 * len(rows)
        matrix = np.zeros((len(rows), width), "<u2")
        for i, (row, start) in enumerate(zip(rows, starts.tolist(), strict=True)):
            matrix[i, start : start + len(row)] = np.frombuffer(row, np.uint8)
            matrix[i, start : start + len(row)] += 1
        with self.store.open_output_stream(self.name, compression=None) as out:
            out.write(np.ascontiguousarray(matrix[:, ::-1].T).data)
        self.file = self.store.open_input_stream(self.name, compression=None)

    def next(self) -> np.ndarray:
        return np.frombuffer(self.file.read(self.bytes), "<u2")

    def close(self) -> None:
        self.file.close()
        self.store.delete_file(self.name)


def repeated(groups: np.ndarray, rows: list[bytes], offsets: np.ndarray, length: int, gram: int, folder: str) -> list[list[int]]:
    """Spans [from, to, ...] of each row covered by a window that another row of its group has in the same column.

    groups: rising numbers; offsets: the anchor's place in each row; folder: where the columns' file is.
    """
    left, n = length - gram, len(rows)
    columns, marks = Columns(folder, rows, left - offsets, left + length), np.zeros((left + 1, n), bool)
    group = groups.astype(np.int64) * 257
    order, common = np.arange(n), np.zeros(n + 1, np.int32)
    same_group = np.zeros(n, bool)
    for column in range(left + length - 1, -1, -1):
        symbols = columns.next()[order]
        key = group[order] + symbols
        at = np.argsort(key, kind="stable")
        key, symbols = key[at], symbols[at]
        same_group[1:] = (key[1:] == key[:-1]) & (symbols[1:] != 0)
        least = common[at]
        far = np.flatnonzero(same_group[1:] & (at[1:] - at[:-1] != 1)) + 1
        if len(far):
            least[far] = np.minimum.reduceat(common, np.stack([at[far - 1] + 1, at[far] + 1], axis=1).ravel())[::2]
        new = np.zeros(n + 1, np.int32)
        new[:n][same_group] = least[same_group] + 1
        order, common = order[at], new
        if column <= left and (hit := np.flatnonzero(common[:n] >= length)).size:
            marks[column, order[hit]] = True
            marks[column, order[hit - 1]] = True
    columns.close()
    found: list[list[int]] = []
    for i in range(n):
        starts = np.flatnonzero(marks[:, i]) - (left - int(offsets[i]))
        found.append(union(starts, starts + length))
    return found


def union(starts: np.ndarray, ends: np.ndarray) -> list[int]:
    """[from, to, ...] of the union of spans; touching spans are one."""
    if not len(starts):
        return []
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    cut = np.flatnonzero(starts[1:] > reach[:-1])
    return np.stack([starts[np.append(0, cut + 1)], reach[np.append(cut, len(starts) - 1)]], axis=1).ravel().tolist()


def _keyed(docs: DataFrame, *more: Column) -> DataFrame:
    """doc_id, th (the text's key), text and more columns of every row."""
    return docs.select("doc_id", text_key(whole_text()).alias("th"), F.col("text").cast("string").alias("text"), *more)


def anchors(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """h, the hash of the anchor, of every segment."""

    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for text in batch.column(0):
                data = np.frombuffer(text.as_py().encode("utf-8", "surrogatepass"), np.uint8)
                if found := [h for h, _, _, _ in segments(data, length, gram)]:
                    yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], ["h"])

    return docs.select(whole_text().alias("text")).mapInArrow(run, "h bigint")


def occurrences(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(h, s, doc_id, th, start, len, off) of every segment; h and s together are its 128-bit hash."""

    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest

        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int32())
        for batch in rows:
            for a in range(0, len(batch), 512):
                part, out = batch.slice(a, 512), []
                for doc_id, th, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    data = text.encode("utf-8", "surrogatepass")
                    if len(data) >= length:
                        out += [(h, xxh3_64_intdigest(data[s : s + n], off) - (1 << 63), doc_id, th, s, n, off) for h, s, n, off in segments(np.frombuffer(data, np.uint8), length, gram)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["h", "s", "doc_id", "th", "start", "len", "off"])

    return _keyed(docs).select("doc_id", "th", whole_text().alias("text")).mapInArrow(run, "h bigint, s bigint, doc_id bigint, th binary, start bigint, len int, off int")


def _join_docs(docs: DataFrame, per_doc: DataFrame, how: str) -> DataFrame:
    """docs (keyed) and a table of one row for each (k_id, k_th)."""
    on: Column = F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("th") == F.col("k_th"))
    return docs.join(per_doc.hint("merge"), on, how)  # per_doc grows with the documents: never broadcast


def candidates(found: DataFrame) -> DataFrame:
    """One row (h, s, n, kinds, and one occurrence) of each segment; kinds: its anchor's different segments."""
    counted = found.groupBy("h", "s").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "th", "start", "len", "off")).alias("one"))
    kinds = counted.groupBy("h").agg(F.count("*").alias("kinds"))
    return counted.join(kinds, "h").select("h", "s", "n", "kinds", "one.*")


def pieces(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(h, s, off, data): the bytes of wanted segments; a repeated document gives its own more than once."""
    # Parts of a document are its own segments at most.
    parts = wanted.groupBy(F.col("doc_id").alias("k_id"), F.col("th").alias("k_th")).agg(F.collect_list(F.struct("h", "s", "start", "len", "off")).alias("parts"))
    texts = _join_docs(_keyed(docs).select("doc_id", "th", F.encode(whole_text(), "utf-8").alias("data")), parts, "inner")
    return texts.select("data", F.explode("parts").alias("p")).select("p.h", "p.s", "p.off", F.expr("substring(data, cast(p.start + 1 as int), p.len)").alias("data"))


def constructed(rows_of: DataFrame, length: int, gram: int, folder: str) -> DataFrame:
    """(h, s, cover) of the rows (h, s, off, data), of which those with one h go through one construction."""

    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, bytes]] = []

        def flush() -> pa.RecordBatch:
            groups = np.unique(np.array([r[0] for r in held]), return_inverse=True)[1]
            spans = repeated(groups, [r[3] for r in held], np.array([r[2] for r in held]), length, gram, folder)
            out = [(r[0], r[1], c) for r, c in zip(held, spans, strict=True) if c]
            return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate((pa.int64(), pa.int64(), pa.list_(pa.int32())))], ["h", "s", "cover"])

        for batch in rows:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and row[:2] == held[-1][:2]:  # a repeated document gave it twice
                    continue
                if len(held) >= ROWS and row[0] != held[-1][0]:
                    yield flush()
                    held = []
                held.append(row)
        if held:
            yield flush()

    placed = rows_of.select("h", "s", "off", "data").repartition("h").sortWithinPartitions("h", "s")
    return placed.mapInArrow(run, COVER)


def slices(n: int, off: int, length: int, gram: int, width: int) -> Iterator[tuple[int, int, int, int]]:
    """(a, b, from, to) of each slice of a segment of n bytes: the bytes of its windows that begin a to b bytes before the anchor."""
    for a in range(0, length - gram + 1, width):
        b = min(a + width - 1, length - gram)
        first, last = max(a, off + length - n), min(b, off)
        if first <= last:
            yield a, b, off - last, off - first + length


def sliced(segments_: DataFrame, length: int, gram: int, width: int) -> DataFrame:
    """(g, t, h, s, at, len, off): the slices of each segment.

    g is a hash of the bytes that all windows of the slice have, so equal windows have equal g; g and t
    together are the hash of the slice, which begins at byte `at` of the segment.
    """

    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest

        kinds = (*[pa.int64()] * 4, *[pa.int32()] * 3)
        for batch in rows:
            out = []
            for h, s, off, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for a, b, start, end in slices(len(data), off, length, gram, width):
                    core, own = data[off - a : off + length - b], data[start:end]
                    out.append((xxh3_64_intdigest(core, a) - (1 << 63), xxh3_64_intdigest(own, length + off - start) - (1 << 63), h, s, start, end - start, off - start))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["g", "t", "h", "s", "at", "len", "off"])

    return segments_.select("h", "s", "off", "data").mapInArrow(run, "g bigint, t bigint, h bigint, s bigint, at int, len int, off int")


def windows(rows_of: DataFrame, length: int) -> DataFrame:
    """(h, s, w, at): the 128-bit hash of each window of the rows (h, s, off, data), told apart by its place before the anchor."""

    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        for batch in rows:
            out = [(h, s, xxh3_128_digest(data[i : i + length], off - i), i) for h, s, off, data in zip(*(c.to_pylist() for c in batch.columns), strict=True) for i in range(len(data) - length + 1)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.binary(), pa.int32()), strict=True)], ["h", "s", "w", "at"])

    return rows_of.select("h", "s", "off", "data").mapInArrow(run, "h bigint, s bigint, w binary, at int")


def hot_covers(segments_: DataFrame, length: int, gram: int, folder: str, written: list[DataFrame]) -> DataFrame:
    """(h, s, cover) of anchors with any number of different segments.

    Segments are cut into slices of SLICE windows. Equal slices are counted before they meet; slices that
    share no bytes with another go. Up to HOT different slices with the same common bytes go through one construction; where
    there are more, they are cut once more, into slices of one window: those of a group are equal whole, so counting
    them is all there is to construct. Tables written here are added to `written`.
    """

    def write(df: DataFrame, name: str) -> DataFrame:
        written.append(materialize(df, name))
        return written[-1]

    segments_ = write(segments_.dropDuplicates(["h", "s"]), "hot")
    index = write(sliced(segments_, length, gram, SLICE), "slices")
    counted = index.groupBy("g", "t").agg(F.count("*").alias("n"), F.min(F.struct("h", "s", "at", "len", "off")).alias("one"))
    groups = counted.groupBy("g").agg(F.count("*").alias("kinds"), F.sum("n").alias("total")).where("total > 1").select("g", "kinds")
    found = write(counted.join(groups, "g").select("g", "t", "n", "kinds", "one.*"), "groups")
    cut = F.expr("substring(data, at + 1, len)")
    bytes_of = lambda rows: rows.join(segments_.select("h", "s", "data"), ["h", "s"]).select(F.col("g").alias("h"), F.col("t").alias("s"), "off", cut.alias("data"))
    several = constructed(bytes_of(found.where(F.col("kinds").between(2, HOT))), length, gram, folder)
    single = write(windows(bytes_of(found.where(F.col("kinds") > HOT)), length), "windows")
    again = single.groupBy("h", "w").agg(F.count("*").alias("n")).where("n > 1").select("h", "w")
    pairs = F.flatten(F.transform(F.collect_list("at"), lambda x: F.array(x, x + length)))  # SLICE windows at most
    many = single.join(again, ["h", "w"]).groupBy("h", "s").agg(pairs.alias("cover"))
    whole = found.where("n > 1").select(F.col("g").alias("h"), F.col("t").alias("s"), F.array(F.lit(0), F.col("len")).alias("cover"))
    covered = several.unionByName(many).unionByName(whole).select(F.col("h").alias("g"), F.col("s").alias("t"), "cover")
    return index.join(covered, ["g", "t"]).select("h", "s", F.transform("cover", lambda x: x + F.col("at")).alias("cover"))


def covers(docs: DataFrame, twice: DataFrame, length: int, gram: int, folder: str, written: list[DataFrame]) -> DataFrame:
    """(h, s, cover): for each segment with a repeated window, spans [from, to, ...] inside it; a segment may have several rows."""
    # A segment found twice is covered whole; its bytes are needed for the others of its anchor.
    whole = twice.where("n > 1").select("h", "s", F.array(F.lit(0), F.col("len")).alias("cover"))
    found = constructed(pieces(docs, twice.where(F.col("kinds").between(2, HOT))), length, gram, folder).unionByName(whole)
    hot = twice.where(F.col("kinds") > HOT)
    if hot.limit(1).count():
        found = found.unionByName(hot_covers(pieces(docs, hot), length, gram, folder, written))
    return found


def spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(k_id, k_th, spans): what is removed of each document that loses bytes, as [from, to, ...] pieces that may overlap.

    Each step is written, so that the shuffle files of the one before can go.
    """
    spark = docs.sparkSession
    # Most anchors are found once: eight bytes of each are shuffled here, and none of their segments are written.
    again = materialize(anchors(docs, length, gram).groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "anchors")
    release(spark)
    found = materialize(occurrences(docs, length, gram).join(again.hint("merge"), "h", "left_semi"), "occurrences")
    discard(again)
    release(spark)
    twice = materialize(candidates(found), "segments")
    release(spark)
    written: list[DataFrame] = []
    folder = new_path(spark, "columns")
    covered = materialize(covers(docs, twice, length, gram, folder, written), "covers")
    delete(spark, folder)
    for table in (twice, *written):
        discard(table)
    release(spark)
    absolute = F.transform("cover", lambda x: x + F.col("start"))
    # One row of a segment with many occurrences meets them; the skewed side is split as the join needs.
    hits = found.select("h", "s", "doc_id", "th", "start").join(covered, ["h", "s"])
    removed = materialize(hits.select(F.col("doc_id").alias("k_id"), F.col("th").alias("k_th"), absolute.alias("c")).groupBy("k_id", "k_th").agg(F.flatten(F.collect_list("c")).alias("spans")), "spans")
    discard(found)
    discard(covered)
    release(spark)
    return removed


def _cut(text: str, covered: list[int] | None) -> tuple[bytes, bytes, list[int]]:
    """The text's bytes, those that stay, and the removed runs."""
    data = text.encode("utf-8", "surrogatepass")
    if not covered:
        return data, data, []
    pairs = np.array(covered).reshape(-1, 2)
    runs = union(pairs[:, 0], pairs[:, 1])
    edges = [0, *runs, len(data)]
    return data, b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)), runs


def digest(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row."""

    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            out = []
            for text, covered in zip(batch.column(1), batch.column(2), strict=True):
                data, kept, runs = _cut(text.as_py(), covered.as_py())
                out.append((len(data), len(data) - len(kept), len(runs) // 2, hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*out, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    joined = _join_docs(_keyed(docs), spans(docs, length, gram), "left").select("doc_id", whole_text().alias("text"), "spans")
    return joined.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def whole_words(data: bytes, a: int, b: int) -> int:
    """Words of data that lie wholly in bytes a to b."""
    n = len(data[a:b].split())
    inside = lambda i: 0 < i < len(data) and not data[i - 1 : i].isspace() and not data[i : i + 1].isspace()
    return max(0, n - inside(a) - inside(b))


def remove(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, over_words: int = 0) -> DataFrame:
    """docs with the removed bytes cut out of text; characters that lose some of their bytes go with them. n_chars, if there, follows.

    With over_words, only runs of more than so many whole words go; a run of w words has 2w - 1 bytes at least.
    """
    from pyspark.sql.types import StringType

    @F.udf(StringType(), useArrow=True)
    def cut(text: str, covered: list[int] | None) -> str:
        data, kept, runs = _cut(text, covered)
        if over_words and runs:
            long = [x for a, b in zip(runs[::2], runs[1::2], strict=True) if whole_words(data, a, b) > over_words for x in (a, b)]
            kept = _cut(text, long)[1]
        return kept.decode("utf-8", "ignore")

    # The text goes along once, outside of the other columns.
    joined = _join_docs(_keyed(docs, packed(docs, ("text",))), spans(docs, length, gram), "left")
    lost = F.col("spans").isNotNull()
    found = joined.select("row", lost.alias("lost"), F.when(lost, cut(whole_text(), "spans")).otherwise(F.col("text")).alias("text"))
    again = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        again["n_chars"] = F.when(F.col("lost"), F.length("text").cast("bigint")).otherwise(F.col(f"row.c{docs.columns.index('n_chars')}"))
    return found.select(*unpacked(docs.columns, **again))
