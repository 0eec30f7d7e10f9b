"""SimHash near-duplicates: fingerprints, a grid over segment popcounts, and connected classes.

fingerprint   A-Z lower-cased, words split at white space, k-word shingles with repeats, XXH64 (seed
              42); a bit is 1 if set in over half the hashes. Fewer than k words: the whole sequence is
              one shingle; none: fingerprint zero, linked like any other.
embedding     A fingerprint becomes the bit counts of its 32 segments of SEGMENT bits. Changing one bit changes
              one count by one, so the Manhattan distance of counts is a lower bound of the differing bits.
              Counts are kept in unary (the bits of each segment sorted): that distance is then the number of
              differing bits of two such words.
grid          The segments are dealt into radius // 2 + 1 groups, so a pair within `radius` is within 1 in the
              counts of some group. A cell is one vector of a group's counts. Range join: each point is at
              home in its cell of every group and visits the cells where one of the counts is larger by one;
              homes of a cell are held against its homes and visitors, first by the Manhattan distance of all
              counts, then bit by bit.
hot cells     A cell with over CELL points is cut in the plan, before anything meets in a task: its points go on by
              the counts of radius + 1 parts of the other groups' segments, of which a pair within `radius` shares one,
              and again, LEVELS times at most. What still is in one cell then has nearly all counts in common.
classes       Each task gives a spanning forest of its links, never all pairs; labels spread over these
              edges between distinct fingerprints with pointer jumping, each round written to the shared
              folder.

Null texts are empty. Repeated rows share a fingerprint, so they are one point. An empty table gives
no rows. Rows with null doc_id take part; component_id is the least doc_id that isn't null, else null.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.shared import discard, materialize, whole_text

SHINGLE, RADIUS = 3, 3
#: Bits of a segment. Wider ones make cells coarser (eight of 8 bits tell 2**20 cells apart, 32 of 2 bits 2**48).
SEGMENT = 2
#: Points of a cell that meet in one task without further cuts, and cuts at most.
CELL, LEVELS = 1024, 3
_LOW = np.uint64(0x5555555555555555)


def hashes_of(text: str | None, shingle: int) -> np.ndarray:
    """XXH64 of the shingles of a text, repeats included."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) < shingle:
        return np.array([xxh64_intdigest(joined, 42)], np.uint64)
    ends = (np.cumsum([len(w) + 1 for w in words]) - 1).tolist()
    return np.array([xxh64_intdigest(joined[a:b], 42) for a, b in zip([0, *[e + 1 for e in ends[:-1]]], ends[shingle - 1 :])], np.uint64)  # noqa: B905


def fingerprint_of(hashes: np.ndarray) -> int:
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i : i + (1 << 16)].astype("<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    return fingerprint_of(hashes_of(text, shingle))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of every row."""

    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            found = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], ["doc_id", "fp"])

    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(run, "doc_id bigint, fp bigint")


def embed(fps: np.ndarray) -> np.ndarray:
    """Counts of the 2-bit segments of unsigned fingerprints in unary: 00, 01 or 11. differing() of two gives their Manhattan distance."""
    one, two = fps & _LOW, (fps >> np.uint64(1)) & _LOW
    return (one | two) | (one & two) << np.uint64(1)


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


class Grid:
    """The groups of segments for a radius: cells are `group << 56 | unary counts of the group`."""

    def __init__(self, radius: int):
        self.radius = radius
        n = max(2, radius // 2 + 1)
        edges = [SEGMENT * (64 // SEGMENT * i // n) for i in range(n + 1)]
        self.groups = [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]

    def cell(self, counts: np.ndarray, group: int) -> np.ndarray:
        first, bits = self.groups[group]
        return ((counts >> np.uint64(first)) & np.uint64((1 << bits) - 1)) | np.uint64(group << 56)

    def homes(self, fps: np.ndarray) -> np.ndarray:
        """(groups, points): the cell of each point in each group."""
        counts = embed(fps)
        return np.stack([self.cell(counts, g) for g in range(len(self.groups))])

    def above(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which, cell): the cells with one count larger by one, for each of `cells`."""
        which, found = [], []
        group = cells >> np.uint64(56)
        for g, (_, bits) in enumerate(self.groups):
            own = np.flatnonzero(group == np.uint64(g))
            for k in range(0, bits, SEGMENT):
                count = cells[own] >> np.uint64(k) & np.uint64(3)
                able = own[count != 3]
                found.append(cells[able] | np.uint64(1) << (np.uint64(k) + (count[count != 3] & np.uint64(1))))
                which.append(able)
        return np.concatenate(which), np.concatenate(found)

    def at_home(self, cells: np.ndarray, fps: np.ndarray) -> np.ndarray:
        homes = self.homes(fps)
        return homes[(cells >> np.uint64(56)).astype(np.int64), np.arange(len(fps))] == cells

    def free(self, group: int) -> int:
        """The bits of the other groups."""
        first, bits = self.groups[group]
        return ((1 << 64) - 1) ^ (((1 << bits) - 1) << first)

    def parts(self, free: int) -> list[int]:
        """Masks of radius + 1 parts of the segments in `free`; none if there are too few."""
        segments = [k for k in range(0, 64, SEGMENT) if free >> k & 1]
        n = self.radius + 1
        if len(segments) < 2 * n:
            return []
        edges = [len(segments) * i // n for i in range(n + 1)]
        return [sum(3 << k for k in segments[a:b]) for a, b in zip(edges, edges[1:], strict=False)]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


def _unsigned(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


class Forest:
    """Union-find over points 0 to n-1 that keeps the links which joined two classes."""

    def __init__(self, n: int):
        self.root = np.arange(n)
        self.links: list[np.ndarray] = []

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.root[a], self.root[b]
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            if not len(a):
                return
            high, low = np.maximum(ra, rb), np.minimum(ra, rb)
            _, one = np.unique(high, return_index=True)  # a root is hung on one other at a time
            self.root[high[one]] = low[one]
            self.links.append(np.stack([a[one], b[one]], axis=1))
            while not np.array_equal(up := self.root[self.root], self.root):
                self.root = up

    def all(self) -> np.ndarray:
        return np.concatenate(self.links) if self.links else np.zeros((0, 2), np.int64)


def join_cells(cell: np.ndarray, home: np.ndarray, fps: np.ndarray, radius: int) -> np.ndarray:
    """(a, b): places of a spanning forest of the links between the homes of a cell and its other points. cell: numbers that rise.

    Points of a cell are taken at growing distances in the list; cells whose points are all linked drop out.
    """
    order = np.lexsort((~home, cell))
    cell, home, fps = cell[order], home[order], fps[order]
    counts, forest = embed(fps), Forest(len(fps))
    starts = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
    ends = np.append(starts[1:], len(cell))
    which = np.repeat(np.arange(len(starts)), ends - starts)
    live, lag = np.flatnonzero(home), 1
    while len(live := live[live + lag < ends[which[live]]]):
        for s in range(0, len(live), 1 << 18):
            i = live[s : s + (1 << 18)]
            i = i[differing(counts[i], counts[i + lag]) <= radius]
            i = i[differing(fps[i], fps[i + lag]) <= radius]
            forest.add(i, i + lag)
        lag += 1
        if lag >= 32 and lag & (lag - 1) == 0:
            open_ = np.minimum.reduceat(forest.root, starts) != np.maximum.reduceat(forest.root, starts)
            live = live[open_[which[live]]]
    return order[forest.all()]


def hot_cells(points: DataFrame, grid: Grid) -> DataFrame:
    """`cell` of the cells that over CELL points are at home in or visit.

    Counted from the homes: points come from 17 cells at most, so a cell has so many only if one of these has over
    CELL / 17 homes, and only such cells pass their numbers on. A cell that isn't hot has less than twice CELL.
    """

    def homes(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            yield pa.RecordBatch.from_arrays([_signed(np.ascontiguousarray(grid.homes(_unsigned(batch.column(0)))).ravel())], ["cell"])

    def spread(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            cells, n = _unsigned(batch.column(0)), batch.column(1).to_numpy()
            which, above = grid.above(cells)
            yield pa.RecordBatch.from_arrays([_signed(np.concatenate([cells, above])), pa.array(np.concatenate([n, n[which]]))], ["cell", "n"])

    counted = points.select("fp").mapInArrow(homes, "cell bigint").groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > CELL // 17)
    return counted.mapInArrow(spread, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).where(F.col("n") > CELL).select("cell")


def links(points: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): a spanning forest, for each task, of the distinct fingerprints `fp` within `radius` bits."""
    grid = Grid(radius)
    schema = "cell bigint, sub bigint, free bigint, fp bigint"
    names = ["cell", "sub", "free", "fp"]
    mix = np.uint64(0x9E3779B97F4A7C15)

    def place(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free = np.array([grid.free(g) for g in range(len(grid.groups))], np.uint64)
        for batch in rows:
            for a in range(0, len(batch), 10_000):
                fps = _unsigned(batch.column(0).slice(a, 10_000))
                homes = grid.homes(fps).ravel()
                own = np.tile(fps, len(grid.groups))
                which, above = grid.above(homes)
                cells = np.concatenate([homes, above])
                yield pa.RecordBatch.from_arrays([_signed(cells), pa.array(np.zeros(len(cells), np.int64)), _signed(free[(cells >> np.uint64(56)).astype(np.int64)]), _signed(np.concatenate([own, own[which]]))], names)

    def refine(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            cell, sub, free, fps = (_unsigned(c) for c in batch.columns)
            counts = embed(fps)
            for mask in np.unique(free).tolist():
                own = np.flatnonzero(free == np.uint64(mask))
                for k, part in enumerate(grid.parts(mask) or [0]):  # too few segments are left: the cell stays whole
                    key = ((counts[own] & np.uint64(part)) * mix ^ sub[own] ^ np.uint64(k + 1)) * mix
                    key ^= key >> np.uint64(31)
                    yield pa.RecordBatch.from_arrays([_signed(cell[own]), _signed(key | np.uint64(1)), _signed(np.full(len(own), mask & ~part, np.uint64)), _signed(fps[own])], names)

    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell, sub, fp in whole_cells(rows, 2, 200_000):
            fps = fp.view(np.uint64)
            home = grid.at_home(cell.view(np.uint64), fps)
            at = np.cumsum(np.append(0, (cell[1:] != cell[:-1]) | (sub[1:] != sub[:-1])))
            found = join_cells(at, home, fps, radius)
            if len(found):
                yield pa.RecordBatch.from_arrays([pa.array(fp[found[:, 0]]), pa.array(fp[found[:, 1]])], ["a", "b"])

    placed = points.select("fp").mapInArrow(place, schema)
    hot, keys, done = materialize(hot_cells(points, grid), "hot-cells"), ["cell"], []
    for level in range(LEVELS):
        if not hot.limit(1).count():
            break
        done.append(placed.join(hot, keys, "left_anti").select(names))
        placed = materialize(placed.join(hot, keys, "left_semi").select(names).mapInArrow(refine, schema), "cells")
        keys = ["cell", "sub"]
        if level + 1 < LEVELS:
            hot = materialize(placed.groupBy(keys).agg(F.count("*").alias("n")).where(F.col("n") > CELL).select(keys), "hot-cells")
    for part in done:
        placed = placed.unionByName(part)
    return placed.select("cell", "sub", "fp").repartition("cell", "sub").sortWithinPartitions("cell", "sub").mapInArrow(run, "a bigint, b bigint")


def whole_cells(rows: Iterable[pa.RecordBatch], keys: int = 1, most: int = 100_000) -> Iterator[list[np.ndarray]]:
    """The columns of rows sorted by the first `keys`, about `most` rows at a time, with no value of these in two parts."""
    held: list[list[np.ndarray]] = []
    for batch in rows:
        if not len(batch):
            continue
        held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        if sum(len(h[0]) for h in held) >= most:
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            other = np.flatnonzero(np.any([c != c[-1] for c in columns[:keys]], axis=0))
            done = int(other[-1]) + 1 if len(other) else 0
            if done:
                yield [c[:done] for c in columns]
            held = [[c[done:] for c in columns]]
    if held:
        yield [np.concatenate(c) for c in zip(*held, strict=True)]


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the least node of each connected class, for the nodes that have edges."""
    both = materialize(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    label = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "labels")
    while True:
        near = both.join(label.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        least = label.join(near, label["node"] == near["a"]).select("node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        up = label.select(F.col("node").alias("label"), F.col("label").alias("up"))
        new = materialize(least.join(up, "label").select("node", "was", F.least("label", "up").alias("label")), "labels")
        moved = new.where("label <> was").limit(1).count()
        discard(label)
        label = new.select("node", "label")
        if not moved:
            discard(both)
            return label


def classes(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id (least doc_id of its class) of every row."""
    fps = materialize(fingerprints(docs, shingle), "fingerprints")
    points = fps.groupBy("fp").agg(F.min("doc_id").alias("first"))
    found = materialize(links(points, radius), "links")
    label = components(found)
    named = points.join(label.withColumnRenamed("node", "fp"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    least = named.groupBy("label").agg(F.min("first").alias("component_id"))
    of = materialize(named.join(least, "label").select("fp", "component_id"), "classes")
    discard(found)
    discard(label)
    return fps.join(of, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
