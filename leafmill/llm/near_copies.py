"""Near copies: classes of texts whose sets of word shingles have a Jaccard similarity, one row of each stays.

simhash   The SimHash operator links fingerprints (of the same shingles) through its popcount grid; each such pair
          is held against the texts, so a link of fingerprints alone removes nothing.
complete  A pair of similarity 0.8 differs in about ten bits of 64, far beyond any radius at which a grid of fingerprints
          has small cells, so what the grid can't see is found by prefixes: two sets that similar share one of the first
          shingles of each. Pairs of one class already aren't looked at again.

Null texts are empty; texts without words are copies of one another. Of a class, the row with the least doc_id stays,
then that with the least key (128 bits of SHA-256) of the text; rows without doc_id come after the others. Repeated rows
leave one. An empty table gives no rows. Other columns stay as they are, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm import simhash
from leafmill.llm.shared import discard, materialize, packed, release, text_key, unpacked, whole_text
from leafmill.llm.simhash import components, hashes_of, whole_cells

SHINGLE, SIMILARITY = 5, 0.8
#: Counts of a text's shingles by hash.
COUNTS = 512
#: Points of a cell that others are held against in the first round after the grid, and with how many of them each point is paired.
HUBS, HUBS_TRIED = 8, 3
#: One text in SAMPLED is looked at for common shingles; those found in COMMON of them are common, MOST_COMMON at most.
SAMPLED, COMMON, MOST_COMMON = 16, 4, 100_000
_NEAR = 1e-9


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """Rising 64-bit hashes of the different shingles of a text."""
    return np.unique(hashes_of(text, shingle))


def common_shingles(docs: DataFrame, shingle: int) -> np.ndarray:
    """Rising hashes of shingles that many different texts have; only the order in prefixes depends on them, never the result."""

    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for t in batch.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(t.as_py(), shingle).view(np.int64))], ["t"])

    some = docs.select(whole_text().alias("text")).where(F.expr(f"pmod(xxhash64(text), {SAMPLED}) = 0")).distinct()
    found = some.mapInArrow(run, "t bigint").groupBy("t").count().where(F.col("count") >= COMMON).orderBy(F.desc("count"), "t").limit(MOST_COMMON)
    return np.sort(np.array([r["t"] for r in found.collect()], np.int64).view(np.uint64))


def shingled(docs: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """doc_id, th (the text's key), fp (its fingerprint), node (the hash of its shingle set), n (its size), prefix and counts of every row.

    prefix: the first shingles of the set, common ones last; two sets of that similarity share one of
    them. counts: shingles by their hash modulo COUNTS, 255 at most.
    """
    common = docs.sparkSession.sparkContext.broadcast(common_shingles(docs, shingle))

    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest

        often = common.value
        for batch in rows:
            fps, nodes, sizes, prefixes, counts = [], [], [], [], []
            for t in batch.column(2):
                hashes = hashes_of(t.as_py(), shingle)
                fps.append(simhash.fingerprint_of(hashes))
                found = np.unique(hashes)
                n = len(found)
                late = often[np.minimum(np.searchsorted(often, found), len(often) - 1)] == found if len(often) else np.zeros(n, bool)
                order = np.concatenate([found[~late], found[late]])
                nodes.append(xxh3_64_intdigest(found.tobytes()) - (1 << 63))
                sizes.append(n)
                prefixes.append(order[: n - math.ceil(similarity * n - _NEAR) + 1 if n else 0].view(np.int64))
                counts.append(np.minimum(np.bincount((found % np.uint64(COUNTS)).astype(np.int64), minlength=COUNTS), 255).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.array(fps, np.uint64).view(np.int64)), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int32()), pa.array(prefixes, pa.list_(pa.int64())), pa.array(counts, pa.binary())], ["doc_id", "th", "fp", "node", "n", "prefix", "counts"])

    texts = docs.select("doc_id", text_key(whole_text()).alias("th"), whole_text().alias("text"))
    return texts.mapInArrow(run, "doc_id bigint, th binary, fp bigint, node bigint, n int, prefix array<bigint>, counts binary")


def shared_cells(points: DataFrame) -> DataFrame:
    """(t, node, n, at): the prefix shingles that several points have; at: the place in the prefix."""

    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in whole_cells(rows):
            t = columns[0]
            same = t[1:] == t[:-1]
            keep = np.append(same, False) | np.append(False, same)
            yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in columns], ["t", "node", "n", "at"])

    placed = points.select("node", "n", F.posexplode("prefix").alias("at", "t")).select("t", "node", "n", "at")
    return placed.repartition("t").sortWithinPartitions("t").mapInArrow(run, "t bigint, node bigint, n int, at int")


def possible(n: np.ndarray, at: np.ndarray, m: np.ndarray, place: np.ndarray, similarity: float) -> np.ndarray:
    """Whether sets of n and m shingles whose first common one is at these places can be that similar."""
    least = np.ceil(similarity / (1 + similarity) * (n + m) - _NEAR)
    return (np.minimum(n, m) >= similarity * np.maximum(n, m) - _NEAR) & (1 + np.minimum(n - at - 1, m - place - 1) >= least)


def chosen_pairs(cells: DataFrame, similarity: float, hubs: int) -> DataFrame:
    """(a, b): pairs of each point and a few of its cell, where they aren't in one class yet. Any pairs would do here.

    hubs: so many points with most links (degree) are paired with the others; 0: any points of the cell.
    """

    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, node, n, at, label, degree in whole_cells(rows):
            order = np.lexsort((node, -degree, t))
            t, node, n, at, label = t[order], node[order], n[order], at[order], label[order]
            _, first, which, size = np.unique(t, return_index=True, return_inverse=True, return_counts=True)
            mixed = ((node if hubs else node ^ t).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
            for k in range(HUBS_TRIED if hubs else 1):
                other = first[which] + ((mixed + np.uint64(k)) % (np.minimum(size, hubs) if hubs else size)[which].astype(np.uint64)).astype(np.int64)
                i = np.flatnonzero((label != label[other]) & possible(n, at, n[other], at[other], similarity))
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(node[i], node[other[i]])), pa.array(np.maximum(node[i], node[other[i]]))], ["a", "b"])

    return cells.repartition("t").sortWithinPartitions("t").mapInArrow(run, "a bigint, b bigint").distinct()


def all_pairs(cells: DataFrame, similarity: float) -> DataFrame:
    """(a, b): all pairs of a cell that can be similar and aren't in one class (label) yet."""

    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, node, n, at, label, _ in whole_cells(rows):
            order = np.lexsort((n, t))
            t, node, n, at, label = t[order], node[order], n[order], at[order], label[order]
            edges = np.concatenate([[0], np.flatnonzero(t[1:] != t[:-1]) + 1, [len(t)]])
            for x, y in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if (label[x:y] == label[x]).all():
                    continue
                for i in range(x, y - 1):
                    j = np.flatnonzero((label[i + 1 : y] != label[i]) & possible(n[i], at[i], n[i + 1 : y], at[i + 1 : y], similarity)) + i + 1
                    if len(j):
                        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(node[i], node[j])), pa.array(np.maximum(node[i], node[j]))], ["a", "b"])

    return cells.repartition("t").sortWithinPartitions("t").mapInArrow(run, "a bigint, b bigint").distinct()


def similar(pairs: DataFrame, points: DataFrame, docs: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """The pairs (a, b) whose shingle sets have that Jaccard similarity: those that their counts allow are compared whole."""

    def allowed(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            if not len(batch):
                continue
            one, two = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, COUNTS).astype(np.int16) for i in (2, 3))
            total = batch.column(4).to_numpy()
            # The sets differ in as many shingles as their counts at least.
            keep = np.abs(one - two).sum(axis=1) <= (1 - similarity) / (1 + similarity) * total + _NEAR
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep)), batch.column(1).filter(pa.array(keep))], ["a", "b"])

    def compare(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, one = None, np.zeros(0, np.uint64)
        for batch in rows:
            keep = []
            for a, x, y in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3), strict=True):
                if a != last:
                    last, one = a, shingle_set(x.as_py(), shingle)
                two = shingle_set(y.as_py(), shingle)
                both = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(both >= similarity * (len(one) + len(two) - both) - _NEAR)
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(keep, pa.bool_())) for i in (0, 1)], ["a", "b"])

    side = lambda df, name, *columns: df.select(F.col("node").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in columns])
    counted = pairs.join(side(points, "a", "counts", "n"), "a").join(side(points, "b", "counts", "n"), "b")
    left = materialize(counted.select("a", "b", "counts_a", "counts_b", (F.col("n_a") + F.col("n_b")).alias("n")).mapInArrow(allowed, "a bigint, b bigint"), "pairs")
    nodes = left.select(F.col("a").alias("node")).union(left.select("b")).distinct()
    reps = points.join(nodes, "node").select("node", F.col("rep.doc_id").alias("r_id"), F.col("rep.th").alias("r_th"))
    texts = docs.select("doc_id", text_key(whole_text()).alias("th"), whole_text().alias("text")).join(reps, F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("th") == F.col("r_th"))).select("node", "text")
    texts = materialize(texts.dropDuplicates(["node"]), "texts")
    both = left.join(side(texts, "a", "text"), "a").join(side(texts, "b", "text"), "b").select("a", "b", "text_a", "text_b")
    found = materialize(both.mapInArrow(compare, "a bigint, b bigint"), "links")
    discard(left)
    discard(texts)
    return found


def grid_pairs(points: DataFrame) -> DataFrame:
    """(a, b): the points whose fingerprints the SimHash operator links, and those with one fingerprint, as a star for each fingerprint."""
    first = materialize(points.groupBy("fp").agg(F.min("node").alias("first")), "first")
    linked = simhash.links(first.select("fp"))
    ends = linked.join(first.select(F.col("fp").alias("a"), F.col("first").alias("one")), "a").join(first.select(F.col("fp").alias("b"), F.col("first").alias("two")), "b")
    alike = points.select("fp", "node").join(first, "fp").where("node <> first").select(F.col("first").alias("one"), F.col("node").alias("two"))
    return ends.select("one", "two").union(alike).select(F.least("one", "two").alias("a"), F.greatest("one", "two").alias("b"))


def deduplicate(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """docs with one row of each class: that of the least doc_id, then of the least hash of the text.

    Links are pairs of texts whose sets of shingles have that Jaccard similarity. The first round takes the pairs of the
    SimHash grid; the next ones pair the points of a prefix cell with the best linked ones and with any others of it, the
    last takes all pairs that can be similar and that these didn't join.
    """
    spark = docs.sparkSession
    rows = materialize(shingled(docs, shingle, similarity), "shingled")
    rep = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "th")).alias("rep")
    points = materialize(rows.groupBy("node").agg(rep, F.min("fp").alias("fp"), F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.first("counts").alias("counts")), "points")
    discard(rows)
    release(spark)
    cells = materialize(shared_cells(points), "cells")
    release(spark)
    found = similar(grid_pairs(points).distinct(), points, docs, shingle, similarity)
    for hubs in (HUBS, 0, None):
        label = components(found)
        degree = found.select(F.col("a").alias("node")).union(found.select("b")).groupBy("node").agg(F.count("*").alias("degree"))
        labelled = cells.join(label.join(degree, "node"), "node", "left").select("t", "node", "n", "at", F.coalesce("label", "node").alias("label"), F.coalesce("degree", F.lit(0)).alias("degree"))
        pairs = all_pairs(labelled, similarity) if hubs is None else chosen_pairs(labelled, similarity, hubs)
        found = found.union(similar(pairs, points, docs, shingle, similarity))
        discard(label)
        release(spark)
    label = components(found)
    named = points.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    kept = materialize(named.groupBy("label").agg(F.min("rep").alias("rep")).select(F.col("rep.doc_id").alias("k_id"), F.col("rep.th").alias("k_th")), "kept")
    for table in (cells, points, label):
        discard(table)
    release(spark)
    named = docs.select("doc_id", text_key(whole_text()).alias("th"), packed(docs))
    chosen = named.join(kept, F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("th") == F.col("k_th")), "left_semi")
    return chosen.dropDuplicates(["doc_id", "th"]).select(*unpacked(docs.columns))
