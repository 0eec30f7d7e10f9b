"""Toxicity by nearest labelled examples under exact TF-IDF cosine.

fit     At most TRAIN labelled rows, those whose hashed doc_id is least, are the examples: rows of both labels, with
        all their terms. Terms are words (lower case, punctuation stripped) and word beginnings of PREFIXES
        characters. A term's weight is its idf times FLOOR plus its association with label 1 (G-squared over FULL, 1
        at most, 0 for terms that go with label 0): no term is dropped, and those that tell nothing weigh a twentieth. Rows
        become unit vectors of (1 + log tf) * weight; terms that no example has can't match and don't count.
index   Examples with like terms lie together in blocks of BLOCK. The DENSE most frequent terms are kept as rows of
        each block, with the largest weight of each in the block; the other terms as postings. A query adds up its
        postings and each block's bound, opens the blocks with the largest bounds first, and then those whose
        bound reaches its NEIGHBOURS-th similarity. What is found is computed again in double precision: exact.
score   Votes of the nearest examples weighted by similarity (1 - distance), with PRIOR of the share of
        label 1 among all; a monotone map fitted on leave-one-out votes calibrates them. The neighbours that
        voted are the evidence.

Labels, lang, source and doc_id are no inputs of a score; with held_out_fifth, rows whose
crc32(doc_id as text) mod 5 is 0 never teach. Null and empty texts, and those without a known term, have the share of
label 1 as their score. Of repeated labels of a doc_id the largest counts; repeated documents score alike. Ties of
similarity go to the smaller doc_id. Without labels every score is 0. Other columns are ignored.
"""

from __future__ import annotations

import string
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.llm.shared import discard, materialize, whole_text

#: Labelled rows to learn from at most: a bounded fit, the same at every size.
TRAIN = 2500
PREFIXES = (4, 6)
#: Weight of a term without association, and G-squared of full association.
FLOOR, FULL = 0.05, 50.0
NEIGHBOURS, BLOCK, DENSE = 16, 64, 1024
#: Queries that are looked up together, and blocks that each opens first.
BATCH, FIRST = 128, 8
#: Similarities in single precision are off by less.
NEAR = 1e-5
#: Weight of the prior in a vote, as so much similarity.
PRIOR = 0.25
STRIP = string.punctuation + "«»“”„‘’…¿¡"
#: Words that a worker's cache holds at most.
CACHE = 50_000

SCHEMA = "doc_id bigint, score double, predicted int, evidence array<struct<doc_id: bigint, similarity: double, toxic: int>>"


def features_of(word: str) -> list[str]:
    """The features of a lower-case word between white space: itself, and its beginnings marked with a star."""
    word = word.strip(STRIP)
    return [word, *[f"{word[:n]}*" for n in PREFIXES if len(word) >= n]] if word else []


def terms(text: str) -> set[str]:
    """All terms of a text."""
    return {f for word in pc.utf8_split_whitespace(pc.utf8_lower(text)).as_py() for f in features_of(word) if f}


Vector = tuple[np.ndarray, np.ndarray]  # rising numbers of terms, weights


class Vectors:
    """Unit TF-IDF vectors over the terms of the examples."""

    def __init__(self, names: list[str], weights: np.ndarray):
        self.weights, self.cache = weights, {}
        self.words = {n: i for i, n in enumerate(names) if n[-1] != "*"}
        self.beginnings = {n[:-1]: i for i, n in enumerate(names) if n[-1] == "*"}

    def __getstate__(self):
        return self.__dict__ | {"cache": {}}

    def known(self, word: str) -> list[int]:
        """Numbers of the features of a word that examples have: without its shortest beginning they have none of it."""
        word, found = word.strip(STRIP), []
        for n in PREFIXES:
            if len(word) < n:
                break
            i = self.beginnings.get(word[:n])
            if i is None:
                return found
            found.append(i)
        i = self.words.get(word)
        return found if i is None else [*found, i]

    def __call__(self, texts: list[str | None]) -> list[Vector]:
        """The vector of each text. The different words of all are looked up once."""
        found: list[Vector] = []
        for a in range(0, len(texts), 8 * BATCH):
            found += self._together(texts[a : a + 8 * BATCH])
        return found

    def _together(self, texts: list[str | None]) -> list[Vector]:
        words = pc.utf8_split_whitespace(pc.utf8_lower(pa.array([t or "" for t in texts], pa.large_string())))
        edges, flat = words.offsets.to_numpy(), words.flatten().dictionary_encode()
        cache = self.cache
        if len(cache) > CACHE:
            cache.clear()
        features = []
        for word in flat.dictionary.to_pylist():
            known = cache.get(word)
            if known is None:
                known = cache[word] = self.known(word)
            features.append(known)
        sizes, ids = np.array([len(x) for x in features], np.int64), np.array([i for x in features for i in x], np.int64)
        ends, word = np.cumsum(sizes), flat.indices.to_numpy()
        length = sizes[word]
        upto = np.cumsum(length)
        if not len(upto) or not upto[-1]:
            return [(np.zeros(0, np.int64), np.zeros(0))] * len(texts)
        term = ids[np.arange(upto[-1]) + np.repeat(ends[word] - upto, length)]
        cuts, out = np.append(0, upto)[edges], []
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            own, counts = np.unique(term[a:b], return_counts=True)
            x = (1 + np.log(counts)) * self.weights[own]
            out.append((own, x / np.sqrt(x @ x) if len(x) else x))
        return out


class BlockMaxIndex:
    """Exact top-k by dot product over unit vectors without negative weights."""

    def __init__(self, rows: list[tuple[int, int, np.ndarray, np.ndarray]], block: int = BLOCK, dense: int = DENSE):
        """rows: doc_id, label, numbers and weights of the terms of each example."""
        rows = sorted(rows, key=lambda r: (r[2][np.lexsort((r[2], -r[3]))[:3]].tolist(), r[0]))
        self.n, self.docs, self.labels = len(rows), [r[0] for r in rows], [r[1] for r in rows]
        sizes = np.array([len(r[2]) for r in rows], np.int64)
        self.starts = np.append(0, np.cumsum(sizes))
        self.ids = np.concatenate([np.zeros(0, np.int32), *[r[2] for r in rows]]).astype(np.int32)
        self.weights = np.concatenate([np.zeros(0, np.float32), *[r[3] for r in rows]]).astype(np.float32)
        self.n_terms = int(self.ids.max()) + 1 if len(self.ids) else 0
        found = np.bincount(self.ids, minlength=self.n_terms)
        common = np.argsort(-found, kind="stable")[:dense]
        self.column = np.full(self.n_terms, -1, np.int32)
        self.column[common] = np.arange(len(common))
        owner, column = np.repeat(np.arange(self.n, dtype=np.int32), sizes), self.column[self.ids]
        held = column >= 0
        self.blocks = -(-self.n // block)
        matrix = np.zeros((self.blocks * block, len(common)), np.float32)
        matrix[owner[held], column[held]] = self.weights[held]
        self.matrix = matrix.reshape(self.blocks, block, len(common))
        self.largest = self.matrix.max(axis=1) if self.n else matrix
        order = np.argsort(self.ids[~held], kind="stable")
        self.posting, self.weight = owner[~held][order].astype(np.int64), self.weights[~held][order]
        self.first = np.searchsorted(self.ids[~held][order], np.arange(self.n_terms + 1))

    def nearest(self, queries: list[Vector], k: int, without: list[int] | None = None) -> list[list[tuple[float, int]]]:
        """(similarity, place) of the k nearest examples with similarity over 0 of each query, best first; ties by doc_id. without: a place that doesn't count for each."""
        if not self.n:
            return [[] for _ in queries]
        return [x for a in range(0, len(queries), BATCH) for x in self._together(queries[a : a + BATCH], k, None if without is None else without[a : a + BATCH])]

    def _together(self, queries: list[Vector], k: int, without: list[int] | None) -> list[list[tuple[float, int]]]:
        n, (blocks, block, columns) = len(queries), self.matrix.shape
        known = [(ids[keep], x[keep]) for ids, x in queries for keep in [ids < self.n_terms]]
        dense, sums = np.zeros((n, columns), np.float32), np.zeros((n, blocks * block), np.float32)
        for i, (ids, x) in enumerate(known):
            column = self.column[ids]
            held = column >= 0
            dense[i, column[held]] = x[held]
            rest = ids[~held]
            start, end = self.first[rest], self.first[rest + 1]
            length = end - start
            ends = np.cumsum(length)
            if len(ends) and ends[-1]:
                at = np.arange(ends[-1]) + np.repeat(end - ends, length)
                sums[i] = np.bincount(self.posting[at], np.repeat(x[~held], length) * self.weight[at], blocks * block)
        sums = sums.reshape(n, blocks, block)
        bound = dense @ self.largest.T + sums.max(axis=2)
        found, row = np.full((n, blocks, block), -1, np.float32), np.arange(n)

        def look(which: np.ndarray) -> np.ndarray:
            """Open blocks (query, block); the k-th similarity of each query so far."""
            for b in np.flatnonzero(which.any(axis=0)):
                own = np.flatnonzero(which[:, b])
                found[own, b] = dense[own] @ self.matrix[b].T + sums[own, b]
            flat = found.reshape(n, -1)
            if without is not None:
                flat[row, without] = -1
            return np.partition(flat, -min(k, flat.shape[1]), axis=1)[:, -min(k, flat.shape[1])]

        first = np.zeros((n, blocks), bool)
        first[row[:, None], np.argpartition(-bound, min(FIRST, blocks) - 1, axis=1)[:, :FIRST]] = True
        kth = look(first)
        kth = look(~first & (bound >= kth[:, None] - NEAR) & (bound > 0))
        out, whole = [], np.zeros(self.n_terms)
        for i, (ids, x) in enumerate(known):
            near = found[i].ravel()
            likely = np.flatnonzero(near >= max(kth[i] - NEAR, 1e-9)).tolist()
            if not likely:
                out.append([])
                continue
            whole[ids] = x
            spans = [(int(self.starts[p]), int(self.starts[p + 1])) for p in likely]
            terms_, weights = (np.concatenate([c[a:b] for a, b in spans]) for c in (self.ids, self.weights))
            edges = np.cumsum([0, *[b - a for a, b in spans[:-1]]])
            dots = np.add.reduceat(whole[terms_] * weights, edges).tolist()
            whole[ids] = 0
            exact = sorted((-round(s, 12), self.docs[p], p) for s, p in zip(dots, likely, strict=True))
            out.append([(-s, p) for s, _, p in exact[:k] if s < 0])
        return out


class Model:
    def __init__(self, vectors: Vectors, index: BlockMaxIndex, base: float, knots: tuple[list[float], list[float]]):
        self.vectors, self.index, self.base, self.knots = vectors, index, base, knots

    def vote(self, near: list[tuple[float, int]]) -> float:
        return (sum(s * self.index.labels[i] for s, i in near) + PRIOR * self.base) / (sum(s for s, _ in near) + PRIOR)

    def scores(self, texts: list[str | None]) -> list[tuple[float, list[tuple[float, int]]]]:
        """Score and evidence of each text; equal ones are looked up once, some at a time."""
        different, made = list(dict.fromkeys(texts)), {}
        for a in range(0, len(different), 8 * BATCH):
            part = different[a : a + 8 * BATCH]
            for t, near in zip(part, self.index.nearest(self.vectors(part), NEIGHBOURS), strict=True):
                made[t] = (min(1.0, max(0.0, float(np.interp(self.vote(near), *self.knots)))) if near else self.base, near)
        return [made[t] for t in texts]


def monotone(votes: list[float], labels: list[int]) -> tuple[list[float], list[float]]:
    """Knots of a rising map from votes to the share of label 1: neighbours that would fall are pooled."""
    pools: list[list[float]] = []
    for v, y in sorted(zip(votes, labels, strict=True)):
        pools.append([v, y, 1])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            v, y, n = pools.pop()
            pools[-1] = [pools[-1][0] + v, pools[-1][1] + y, pools[-1][2] + n]
    return [v / n for v, _, n in pools], [(y + 0.5) / (n + 1) for _, y, n in pools]


def sample(labelled: DataFrame, teach: Column | None = None, limit: int = TRAIN) -> DataFrame:
    rows = labelled.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    rows = rows if teach is None else rows.where(teach)
    return rows.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def association(n: np.ndarray, ones: np.ndarray, rows: int, toxic: int) -> np.ndarray:
    """G-squared of terms in n rows, of which `ones` have label 1, over FULL: 1 at most, 0 if they go with label 0."""
    a, b = ones.astype(float), (n - ones).astype(float)
    c, d = toxic - a, rows - toxic - b

    def part(x: np.ndarray, row: np.ndarray, column: float) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(x > 0, x * np.log(x * rows / (row * column)), 0.0)

    g2 = 2 * (part(a, a + b, toxic) + part(b, a + b, rows - toxic) + part(c, c + d, toxic) + part(d, c + d, rows - toxic))
    return np.where(ones * rows > toxic * n, np.clip(g2 / FULL, 0, 1), 0.0)


def fit(docs: DataFrame, labelled: DataFrame, teach: Column | None = None, limit: int = TRAIN) -> Model:
    """docs: whose texts teach. At most `limit` labelled rows are broadcast; their terms and vectors reach the driver."""

    def split(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            found = [sorted(terms(t.as_py())) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.list_(pa.string()))], ["toxic", "features"])

    chosen = F.broadcast(sample(labelled, teach, limit))
    # The one scan of the corpus for these texts; what follows reads a table of `limit` documents or, with repeats, a few more.
    rows = materialize(docs.select("doc_id", whole_text().alias("text")).join(chosen, "doc_id").select("doc_id", "toxic", "text").distinct(), "examples")
    totals = rows.agg(F.count("*"), F.sum("toxic")).first()
    n, ones = totals[0], totals[1] or 0
    found = rows.mapInArrow(split, "toxic int, features array<string>").select("toxic", F.explode("features").alias("feature")).groupBy("feature").agg(F.count("*").alias("n"), F.sum("toxic").alias("ones")).orderBy("feature").toArrow() if n else None
    counts, toxic = (found[c].to_numpy() if n else np.zeros(0, np.int64) for c in ("n", "ones"))
    weights = (np.log((1 + n) / (1 + counts)) + 1) * (FLOOR + association(counts, toxic, n, ones))
    vectors = Vectors(found["feature"].to_pylist() if n else [], weights)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def vectorize(rows_: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_:
            made = shared.value(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([f.astype(np.int32).tobytes() for f, _ in made], pa.binary()), pa.array([x.astype(np.float32).tobytes() for _, x in made], pa.binary())], ["doc_id", "toxic", "f", "x"])

    examples = rows.mapInArrow(vectorize, "doc_id bigint, toxic int, f binary, x binary").collect() if n else []
    index = BlockMaxIndex([(r["doc_id"], r["toxic"], np.frombuffer(r["f"], np.int32), np.frombuffer(r["x"], np.float32)) for r in examples if r["f"]])
    shared.unpersist()
    discard(rows)
    model = Model(vectors, index, ones / n if n else 0.0, ([0.0, 1.0], [0.0, 1.0]))
    own = [(index.ids[a:b].astype(np.int64), index.weights[a:b].astype(float)) for a, b in zip(index.starts[:-1], index.starts[1:], strict=True)]
    if index.n and ones:
        model.knots = monotone([model.vote(near) for near in index.nearest(own, NEIGHBOURS, list(range(index.n)))], index.labels)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, predicted and evidence of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        index = model.index
        kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64()), ("toxic", pa.int32())]))
        for batch in rows:
            made = model.scores(batch.column(1).to_pylist())
            evidence = [[{"doc_id": index.docs[i], "similarity": s, "toxic": index.labels[i]} for s, i in near] for _, near in made]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s for s, _ in made], pa.float64()), pa.array([int(s >= 0.5) for s, _ in made], pa.int32()), pa.array(evidence, kind)], ["doc_id", "score", "predicted", "evidence"])

    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(run, SCHEMA)


def held_out() -> Column:
    """Whether crc32(doc_id as text) mod 5 is 0."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def score_toxicity(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted and evidence; rows that are held out don't teach."""
    return score(docs, fit(docs, labelled, ~held_out())).select("doc_id", held_out().alias("held_out"), "score", "predicted", "evidence")


def reject(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """docs without the rows that are predicted toxic; the columns stay as they are. Every label teaches."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labelled))

    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            texts = batch.column(batch.schema.names.index("text")).cast(pa.string()).to_pylist()
            yield batch.filter(pa.array([s < 0.5 for s, _ in shared.value.scores(texts)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
