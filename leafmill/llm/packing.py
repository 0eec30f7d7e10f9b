"""Packing of token sequences by cutting-stock column generation.

cut       Every document's ids (each with the end id) are cut into pieces of `width` ids, then one of half
          the width if the rest is as long, and a tail. Whole pieces are sequences by themselves. With
          no piece between half and whole, plans lose almost nothing; one pass over the texts cuts.
plan      The histogram of lengths (width / 2 classes at most) is the demand of a cutting-stock
          problem. A pattern is a multiset of lengths; its cost is the padded size of its sum: `width`,
          or the sum itself where that is a power of two. The linear program over patterns is solved by
          column generation: revised simplex, and a knapsack dynamic program over sums prices columns.
          It stops within GAP of the tokens themselves, a lower bound of any plan, or after ROUNDS.
          The first columns are those of a greedy plan.
round     Patterns are used floor(x) times; what is left (fewer sequences than classes) is filled
          greedily by exact fits of one or two lengths.
assign    Tails are ranked inside their length by a range shuffle, so no task gets a whole length; a rank
          falls into an interval of a pattern, which gives the sequence and the place in it.

Null texts are empty: their only id is the end id. Repeated rows are packed one by one. An empty table
has no pieces. Ties of a rank (repeated doc_ids) go by the tail's checksum. Other columns are ignored.
"""

from __future__ import annotations

import itertools
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.shared import give_back, materialize, whole_text
from leafmill.llm.tokenizing import END_ID, Encoder, batches, vocabulary

WIDTH = 1024
#: Relative excess over the lower bound at which column generation stops, and pricing rounds at most.
GAP, ROUNDS = 0.0005, 300
#: Columns that one pricing round may bring in.
COLUMNS = 12

Pattern = tuple[tuple[int, int], ...]  # (length, times), longest first


def padded(total: int, width: int) -> int:
    """Size of a sequence with so many ids: a power of two is left as it is."""
    return total if total & (total - 1) == 0 else width


def solve(demand: dict[int, int], width: int = WIDTH, gap: float = GAP, rounds: int = ROUNDS) -> list[tuple[Pattern, float]]:
    """Patterns and how often the linear program uses them."""
    sizes = np.array(sorted(demand, reverse=True))
    need = np.array([demand[s] for s in sizes], float)
    m = len(sizes)
    if not m:
        return []
    cost_of = np.array([0, *[padded(t, width) for t in range(1, width + 1)]], float)
    columns: list[Pattern] = [((int(s), int(width // s)),) for s in sizes]
    times = np.array([width // s for s in sizes], float)
    inverse, x = np.diag(1 / times), need / times
    cost = np.array([cost_of[int(s) * int(t)] for s, t in zip(sizes, times, strict=True)])
    bound = float(sizes @ need)
    place = {int(s): i for i, s in enumerate(sizes)}

    def enter(pattern: Pattern, duals: np.ndarray) -> bool:
        nonlocal inverse, x
        a = np.zeros(m)
        for s, t in pattern:
            a[place[s]] = t
        c = cost_of[sum(s * t for s, t in pattern)]
        if duals @ a - c <= 1e-7 * width:
            return False
        d = inverse @ a
        able = d > 1e-9
        if not able.any():
            return False
        ratio = np.where(able, x / np.where(able, d, 1), np.inf)
        out = int(np.argmin(ratio))
        step = ratio[out]
        x = np.maximum(x - step * d, 0)
        x[out] = step
        row = inverse[out] / d[out]
        inverse -= np.outer(d, row)
        inverse[out] = row
        cost[out], columns[out] = c, pattern
        return True

    # The columns of a greedy plan come first: each is offered while it pays.
    for pattern, _ in fill(demand, width):
        enter(pattern, cost @ inverse)
    for _ in range(rounds):
        if cost @ x <= bound * (1 + gap):
            break
        duals = cost @ inverse
        value, last = knapsack(sizes, duals, width)
        # The best pattern of each sum, and the best that fills the width with each length.
        gains = [(value[t] - cost_of[t], t, -1) for t in np.flatnonzero(value[1:] - cost_of[1:] > 1e-7 * width) + 1]
        with_first = duals + value[width - sizes] - cost_of[width]
        gains += [(with_first[i], width - int(sizes[i]), i) for i in np.argsort(-with_first)[: 4 * COLUMNS] if with_first[i] > 1e-7 * width]
        tried, entered = set(), 0
        for _, total, first in sorted(gains, reverse=True):
            items = Counter([int(sizes[first])] if first >= 0 else [])
            while total:
                items[int(sizes[last[total]])] += 1
                total -= int(sizes[last[total]])
            pattern = tuple(sorted(items.items(), reverse=True))
            if pattern not in tried:
                tried.add(pattern)
                entered += enter(pattern, cost @ inverse if entered else duals)
            if entered >= COLUMNS or len(tried) >= 3 * COLUMNS:
                break
        if not entered:
            break
    return [(p, float(t)) for p, t in zip(columns, x, strict=True) if t > 1e-9]


def knapsack(sizes: np.ndarray, worth: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For each sum up to width: the most worth of lengths with exactly that sum, and one of those lengths."""
    value, last = np.full(width + 1, -np.inf), np.zeros(width + 1, np.int64)
    value[0] = 0
    rising, gain = sizes[::-1], worth[::-1]
    first = np.searchsorted(rising, np.arange(width + 1), side="right")
    for total in range(int(rising[0]), width + 1):
        n = first[total]
        made = value[total - rising[:n]] + gain[:n]
        best = int(np.argmax(made))
        value[total], last[total] = made[best], len(sizes) - 1 - best
    return value, last


def fill(left: dict[int, int], width: int) -> list[tuple[Pattern, int]]:
    """Sequences for all of `left`: the longest first, then exact fits of one to three lengths, else the longest that fits; each pattern as often as it can be."""
    made = []
    left = {s: n for s, n in left.items() if n > 0}
    while left:
        order = sorted(left, reverse=True)
        items, gap = Counter([order[0]]), width - order[0]

        def free(s: int, more: int = 0, items: Counter[int] = items) -> bool:
            return left.get(s, 0) > items[s] + more

        while gap:
            pick = [gap] if free(gap) else None
            pick = pick or next(([a, gap - a] for a in order if a < gap and free(a) and free(gap - a, gap - a == a)), None)
            if not pick:
                a = next((a for a in order if a <= gap and free(a)), None)
                pick = [a] if a else None
            if not pick:
                break
            items.update(pick)
            gap -= sum(pick)
        n = min(left[s] // t for s, t in items.items())
        made.append((tuple(sorted(items.items(), reverse=True)), n))
        for s, t in items.items():
            left[s] -= n * t
            if not left[s]:
                del left[s]
    return made


def plan(demand: dict[int, int], width: int = WIDTH) -> list[tuple[Pattern, int]]:
    """Patterns and whole numbers of sequences that use each length exactly as often as demanded."""
    left = Counter(demand)
    uses: Counter[Pattern] = Counter()
    for pattern, times in solve(demand, width):
        n = min([int(times + 1e-6), *[left[s] // t for s, t in pattern]])
        if n > 0:
            uses[pattern] += n
            for s, t in pattern:
                left[s] -= n * t
    for pattern, n in fill(left, width):
        uses[pattern] += n
    return sorted(uses.items(), reverse=True)


def pieces(docs: DataFrame, tokenizer: str | None = None, width: int = WIDTH) -> DataFrame:
    """Every piece: doc_id, start, length, ids_crc32, doc_tokens, and for whole pieces the task and number there."""
    path = tokenizer or vocabulary("byte_bpe_50k.json")

    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, n = Encoder(path).encode_batch, TaskContext.get().partitionId(), 0
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "number"]
        for batch in rows:
            ids, texts = (c.to_pylist() for c in batch.columns)
            for a, b in batches(texts):
                out = []
                for doc_id, data in zip(ids[a:b], encode(texts[a:b]), strict=True):
                    tokens = np.append(np.frombuffer(data, "<u2"), END_ID).astype("<u4")
                    edges = [*range(0, len(tokens), width), len(tokens)]
                    if edges[-1] - edges[-2] > width // 2 and edges[-1] - edges[-2] < width:
                        edges.insert(-1, edges[-2] + width // 2)
                    for start, end in zip(edges, edges[1:]):  # noqa: B905
                        piece = tokens[start:end]
                        whole = len(piece) == width
                        out.append((doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(tokens), part, n if whole else None))
                        n += whole
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names)
        encode = batch = ids = texts = out = None
        give_back()

    schema = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, part bigint, number bigint"
    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(run, schema)


def intervals(made: list[tuple[Pattern, int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length, by rising first rank: first rank, times in the pattern, first sequence, offset of its first copy."""
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    reached: Counter[int] = Counter()
    sequence = 0
    for pattern, n in made:
        offset = 0
        for size, times in pattern:
            rows.setdefault(size, []).append((reached[size], times, sequence, offset))
            reached[size] += n * times
            offset += size * times
        sequence += n
    return {s: tuple(np.array(c) for c in zip(*r, strict=True)) for s, r in rows.items()}


def pack(docs: DataFrame, tokenizer: str | None = None, width: int = WIDTH) -> DataFrame:
    """Every piece with its sequence_id and offset."""
    cut = materialize(pieces(docs, tokenizer, width), "pieces")

    def number(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, length, n = TaskContext.get().partitionId(), None, 0
        for batch in rows:
            ranks = []
            for x in batch.column(2).to_pylist():
                n = n + 1 if x == length else 0
                length = x
                ranks.append(n)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * len(ranks), pa.int64()), pa.array(ranks, pa.int64())], [*batch.schema.names, "part", "number"])

    tails = cut.where(F.col("length") < width).drop("part", "number")
    ordered = tails.repartitionByRange("length", "doc_id", "ids_crc32").sortWithinPartitions("length", "doc_id", "ids_crc32")
    ranked = materialize(ordered.mapInArrow(number, cut.schema), "tails")
    # A row for each length and for each place where a task's run ends inside one.
    counts = ranked.groupBy("length", "part").count().orderBy("length", "part").collect()
    demand: Counter[int] = Counter()
    first: dict[tuple[int, int], int] = {}
    for r in counts:
        first[r["length"], r["part"]] = demand[r["length"]]
        demand[r["length"]] += r["count"]
    made = plan(dict(demand), width)
    table, sequences = intervals(made), sum(n for _, n in made)

    def assign(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            lengths, parts, numbers = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 5, 6))
            seq, offset = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for size in np.unique(lengths).tolist():
                own = np.flatnonzero(lengths == size)
                rank = numbers[own] + np.array([first[size, p] for p in parts[own].tolist()])
                ranks, times, sequence, start = table[size]
                k = np.searchsorted(ranks, rank, side="right") - 1
                copy, slot = np.divmod(rank - ranks[k], times[k])
                seq[own], offset[own] = sequence[k] + copy, start[k] + slot * size
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(seq), pa.array(offset)], [*batch.schema.names[:5], "sequence_id", "offset"])

    schema = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    placed = ranked.mapInArrow(assign, schema)
    whole = cut.where(F.col("length") == width)
    # One number for each task that cut whole pieces is added up on the driver.
    cuts = {r["part"]: r["count"] for r in whole.groupBy("part").count().collect()}
    before = dict(zip(sorted(cuts), itertools.accumulate([sequences, *[cuts[p] for p in sorted(cuts)]]), strict=False))
    bases = docs.sparkSession.createDataFrame(list(before.items()), "part bigint, base bigint")
    alone = whole.join(F.broadcast(bases), "part").select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("base") + F.col("number")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    return placed.unionByName(alone)
