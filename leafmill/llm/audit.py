"""Filter interaction audit: what each filter of a cascade removes, in every order, from a packed bitmap index.

flags     Every text fails a filter or not (conditions are Column expressions over `text`); labels and copies of a text
          join by doc_id, so a text with many copies spreads over the tasks like any other.
index     Rows of a task come in blocks of BLOCK: a block has a bitset for each filter (the rows that fail it), for each
          label and for each part. The index may be written and audited again.
audit     For each set of filters that may come first, AND-NOT over its bitsets and a popcount for each part and
          each label of it. Counts of blocks are added by part and set: 2 ** filters rows a part, whatever the input.
report    Any step of any order is a difference of two such counts, so all orders are read off at once.

A null text is empty. `copy` fails a text that is identical to one with a smaller doc_id, removed or not; a row without
doc_id has no such text, is no such text and has no labels, and rows of one doc_id don't fail one another. A label holds if any
of the document's label rows says 1. A null part is the empty string. Repeated rows count as often as they come. A table
without rows has no parts and so no report. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.llm.shared import materialize, whole_text

#: Rows of a block, and part values of one: a block with more is cut by part, so that bitsets stay as small as the block.
BLOCK, MOST_PARTS = 1 << 16, 64
#: White space between words.
SPACE = r"[\x20\x09-\x0D]+"
#: More filters than this have too many orders for a report.
MOST_FILTERS = 7


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def standard_filters() -> dict[str, Column | None]:
    """The filters of the registered query by letter: conditions over `text` and its `words` of failing; None: `copy`."""
    text, n = F.col("text"), F.size("words")
    without = lambda characters: F.length(F.translate(text, characters, ""))
    return {
        "A": n < 200,
        "B": 100 * F.size(F.array_distinct("words")) < 50 * n,
        "C": 100 * (F.length(text) - without("ABCDEFGHIJKLMNOPQRSTUVWXYZ")) > 3 * F.length(text),
        "D": without("#$%&*|") < F.length(text),
        "E": None,
    }


def flagged(docs: DataFrame, labelled: DataFrame, filters: dict[str, Column | None], labels: tuple[str, ...], part: str) -> DataFrame:
    """part, fails (bit k: filter k) and marks (bit k: label k) of every row of docs."""
    texts = docs.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), whole_text().alias("text")).withColumn("words", words(F.col("text")))
    bit = lambda k, c: F.when(c, F.lit(1 << k)).otherwise(F.lit(0))
    own = sum((bit(k, c) for k, c in enumerate(filters.values()) if c is not None), F.lit(0))
    # One pass over the texts; from here on a text is its 256-bit hash.
    rows = materialize(texts.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("key"), own.alias("own")), "flags")
    copy = [k for k, c in enumerate(filters.values()) if c is None]
    if copy:
        firsts = rows.where("doc_id is not null").groupBy("key").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
        # By doc_id and text: the rows of a text with many copies don't meet.
        rows = rows.join(firsts.hint("merge"), ["doc_id", "key"], "left")
        later = F.col("first").isNull() & F.col("doc_id").isNotNull()
        rows = rows.withColumn("own", F.col("own") + sum((bit(k, later) for k in copy), F.lit(0)))
    says = labelled.where("doc_id is not null").groupBy("doc_id").agg(sum((bit(k, F.max(F.coalesce(F.col(c) == 1, F.lit(False)))) for k, c in enumerate(labels)), F.lit(0)).alias("marks"))
    return rows.join(says.hint("merge"), "doc_id", "left").select("part", F.col("own").alias("fails"), F.coalesce("marks", F.lit(0)).alias("marks"))


def build_index(rows: DataFrame, n_filters: int, n_labels: int, block: int = BLOCK) -> DataFrame:
    """(parts, rows, filters, labels) of each block of a task's rows: its part values and the bitset of each, of each filter and of each label."""
    kinds = (pa.list_(pa.string()), *[pa.list_(pa.binary())] * 3)
    names = ["parts", "rows", "filters", "labels"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            codes = table["part"].combine_chunks().dictionary_encode()
            values, at = codes.dictionary.to_pylist(), codes.indices.to_numpy()
            fails, marks = (table[c].to_numpy() for c in ("fails", "marks"))
            packed = lambda x: np.packbits(x).tobytes()
            out = []
            for a in range(0, len(values), MOST_PARTS):
                own = np.flatnonzero((at >= a) & (at < a + MOST_PARTS)) if len(values) > MOST_PARTS else slice(None)
                some = values[a : a + MOST_PARTS]
                out.append((some, [packed(at[own] == a + k) for k in range(len(some))], [packed(fails[own] >> k & 1) for k in range(n_filters)], [packed(marks[own] >> k & 1) for k in range(n_labels)]))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

        for batch in batches:
            for a in range(0, len(batch), block):
                held.append(batch.slice(a, block))
                if sum(map(len, held)) >= block:
                    yield flush()
                    held = []
        if held and sum(map(len, held)):
            yield flush()

    return rows.select("part", "fails", "marks").mapInArrow(run, "parts array<string>, rows array<binary>, filters array<binary>, labels array<binary>")


def audit(index: DataFrame, n_filters: int, n_labels: int) -> DataFrame:
    """(part, passed, kept, marked): for each part and each set of filters (bit k of `passed`: filter k) the rows that fail none
    of them, and of these those with each label. All 2 ** n_filters sets are there, zeros included."""
    sets = 2**n_filters
    columns = ["kept", *[f"m{k}" for k in range(n_labels)]]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = lambda xs: [np.frombuffer(x, np.uint8) for x in xs.as_py()]
        for batch in batches:
            sums: dict[str, np.ndarray] = {}
            for parts, rows, filters, labels in zip(*(batch[c] for c in ("parts", "rows", "filters", "labels")), strict=True):
                fails, marks = bits(filters), bits(labels)
                passing = [np.full(len(fails[0]), 255, np.uint8)] * sets
                for s in range(1, sets):
                    top = s.bit_length() - 1
                    passing[s] = passing[s ^ 1 << top] & ~fails[top]
                for part, own in zip(parts.as_py(), bits(rows), strict=True):
                    table = sums.setdefault(part, np.zeros((sets, 1 + n_labels), np.int64))
                    for s in range(sets):
                        left = passing[s] & own
                        table[s] += [np.bitwise_count(x).sum(dtype=np.int64) for x in (left, *[left & m for m in marks])]
            if sums:
                table = np.concatenate(list(sums.values()))
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array(list(sums), object), sets), pa.string()), pa.array(np.tile(np.arange(sets, dtype=np.int32), len(sums))), *[pa.array(table[:, k]) for k in range(1 + n_labels)]], ["part", "passed", *columns])

    counted = index.mapInArrow(run, ", ".join(["part string", "passed int", *[f"{c} bigint" for c in columns]]))
    summed = counted.groupBy("part", "passed").agg(*[F.sum(c).alias(c) for c in columns])
    return summed.select("part", "passed", "kept", F.array(*columns[1:]).cast("array<bigint>").alias("marked"))


def report(counts: DataFrame, names: str, lost: tuple[str, ...]) -> DataFrame:
    """Every step of every order of the filters `names` (a letter each), for each part; `lost` names the counts of labels."""
    n = len(names)
    if not 1 <= n <= MOST_FILTERS:
        raise ValueError(f"a report takes 1 to {MOST_FILTERS} filters")
    every = (1 << n) - 1
    # 2 ** n entries a part.
    by_set = F.map_from_entries(F.collect_list(F.struct("passed", F.struct("kept", "marked"))))
    parts = counts.groupBy("part").agg(by_set.alias("c"))
    orders = F.array(F.lit(""))
    for _ in range(n):
        orders = F.flatten(F.transform(orders, lambda o: F.transform(F.filter(F.split(F.lit(names), ""), lambda x: (x != "") & ~F.contains(o, x)), lambda x: F.concat(o, x))))
    steps = parts.select("part", "c", F.explode(orders).alias("filter_order")).select("part", "c", "filter_order", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step"))
    steps = steps.withColumn("own", F.expr(f"shiftleft(1, instr('{names}', substring(filter_order, step, 1)) - 1)"))
    before = F.expr(f"aggregate(filter(split(substring(filter_order, 1, step - 1), ''), x -> x <> ''), 0, (a, x) -> a | shiftleft(1, instr('{names}', x) - 1))")
    steps = steps.withColumn("before", before)
    kept = lambda s: F.col("c")[s]["kept"]
    after = F.col("before").bitwiseOR(F.col("own"))
    removed = kept(F.col("before")) - kept(after)
    marked = [F.col("c")[F.col("before")]["marked"][k] - F.col("c")[after]["marked"][k] for k in range(len(lost))]
    made = steps.select(
        "part", "filter_order", F.col("step"), "own", kept(after).alias("kept"), removed.alias("removed"), (kept(F.lit(0)) - kept(F.col("own")) - removed).alias("redundant"),
        (kept(F.lit(every) - F.col("own")) - kept(F.lit(every))).alias("unique_fails"), *[m.alias(x) for m, x in zip(marked, lost, strict=True)],
    )
    return made.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "own"))).drop("own")


def audit_filters(docs: DataFrame, labelled: DataFrame, filters: dict[str, Column | None] | None = None, labels: dict[str, str] | None = None, part: str = "lang", block: int = BLOCK) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, a count lost for each label, and shapley.

    labels: the column of `labelled` by the name of its count.
    """
    filters = standard_filters() if filters is None else filters
    labels = {"good_lost": "quality", "toxic_lost": "toxic"} if labels is None else labels
    rows = flagged(docs, labelled, filters, tuple(labels.values()), part)
    index = build_index(rows, len(filters), len(labels), block)
    return report(audit(index, len(filters), len(labels)), "".join(filters), tuple(labels))
