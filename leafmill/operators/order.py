"""Reading order of the lines of a page.

A line sees another below it if they share some width, the other begins where it ends or further down, and no third line
that shares width with either lies between. A page is read along these links: a line's followers, the upper and then the left
one first, each with all that it alone was waited for, come before what waits for other lines as well.

Links are found by a sweep from the top of the page down. It holds the lines that can still be seen, and for each stretch of
the page's width the lowest top of the lines that ended over it: a line that begins sees those that are open above it and
end below that top; a line that ends hides what it covers. A page is one group; it is swept in O(n log n) steps, each over the lines
that are open at that height.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.schemas import FLOW

#: Rows of the matrix that is held at once for pages with lines that have no width or height.
ROWS = 256
#: Pages of so few lines are compared whole, which takes fewer steps than a sweep.
FEW = 48


def _sides(lines: pa.Table) -> np.ndarray:
    """x0, y0, x1 and y1 as four arrays."""
    return np.array([pc.struct_field(lines["bbox"], k).to_numpy() for k in ("x0", "y0", "x1", "y1")], float)


def swept(x0: np.ndarray, y0: np.ndarray, x1: np.ndarray, y1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(above, below): the links of lines that all have a width and a height."""
    n = len(x0)
    stretches = np.unique(np.concatenate([x0, x1]))
    first, last = np.searchsorted(stretches, x0), np.searchsorted(stretches, x1)
    lowest_top = np.full(len(stretches), -np.inf)
    open_ = np.zeros(0, np.int64)
    above, below = [open_], [open_]
    # Ends come before beginnings at the same height.
    for event in np.lexsort((np.repeat([0, 1], n), np.concatenate([y1, y0]))).tolist():
        k = event % n
        meets = (x0[open_] < x1[k]) & (x0[k] < x1[open_])
        stretch = slice(first[k], last[k])
        if event < n:
            open_ = np.append(open_[~(meets & (y1[open_] <= y0[k]))], k)
            np.maximum(lowest_top[stretch], y0[k], out=lowest_top[stretch])
        else:
            seen = open_[meets]
            seen = seen[y1[seen] > lowest_top[stretch].max()]
            above.append(seen)
            below.append(np.full(len(seen), k))
    return np.concatenate(above), np.concatenate(below)


def compared(x0: np.ndarray, y0: np.ndarray, x1: np.ndarray, y1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same links for any boxes, by comparing all: the two first ends under each line and the two last tops over each one
    say whether a third line is between."""
    n = len(x0)
    ends, tops = np.full((n, 2), np.inf), np.full((n, 2), -np.inf)
    pairs = []
    for a in range(0, n, ROWS):
        i = np.arange(a, min(a + ROWS, n))[:, None]
        meets = (x0[i] < x1) & (x0 < x1[i]) & (i != np.arange(n))
        under, over = meets & (y1[i] <= y0), meets & (y1 <= y0[i])
        two = lambda values, k: np.partition(np.concatenate([values, np.full((len(values), 2), k)], axis=1), 1, axis=1)[:, :2]
        ends[a : a + ROWS] = two(np.where(under, y1, np.inf), np.inf)
        tops[a : a + ROWS] = -two(np.where(over, -y0, np.inf), np.inf)
        pairs.append(np.stack(np.nonzero(under)) + [[a], [0]])
    above, below = np.concatenate(pairs, axis=1) if pairs else np.zeros((2, 0), np.int64)
    # The line itself doesn't lie between, though one without height ends where it begins.
    end = np.where((y1[below] == ends[above, 0]), ends[above, 1], ends[above, 0])
    top = np.where((y0[above] == tops[below, 0]), tops[below, 1], tops[below, 0])
    free = (end > y0[below]) & (top < y1[above])
    return above[free], below[free]


def links(sides: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x0, y0, x1, y1 = sides
    return (swept if len(x0) > FEW and ((x0 < x1) & (y0 < y1)).all() else compared)(x0, y0, x1, y1)


def read_along(sides: np.ndarray) -> Iterator[int]:
    """The lines in the order in which they are read."""
    x0, y0, _, _ = sides
    n = len(x0)
    above, below = links(sides)
    rank = np.empty(n, np.int64)
    rank[np.lexsort((np.arange(n), x0, y0))] = np.arange(n)
    by = np.lexsort((rank[below], above))
    followers = np.split(below[by], np.searchsorted(above[by], np.arange(1, n)))
    waits = np.bincount(below, minlength=n)
    ways = [iter(sorted(np.flatnonzero(waits == 0).tolist(), key=rank.__getitem__))]
    while ways:
        line = next(ways[-1], None)
        if line is None:
            ways.pop()
            continue
        yield line
        waits[followers[line]] -= 1
        ways.append(iter(followers[line][waits[followers[line]] == 0].tolist()))


def positions(flow: np.ndarray, sides: np.ndarray) -> np.ndarray:
    """Place of each line of a page: those of the flow as they are read, each other one behind the flow line before it; what comes before all flow stays in front."""
    of_flow = np.cumsum(flow) - 1
    read = np.empty(int(flow.sum()), np.int64)
    read[list(read_along(sides[:, flow]))] = np.arange(len(read))
    leader = np.where(of_flow < 0, -1, read[np.maximum(of_flow, 0)] if len(read) else -1)
    place = np.empty(len(flow), np.int64)
    place[np.argsort(leader, kind="stable")] = np.arange(len(flow))
    return place


def edges(lines: DataFrame) -> DataFrame:
    """(doc_id, page, above, below): numbers of the lines that see one another.

    Lines with one and the same place see the same and hide nothing from one another, so a page's different boxes are swept and
    their lines join the links. A line without width or height stands for itself.
    """
    kind = lines.schema["seq"].dataType.simpleString()

    def of_page(rows: pa.Table) -> pa.Table:
        above, below = links(_sides(rows))
        return pa.table({"doc_id": rows["doc_id"].take(above), "page": rows["page"].take(above), "first_above": rows["seq"].take(above), "first_below": rows["seq"].take(below)})

    solid = F.col("bbox.x0") < F.col("bbox.x1"), F.col("bbox.y0") < F.col("bbox.y1")
    place = ["doc_id", "page", "bbox", "alone"]
    rows = lines.select("doc_id", "page", "seq", "bbox", F.when(~F.coalesce(solid[0] & solid[1], F.lit(False)), F.col("seq")).alias("alone"))
    first = rows.groupBy(*place).agg(F.min("seq").alias("first"))
    found = first.select("doc_id", "page", F.col("first").alias("seq"), "bbox").groupBy("doc_id", "page").applyInArrow(of_page, f"doc_id bigint, page int, first_above {kind}, first_below {kind}")
    same = F.col("r.alone").eqNullSafe(F.col("f.alone"))
    for c in place[:3]:
        same = same & F.col(f"r.{c}").eqNullSafe(F.col(f"f.{c}"))
    own = rows.alias("r").join(first.alias("f"), same).select("r.doc_id", "r.page", "r.seq", "f.first")
    side = lambda c: own.withColumnsRenamed({"seq": c, "first": f"first_{c}"})
    return found.join(side("above"), ["doc_id", "page", "first_above"]).join(side("below"), ["doc_id", "page", "first_below"]).select("doc_id", "page", "above", "below")


def _same_page(rows: pa.Table) -> np.ndarray:
    """Whether each row but the first is on the page of the row before it."""
    codes = [pc.dictionary_encode(rows[c].combine_chunks(), null_encoding="encode").indices.to_numpy() for c in ("doc_id", "page")]
    return (codes[0][1:] == codes[0][:-1]) & (codes[1][1:] == codes[1][:-1])


def reading_order(lines: DataFrame) -> DataFrame:
    """lines with `position`: flow categories move, the others follow the flow line before them. A task gets its pages sorted and places all pages of a batch at once; the last one waits for its end."""

    def placed(rows: pa.Table, same: np.ndarray) -> pa.Table:
        flow, sides = pc.is_in(rows["category"], value_set=pa.array(FLOW)).to_numpy(), _sides(rows)
        edges = [0, *(np.flatnonzero(~same) + 1).tolist(), len(rows)]
        return rows.append_column("position", pa.array(np.concatenate([positions(flow[a:b], sides[:, a:b]) for a, b in zip(edges, edges[1:], strict=False)]), pa.int32()))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            ends = pa.Table.from_batches([held[0].slice(0, 1), batch.slice(len(batch) - 1)]) if held else None
            held.append(batch)
            if ends is not None and _same_page(ends).all():
                continue
            rows = pa.Table.from_batches(held).combine_chunks()
            same = _same_page(rows)
            new = np.flatnonzero(~same)
            end = int(new[-1]) + 1 if len(new) else 0
            if end:
                yield from placed(rows.slice(0, end), same[: end - 1]).to_batches()
            held = rows.slice(end).to_batches()
        if held:
            rows = pa.Table.from_batches(held).combine_chunks()
            yield from placed(rows, _same_page(rows)).to_batches()

    page = ["doc_id", "page"]
    return lines.repartition(*page).sortWithinPartitions(*page, "seq").mapInArrow(run, f"{lines._jdf.schema().toDDL()}, position int")
