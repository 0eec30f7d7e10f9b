"""Expiring click deduplication: a stateful stream that folds the arrivals of each click_id into windows.

copies    Every row of clicks arrives pmod(click_id, 3) + 1 times, each copy in its own hour and batch. Copies are written
          by batch into the shared folder and moved one batch at a time to where the stream looks.
stream    transformWithStateInPandas on RocksDB, started anew for each batch on one checkpoint. A state key is a run of IDS
          neighbouring click_ids (one click_id with ids=1): its ValueState keeps for each of them that has an open window
          the opener (hour and hash), the counters and the sum of checksums, one fixed-size record each. Copies of a run
          that meet in a task come as one packed row, equal copies counted; all click_ids of a run fold together.
order     Rows of a click_id go by hour, then hash. The watermark is LATE hours and one behind the latest hour, so copies
          before that are dropped, and a timer one millisecond short of the end of a run's first window closes what ended.
flush     After the last batch a row from beyond all windows is fed: the watermark passes every timer.

A row without click_id or arrived_at has no copies. A null ts, client_id, kind, value or props is an empty field of the hash;
a value that isn't a number counts as 0, an infinite one as the largest or least long. Repeated rows are further copies.
Other columns of the input are ignored. An empty table has no windows. Of a click_id, the different (hour, hash) of
one batch are folded in one task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from leafmill.llm.shared import delete, new_path, path_exists, rename

#: Batches, hours after a window's start that still repeat it, hours that a copy may be late.
BATCHES, REPEAT, LATE = 8, 24, 96
#: click_ids of a state key; a power of two. It bounds what a key holds and grows with nothing.
IDS = 1024

HOUR_MS = 3_600_000
RESULT = "click_id bigint, start_hour bigint, closed_batch bigint, n_repeats bigint, n_conflicts bigint, conflict_crc bigint, hash string"
_NAMES = [x.split()[0] for x in RESULT.split(", ")]
#: A copy (n equal ones) and an open window. A hash is four numbers that sort as its digits do.
ROW = np.dtype([("id", "<i8"), ("hour", "<i8"), ("n", "<i8"), ("crc", "<i8"), ("hash", "<u8", (4,))])
WINDOW = np.dtype([("id", "<i8"), ("start", "<i8"), ("n", "<i8"), ("conflicts", "<i8"), ("crc", "<i8"), ("hash", "<u8", (4,))])
#: The key of the row that flushes; no run of click_ids has it but that of one id, and the row is empty.
_FLUSH = 1 << 62


def micros(rows: DataFrame, name: str) -> Column:
    """Microseconds since 1970 in UTC; a timestamp without zone is one in UTC, whatever the session's zone."""
    c = F.col(name)
    if not isinstance(rows.schema[name].dataType, T.TimestampNTZType):
        return F.unix_micros(c.cast("timestamp"))
    minutes = (F.unix_date(c.cast("date")).cast("bigint") * 24 + F.hour(c)) * 60 + F.minute(c)
    return minutes * 60_000_000 + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("bigint")


def copies(clicks: DataFrame) -> DataFrame:
    """click_id, hour, slot (what batches are cut by) and hash of every copy."""
    rows = clicks.select("click_id", F.floor(micros(clicks, "arrived_at") / (1000 * HOUR_MS)).alias("arrived"), "client_id", "kind", "value", micros(clicks, "ts").alias("ts"), "props")
    rows = rows.where("click_id is not null and arrived is not null").select("*", F.explode(F.sequence(F.lit(0), F.pmod("click_id", F.lit(3)).cast("int"))).alias("j"))
    rows = rows.withColumn("c", F.crc32(F.concat(F.col("click_id").cast("string"), F.lit(":"), F.col("j").cast("string"))))
    rows = rows.withColumn("hour", F.col("arrived") + 6 * F.col("j") * (F.col("c") % 10))
    fields = (F.col("client_id"), F.col("kind"), F.floor(100 * F.col("value") + 0.5), F.col("ts"), F.col("props"), F.col("c") % 3)
    text = F.concat(*[x for i, f in enumerate(fields) for x in ([F.lit("|")] if i else []) + [F.coalesce(f.cast("string"), F.lit(""))]])
    return rows.select("click_id", "hour", (F.col("hour") + F.floor(F.col("c") / 10) % 200).alias("slot"), F.sha2(text, 256).alias("hash"))


def by_order(rows: np.ndarray) -> np.ndarray:
    h = rows["hash"]
    return rows[np.lexsort((h[:, 3], h[:, 2], h[:, 1], h[:, 0], rows["hour"], rows["id"]))]


def packer(first: int, ids: int):
    """Arrow batches of copies as rows (block, event, data): the ROW records of a run of click_ids. Hours count from `first`."""
    shift = ids.bit_length() - 1

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(_FLUSH, h - first + 1, b"") for i, h in zip(batch["click_id"].to_pylist(), batch["hour"].to_pylist(), strict=True) if i is None] if batch["click_id"].null_count else []
            batch = batch.filter(batch["click_id"].is_valid())
            rows = np.zeros(len(batch), ROW)
            if len(rows):
                rows["id"], rows["hour"], rows["crc"] = batch["click_id"].to_numpy(), batch["hour"].to_numpy() - first + 1, batch["crc"].to_numpy()
                rows["hash"] = np.frombuffer(b"".join(batch["hash"].to_pylist()), ">u8").reshape(-1, 4)
                rows = by_order(rows)
                new = np.flatnonzero(np.append(True, (rows["id"][1:] != rows["id"][:-1]) | (rows["hour"][1:] != rows["hour"][:-1]) | (rows["hash"][1:] != rows["hash"][:-1]).any(axis=1)))
                times = np.diff(np.append(new, len(rows)))
                rows = rows[new]
                rows["n"] = times
                block = rows["id"] >> shift
                edges = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(rows)]
                out += [(int(block[a]), int(rows["hour"][a:b].max()), rows[a:b].tobytes()) for a, b in zip(edges[:-1], edges[1:], strict=True)]
            if out:
                blocks, hours, data = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array([h * HOUR_MS * 1000 for h in hours], pa.timestamp("us", "UTC")), pa.array(data, pa.binary())], ["block", "event", "data"])

    return pack


def fold(open_: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The windows that are open after these copies, by id, and those that others have closed.

    Each round takes, for all ids at once, the copies up to the end of the id's window; an id with copies left then closes it.
    """
    if not len(rows):
        return open_, open_[:0]
    rows = by_order(rows)
    ids, at = np.unique(rows["id"], return_index=True)
    end = np.append(at[1:], len(rows))
    window, is_open = np.zeros(len(ids), WINDOW), np.zeros(len(ids), bool)
    window["id"] = ids
    mine = np.searchsorted(ids, open_["id"])
    held = ids[np.minimum(mine, len(ids) - 1)] == open_["id"]
    window[mine[held]], is_open[mine[held]] = open_[held], True
    base = rows["hour"].min()
    wide = int(rows["hour"].max() - base) + REPEAT + 2
    rank = np.repeat(np.arange(len(ids)), end - at)
    place = rank * wide + (rows["hour"] - base)
    closed, live = [], np.arange(len(ids))
    while len(live):
        fresh = live[~is_open[live]]
        opener = rows[at[fresh]]
        window["start"][fresh], window["hash"][fresh], window["n"][fresh] = opener["hour"], opener["hash"], opener["n"] - 1
        window["conflicts"][fresh] = window["crc"][fresh] = 0
        at[fresh] += 1
        is_open[fresh] = True
        reach = np.searchsorted(place, live * wide + np.clip(window["start"][live] + REPEAT - base, -1, wide - 1), side="right")
        reach = np.clip(reach, at[live], end[live])
        length = reach - at[live]
        owner = np.repeat(live, length)
        took = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length) + np.repeat(at[live], length)
        n, unlike = rows["n"][took], (rows["hash"][took] != window["hash"][owner]).any(axis=1)
        for name, values in (("n", n), ("conflicts", n * unlike), ("crc", n * unlike * rows["crc"][took])):
            np.add.at(window[name], owner, values)
        at[live] = reach
        live = live[at[live] < end[live]]
        closed.append(window[live])
        is_open[live] = False
    left = np.concatenate([open_[~held], window])
    return left[np.argsort(left["id"], kind="stable")], np.concatenate(closed)


class Windows(StatefulProcessor):
    """Folds the copies of a batch. `batch` is its number, `before` that of the batch fed before it; a window that ended by the
    watermark has closed after that one. Where `mark` is given (the flush), what ends after it closes after `batch`."""

    def __init__(self, batch: int, before: int, first: int, mark: int | None = None):
        self.batch, self.before, self.first, self.mark = batch, before, first, mark

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("windows", "windows binary, timer bigint")

    def _frame(self, windows: np.ndarray, batch) -> pd.DataFrame:
        digits = windows["hash"].astype(">u8").tobytes().hex()
        columns = (windows["id"], windows["start"] + self.first - 1, np.broadcast_to(np.asarray(batch, np.int64), len(windows)), windows["n"], windows["conflicts"], windows["crc"], [digits[i : i + 64] for i in range(0, len(digits), 64)])
        return pd.DataFrame(dict(zip(_NAMES, columns, strict=True)))

    def _ended(self, open_: np.ndarray, hour: int) -> tuple[np.ndarray, pd.DataFrame]:
        """The windows that go on, and those that the watermark (in hours) has passed."""
        over = open_["start"] + REPEAT <= hour
        late = over & (open_["start"] + REPEAT > self.mark) if self.mark is not None else np.zeros(len(open_), bool)
        return open_[~over], self._frame(open_[over], np.where(late[over], self.batch, self.before))

    def _keep(self, open_: np.ndarray, timer: int | None, fired: int | None = None) -> None:
        """Keep the open windows; one timer for the first that ends."""
        wanted = (int(open_["start"].min()) + REPEAT) * HOUR_MS - 1 if len(open_) else None
        if timer is not None and timer not in (wanted, fired):  # the one that fired is deleted after its call
            self.handle.deleteTimer(timer)
        if wanted is not None and wanted != timer:
            self.handle.registerTimer(wanted)
        if len(open_):
            self.state.update((open_.tobytes(), wanted))
        else:
            self.state.clear()

    def _held(self) -> tuple[np.ndarray, int | None]:
        held = self.state.get()
        return (np.zeros(0, WINDOW), None) if held is None else (np.frombuffer(bytes(held[0]), WINDOW), held[1])

    def handleInputRows(self, key, rows, timerValues):
        hour = timerValues.getCurrentWatermarkInMs() // HOUR_MS
        copies_ = np.frombuffer(b"".join(bytes(x) for frame in rows for x in frame["data"]), ROW)
        open_, timer = self._held()
        going, ended = self._ended(open_, hour)
        left, closed = fold(going, copies_[copies_["hour"] > hour])
        if len(left) or timer is not None:
            self._keep(left, timer)
        for frame in (ended, self._frame(closed, self.batch)):
            if len(frame):
                yield frame

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        open_, timer = self._held()
        going, ended = self._ended(open_, timerValues.getCurrentWatermarkInMs() // HOUR_MS)
        self._keep(going, timer, expiredTimerInfo.getExpiryTimeInMs())
        if len(ended):
            yield ended

    def close(self) -> None:
        pass


def _session(spark: SparkSession) -> SparkSession:
    """A session of its own for the stream's settings. Batches without rows are run only by the flush."""
    stream = spark.newSession()
    for k, v in {
        "stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "stateStore.unloadOnCommit": "true",  # a start runs one batch: its stores and their files aren't needed any more
        "stateStore.rocksdb.boundedMemoryUsage": "true",
        "stateStore.rocksdb.maxMemoryUsageMB": "256",
        "noDataMicroBatches.enabled": "false",
    }.items():
        stream.conf.set(f"spark.sql.streaming.{k}", v)
    stream.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    stream.conf.set("spark.sql.session.timeZone", "UTC")
    stream.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return stream


def deduplicate(clicks: DataFrame, batches: int = BATCHES, ids: int = IDS) -> DataFrame:
    """One row for each window: click_id, start_hour, closed_batch, n_repeats, n_conflicts, conflict_crc and the opener's hash."""
    if ids < 1 or ids & (ids - 1):
        raise ValueError("ids has to be a power of two")
    spark = clicks.sparkSession
    rows = copies(clicks)
    low, high, first, last = rows.agg(F.min("slot"), F.max("slot"), F.min("hour"), F.max("hour")).first()
    if low is None:
        return spark.createDataFrame([], RESULT)
    folder = new_path(spark, "clicks")
    batch = F.floor((F.col("slot") - low) * batches / (high - low + 1)).cast("int")
    staged = rows.select(batch.alias("batch"), "click_id", "hour", F.unhex("hash").alias("hash"), F.crc32("hash").alias("crc"))
    staged = staged.repartition(F.expr(f"shiftright(click_id, {ids.bit_length() - 1})")).sortWithinPartitions("batch", "click_id")
    staged.write.partitionBy("batch").parquet(f"{folder}/staged")
    # Beyond every window's end, and as far again as the watermark stays behind.
    beyond = spark.range(1).select(F.lit(None).cast("bigint").alias("click_id"), F.lit(last + REPEAT + LATE + 3).cast("bigint").alias("hour"), F.lit(None).cast("binary").alias("hash"), F.lit(None).cast("bigint").alias("crc"))
    beyond.write.parquet(f"{folder}/staged/batch={batches}")

    stream = _session(spark)
    pack, before = packer(first, ids), 0
    for k in range(batches + 1):
        if not path_exists(spark, f"{folder}/staged/batch={k}"):
            continue
        rename(spark, f"{folder}/staged/batch={k}", f"{folder}/in/batch={k}")
        flush = k == batches
        processor = Windows(k, before, first) if not flush else Windows(batches - 1, before, first, last - first + 1 - LATE - 1)
        if flush:
            stream.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "true")
        fed = stream.readStream.schema("click_id bigint, hour bigint, hash binary, crc bigint, batch int").parquet(f"{folder}/in")
        packed = fed.mapInArrow(pack, "block bigint, event timestamp, data binary").withWatermark("event", f"{LATE + 1} hours")
        out = packed.groupBy("block").transformWithStateInPandas(processor, RESULT, "append", "eventTime")
        out.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
        before = k
    for name in ("in", "staged", "checkpoint"):
        delete(spark, f"{folder}/{name}")
    return spark.read.schema(RESULT).parquet(f"{folder}/out")
