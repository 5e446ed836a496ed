"""Streams with state of their own: batches that stay open, and log windows counted in steps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from pairloom.runtime import ship_by_value

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Closed windows that leave a task together.
OUT_WINDOWS = 1000


def stateful_session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose streams may keep state of any shape."""
    session = spark.newSession()
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    return session


class Batches(StatefulProcessor):
    """Per stream: the rows of the batch that is not full yet, and its number."""

    def __init__(self, b: int, stream: str, order: tuple[str, ...], key: str, key_type: str) -> None:
        self.b, self.stream, self.order, self.key, self.key_type = b, stream, order, key, key_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.number = handle.getValueState("number", "batch long")
        self.open = handle.getListState("open", f"key {self.key_type}")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows)).sort_values(list(self.order))[self.key].tolist()
        held = [r[0] for r in self.open.get()] + new
        first = self.number.get()[0] if self.number.exists() else 0
        full = len(held) // self.b * self.b
        self.number.update((first + full // self.b,))
        self.open.clear()
        if held[full:]:
            self.open.put([(x,) for x in held[full:]])
        if full:
            place = np.arange(full)
            yield pd.DataFrame({
                self.stream: [key[0]] * full, "batch_id": first + place // self.b,
                "pos": (place % self.b).astype(np.int32), self.key: held[:full],
            })

    def close(self) -> None:
        pass


def batch_stream(
    rows: DataFrame, b: int, *, stream: str = "worker", order: tuple[str, ...] = ("epoch", "idx"), key: str = "id"
) -> DataFrame:
    """(stream, batch_id, pos, key): full batches of each stream's rows as they arrive.

    Rows of one micro-batch count in ``order``, micro-batches as they come. A batch that is not full
    waits in the state, across micro-batches and restarts; the state of a stream is less than
    one batch of keys.
    """
    if b < 1:
        raise ValueError("b must be at least 1")
    kinds = {f.name: f.dataType for f in rows.schema}
    out = T.StructType([
        T.StructField(stream, kinds[stream]), T.StructField("batch_id", T.LongType()),
        T.StructField("pos", T.IntegerType()), T.StructField(key, kinds[key]),
    ])
    state = Batches(b, stream, order, key, kinds[key].simpleString())
    return rows.select(stream, *order, key).groupBy(stream).transformWithStateInPandas(
        statefulProcessor=state, outputStructType=out, outputMode="append", timeMode="none"
    )


class Windows(StatefulProcessor):
    """Per run: sums and counts per timestep bin of every log window that is not closed yet."""

    def __init__(self, every: int, bins: int, idle_ms: int, run: str) -> None:
        self.every, self.bins, self.idle_ms, self.run = every, bins, idle_ms, run

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "window long", "sums array<double>, counts array<long>, steps long")

    def closed(self, key, windows, sums, counts) -> pd.DataFrame:
        sums, counts = np.concatenate(sums).astype(float), np.concatenate(counts).astype(np.int64)
        return pd.DataFrame({
            self.run: [key[0]] * len(sums), "window": np.repeat(np.array(windows, np.int64), self.bins),
            "bin": np.tile(np.arange(self.bins, dtype=np.int32), len(windows)),
            "loss": sums / np.maximum(counts, 1), "n": counts,
        })

    def summed(self, frame: pd.DataFrame) -> Iterator[tuple]:
        """(window, sums, counts) of the windows of some rows, in time linear in them."""
        if frame["t"].isna().any():
            raise ValueError("a row has no timestep")
        step, loss = frame["step"].to_numpy(np.int64), frame["loss"].to_numpy(float)
        place = np.clip(np.floor(frame["t"].to_numpy(float) * self.bins), 0, self.bins - 1).astype(np.int64)
        windows, at = np.unique(-(-step // self.every), return_inverse=True)
        cell, cells = at * self.bins + place, len(windows) * self.bins
        sums = np.bincount(cell, loss, cells).reshape(-1, self.bins)
        counts = np.bincount(cell, minlength=cells).reshape(-1, self.bins)
        return zip(windows.tolist(), sums, counts)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # Rows are reduced as they come: a run's part of a micro-batch is held as its windows.
        found, last, done = {}, None, []
        for frame in rows:
            for w, sums, counts in self.summed(frame):
                before = found.get(w)
                found[w] = (sums, counts) if before is None else (before[0] + sums, before[1] + counts)
            latest = frame["ts"].max()
            last = latest if last is None or pd.isna(last) or latest > last else last
        for w in sorted(found):
            sums, counts = found.pop(w)
            steps = int(counts.sum())
            known = self.open.containsKey((w,))
            if known:
                before = self.open.getValue((w,))
                sums, counts, steps = sums + np.asarray(before[0]), counts + np.asarray(before[1]), steps + before[2]
            if steps == (1 if w == 0 else self.every):
                if known:
                    self.open.removeKey((w,))
                done.append((w, sums, counts))
            else:
                self.open.updateValue((w,), (sums.tolist(), counts.tolist(), steps))
        for start in range(0, len(done), OUT_WINDOWS):
            yield self.closed(key, *zip(*done[start : start + OUT_WINDOWS]))
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        last = pd.Timestamp(last)
        last = last.tz_localize("UTC") if last.tzinfo is None else last
        self.handle.registerTimer(int(last.timestamp() * 1000) + self.idle_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """The run is silent: what is open is reported as it stands."""
        for (window,), (sums, counts, _) in sorted(self.open.iterator()):
            yield self.closed(key, [window], [sums], [counts])
        self.open.clear()

    def close(self) -> None:
        pass


def log_window_stream(
    steps: DataFrame, every: int, *, bins: int = 10, delay: str = "10 minutes", idle_s: float = 3600.0, run: str = "run",
) -> DataFrame:
    """(run, window, bin, loss, n): as ``metrics.log_windows``, each window when its last step arrives.

    ``steps`` is a stream of (run, step, t, loss, ts), one row per step, in any order. The state holds the sums
    of open windows only. A run without a step for ``idle_s`` of event time has its open windows
    reported as they are. Rows later than ``delay`` may be dropped.
    """
    kinds = {f.name: f.dataType for f in steps.schema}
    out = T.StructType([
        T.StructField(run, kinds[run]), T.StructField("window", T.LongType()), T.StructField("bin", T.IntegerType()),
        T.StructField("loss", T.DoubleType()), T.StructField("n", T.LongType()),
    ])
    timed = steps.select(run, "step", "t", "loss", "ts").withWatermark("ts", delay)
    return timed.groupBy(run).transformWithStateInPandas(
        statefulProcessor=Windows(every, bins, int(idle_s * 1000), run), outputStructType=out, outputMode="append",
        timeMode="eventTime",
    )


def land(stream: DataFrame, out: str, checkpoint: str):
    """Append what a stream has so far to parquet and stop."""
    return (
        stream.writeStream.outputMode("append").format("parquet").option("path", out)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


ship_by_value(__name__)
