import time
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pairloom.operators.metrics import log_windows
from pairloom.sources.manifest import attach_payloads
from pairloom.streaming.payloads import attach_arrivals
from pairloom.streaming.state import Windows, batch_stream, land, log_window_stream, stateful_session

START = datetime(2024, 1, 1)


def test_open_batches_wait_across_a_restart(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    rows = spark.range(100).select((F.col("id") % 2).alias("worker"), F.lit(0).alias("epoch"), F.col("id").alias("idx"), "id")
    session = stateful_session(spark)
    for low, high in ((0, 30), (30, 37), (37, 100)):
        rows.where(f"id >= {low} and id < {high}").coalesce(1).write.mode("append").parquet(source)
        stream = session.readStream.schema(rows.schema).parquet(source)
        land(batch_stream(stream, 8), out, state).awaitTermination()
    got = {(r["worker"], r["batch_id"], r["pos"]): r["id"] for r in spark.read.parquet(out).collect()}
    assert got == {(w, k // 8, k % 8): 2 * k + w for w in (0, 1) for k in range(48)}
    with pytest.raises(ValueError):
        batch_stream(stream, 0)


def steps(spark, runs):
    rows = [(run, i, i % 10 / 10, float(i), START + timedelta(minutes=i)) for run, n in runs.items() for i in range(n)]
    return spark.createDataFrame(rows, "run string, step long, t double, loss double, ts timestamp")


def test_log_windows_close_by_count_and_by_silence(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    rows = steps(spark, {"a": 25, "b": 400})
    session = stateful_session(spark)
    for part in ("step < 13", "step >= 13 and step < 60", "step >= 60"):
        rows.where(part).coalesce(1).write.mode("append").parquet(source)
        stream = session.readStream.schema(rows.schema).parquet(source)
        windows = log_window_stream(stream, 10, delay="1 minute", idle_s=600)
        land(windows, out, state).awaitTermination()
    found = spark.read.parquet(out)
    whole = log_windows(rows, 10, whole=True)
    # Run a ends within a window, which leaves once the other run is far ahead.
    silent = log_windows(rows.where("run = 'a' and step > 20"), 10)
    columns = ["run", "window", "bin", "loss", "n"]
    wanted = whole.select(columns).collect() + silent.select(columns).collect()
    assert sorted(map(tuple, found.select(columns).collect())) == sorted(map(tuple, wanted))


class Held:
    """State and timers of one run, in memory."""

    def __init__(self):
        self.kept, self.timers = {}, []
        self.containsKey, self.getValue, self.removeKey = self.kept.__contains__, self.kept.get, self.kept.pop
        self.updateValue = self.kept.__setitem__
        self.listTimers, self.deleteTimer, self.registerTimer = lambda: self.timers, self.timers.remove, self.timers.append

    def getMapState(self, *_):
        return self


def test_windows_of_a_run_take_linear_time():
    n, every = 1_000_000, 100
    step = np.random.default_rng(3).permutation(n)
    frame = pd.DataFrame({"step": step, "t": step % 10 / 10, "loss": step % 7.0, "ts": pd.Timestamp(START)})
    held, windows = Held(), Windows(every, 10, 1000, "run")
    windows.init(held)
    begin = time.process_time()
    out = pd.concat(windows.handleInputRows(("a",), iter([frame[:400_000], frame[400_000:]]), None))
    assert time.process_time() - begin < 12
    # All windows are full but the last, which lacks the step that closes it.
    assert list(held.kept) == [(n // every,)] and held.kept[n // every,][2] == every - 1
    assert len(out) == n // every * 10 and out["n"].sum() == n - every + 1
    wanted = frame[frame["step"] <= n - every].groupby([-(-frame["step"] // every), frame["step"] % 10])["loss"].mean()
    got = out[out["n"] > 0].set_index(["window", "bin"])["loss"]
    assert np.allclose(got.sort_index().to_numpy(), wanted.sort_index().to_numpy())


def test_arrivals_equal_the_batch_join(spark, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    asked = [(i, f"u{i}", START + timedelta(seconds=i)) for i in range(40)]
    landed = [(i, b"x" * i if i % 7 else None, START + timedelta(seconds=i + i % 12)) for i in range(40) if i % 5]
    far = START + timedelta(days=9)
    frames = {
        "asked": (asked, [(-1, "", far)], "id long, url string, requested_at timestamp"),
        "landed": (landed, [(-1, None, far)], "id long, data binary, landed_at timestamp"),
    }
    streams = {}
    for name, (rows, end, schema) in frames.items():
        for part in (rows[:15], rows[15:], end):
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / name))
        streams[name] = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / name))
    land(attach_arrivals(streams["asked"], streams["landed"]), out, state).awaitTermination()
    got = {r["id"]: (r["status"], r["data"]) for r in spark.read.parquet(out).where("id >= 0").collect()}
    manifest = spark.createDataFrame(asked, frames["asked"][2])
    payloads = spark.createDataFrame([(i, d, float((t - START).seconds - i)) for i, d, t in landed], "id long, data binary, elapsed_s double")
    wanted = {r["id"]: (r["status"], r["data"]) for r in attach_payloads(manifest, payloads).collect()}
    # Without a landing the stream has waited for the deadline.
    absent = {i for i in range(40) if not i % 5}
    assert got == {i: (("timeout" if i in absent else s), d) for i, (s, d) in wanted.items()}
