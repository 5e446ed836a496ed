"""Live loss monitor: mean loss per tumbling window and timestep bin."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pairloom.operators.metrics import timestep_bin


def loss_monitor(
    stream: DataFrame, window: str = "1 hour", delay: str = "10 minutes", *, ts: str = "ts",
    t: str = "t", loss: str = "loss", bins: int = 10,
) -> DataFrame:
    """(window_start, window_end, bin, loss, n).

    Rows later than ``delay`` are dropped. State is one row per open window and bin. ``ts``
    is a timestamp with time zone semantics; cast TIMESTAMP_NTZ first.
    """
    timed = stream.select(F.col(ts).alias("ts"), timestep_bin(t, bins).alias("bin"), F.col(loss).alias("_loss"))
    groups = timed.withWatermark("ts", delay).groupBy(F.window("ts", window), "bin")
    means = groups.agg(F.avg("_loss").alias("loss"), F.count("*").alias("n"))
    return means.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "bin", "loss", "n",
    )


def start_monitor(monitor: DataFrame, out: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append closed windows to parquet; ``once`` drains what is there and stops."""
    writer = (
        monitor.writeStream.outputMode("append").format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if once else writer).start()
