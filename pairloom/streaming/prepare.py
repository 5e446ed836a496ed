"""Incremental preparation: each new raw file becomes sample rows exactly once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pairloom.operators.text import share_vocab
from pairloom.plans.preparation import prepare, write_prepared
from pairloom.schemas import RAW_SAMPLE


def prepare_stream(
    spark: SparkSession, source: str, out: str, checkpoint: str, vocab: DataFrame, *,
    shift: float, scale: float, length: int = 128, max_files: int | None = None, wide: bool = False,
    report: Callable[[int, dict[str, int]], None] | None = None,
) -> StreamingQuery:
    """Start a run over all files not yet seen; it ends when they are done.

    Rows land below ``out/batch=<id>/verdict=<ok or reason>``, so readers of good or rejected
    rows open only their folders. A batch repeated after a failure overwrites its own folder:
    nothing lands twice. The vocabulary is measured and sent to the tasks once per run.
    ``report`` is called with each batch's number and its rows per verdict, counted by its write.
    """
    shared = share_vocab(vocab)
    files = spark.readStream.schema(RAW_SAMPLE)
    if max_files:
        files = files.option("maxFilesPerTrigger", max_files)

    def land(batch: DataFrame, batch_id: int) -> None:
        prepared = prepare(
            batch, shared, shift=shift, scale=scale, length=length, wide=wide
        )
        counts = write_prepared(prepared, f"{out}/batch={batch_id}")
        if report:
            report(batch_id, counts)

    return (
        files.parquet(source)
        .writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
