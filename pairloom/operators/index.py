"""Consecutive row numbers 0..n-1 without passing all rows through one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairloom.runtime import lookup_join, materialize

# monotonically_increasing_id() holds the partition above this bit and the row below it.
ROW_BITS = 33
# Tables known to be at most this long are sorted in one task.
SINGLE_SORT_ROWS = 1_000_000


def _starts(counts: DataFrame, block: str) -> DataFrame:
    """First row number of each block, from one count per block.

    The window has no partition key, but sees one row per partition or file only.
    """
    before = Window.orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(block, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))


def with_index(
    df: DataFrame, *keys: str, out: str = "idx", partitions: int | None = None, rows: int | None = None
) -> DataFrame:
    """Number rows in the order of ``keys``, which together must be unique.

    With ``rows``, an upper bound on the row count, a small table is numbered by one sort.
    Otherwise: one range shuffle. The ranges come from a sample, so the sorted rows are stored before
    they are counted: a second evaluation could cut them elsewhere.
    """
    if rows is not None and rows <= SINGLE_SORT_ROWS:
        place = F.row_number().over(Window.orderBy(*keys)).cast("bigint") - 1
        return df.withColumn(out, place)
    args = [partitions, *keys] if partitions else list(keys)
    placed = (
        df.repartitionByRange(*args)
        .sortWithinPartitions(*keys)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    stored = materialize(placed, "index").withColumn("_block", F.shiftright("_at", ROW_BITS))
    starts = _starts(stored.groupBy("_block").agg(F.count("*").alias("_n")), "_block")
    row = F.col("_at").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    # One row per range partition: the partition count bounds the broadcast.
    return (
        stored.join(F.broadcast(starts), "_block")
        .withColumn(out, F.col("_start") + row)
        .drop("_at", "_block", "_start")
    )


def with_arrival_index(scan: DataFrame, out: str = "idx") -> DataFrame:
    """Number rows of a parquet scan as they lie in the files, files ordered by path.

    No row moves: the position inside a file is scan metadata, and one count per file gives
    the offsets. ``scan`` must come straight from ``spark.read.parquet`` (filters and
    projections that drop rows belong after it).
    """
    located = scan.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.row_index").alias("_row"),
    )
    counts = scan.groupBy(F.col("_metadata.file_path").alias("_file")).agg(F.count("*").alias("_n"))
    size = sum(2 * len(path) + 32 for path in scan.inputFiles())
    joined = lookup_join(
        located, _starts(counts, "_file"), ["_file"],
        size=size, salt_by=["_row"], how="inner",
    )
    return joined.withColumn(out, F.col("_start") + F.col("_row")).drop("_file", "_row", "_start")
