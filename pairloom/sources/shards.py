"""Sample tables laid out in shards of a fixed row count."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.operators.index import with_arrival_index, with_index

# Rows per raw shard, and per prepared shard (64 rows x 500 batches).
RAW_SHARD_ROWS = 10_000
PREPARED_SHARD_ROWS = 64 * 500

SHARD_SPEC = re.compile(r"\{(\d+)\.\.(\d+)\}")


def with_shards(
    df: DataFrame, maxcount: int, order_by: list[str] | None = None, partitions: int | None = None
) -> DataFrame:
    """Add ``shard`` = row number div ``maxcount``.

    Rows are numbered by ``order_by`` (unique), or for a plain parquet scan as they lie in
    the files, which moves no row.
    """
    if maxcount < 1:
        raise ValueError("maxcount must be at least 1")
    indexed = with_index(df, *order_by, partitions=partitions) if order_by else with_arrival_index(df)
    return indexed.withColumn("shard", F.floor(F.col("idx") / maxcount).cast("int")).drop("idx")


def write_sample_shards(
    df: DataFrame, path: str, maxcount: int = PREPARED_SHARD_ROWS, *,
    order_by: list[str] | None = None, partitions: int | None = None,
) -> None:
    """Write a table partitioned by ``shard``.

    Numbered rows already lie together, so they are written where they are: a shard that
    spans several tasks has several files, and no second shuffle is spent on merging them.
    """
    sharded = with_shards(df, maxcount, order_by, partitions)
    sharded.write.partitionBy("shard").parquet(path)


def shard_name(shard: str = "shard", width: int = 6):
    """Zero-padded shard name."""
    return F.lpad(F.col(shard).cast("string"), width, "0")


def shard_bounds(spec: str) -> tuple[int, int]:
    """Inclusive bounds of a brace range such as ``{000000..000112}``."""
    found = SHARD_SPEC.search(spec)
    if not found:
        raise ValueError(f"no shard range in {spec!r}")
    low, high = int(found.group(1)), int(found.group(2))
    if low > high:
        raise ValueError(f"empty shard range {spec!r}")
    return low, high


def read_shard_range(spark: SparkSession, path: str, spec: str) -> DataFrame:
    """Rows of a shard range; other shards' folders are not opened."""
    low, high = shard_bounds(spec)
    return spark.read.parquet(path).where(F.col("shard").between(low, high))
