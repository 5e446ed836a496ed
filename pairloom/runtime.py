"""Session helpers shared by the operators: scratch tables and guarded joins."""

from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A side larger than this is never hinted for broadcast.
BROADCAST_BYTES = 64 * 1024 * 1024
# Copies of the lookup side when a join is salted instead.
SALTS = 32
# A key with more rows than this is split over several tasks.
HOT_ROWS = 1_000_000


def ship_by_value(module_name: str) -> None:
    """Pickle a module's functions by value, so executors need not have the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder the session names in spark.checkpoint.dir.

    Only a local session without that setting falls back to a temporary folder: on a
    cluster the executors would not see the driver's disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="pairloom-")
    return f"{root.rstrip('/')}/pairloom/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later stages then depend on stored files, not on shuffle blocks of executors that may
    be lost, and each later read prunes columns.
    """
    spark = df.sparkSession
    path = work_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs that run inside send ``rows`` rows at most to Python at once, or fewer if the session says so.

    Both the JVM and Python hold a batch of whole texts, and each task has its own.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = int(spark.conf.get(key))
    spark.conf.set(key, rows if before <= 0 else min(rows, before))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def measured_bytes(df: DataFrame, *variable: str, fixed: int = 32) -> int:
    """Size of a lookup table: ``fixed`` bytes per row plus its strings and arrays."""
    kinds = dict(df.dtypes)
    size = F.lit(fixed).cast("bigint")
    for name in variable:
        length = F.size(name) * 8 if kinds[name].startswith("array") else F.octet_length(name)
        size = size + F.greatest(length, F.lit(0))
    return df.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]


def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    on: list[str],
    *,
    size: int,
    salt_by: list[str],
    how: str = "left",
    limit: int = BROADCAST_BYTES,
    salts: int = SALTS,
) -> DataFrame:
    """Equi-join a large, possibly skewed ``df`` with a lookup table of known size.

    ``size`` is an upper bound on the lookup's bytes. Within ``limit`` the lookup is
    broadcast and ``df`` does not move. Beyond it both are shuffled, and keys that very many rows
    of ``df`` share are split as in :func:`skewed_join`; the rest of the lookup moves once.
    """
    if size <= limit:
        return df.join(F.broadcast(lookup), on, how)
    return skewed_join(df, lookup, on, salt_by=salt_by, salts=salts, how=how)


def skewed_join(
    df: DataFrame, other: DataFrame, key: str | list[str], *, salt_by: list[str] | None = None,
    hot_rows: int = HOT_ROWS, salts: int = SALTS, how: str = "left",
) -> DataFrame:
    """Join of two large tables where a key may repeat very often in ``df``.

    Keys with more than ``hot_rows`` rows are found by a count that is combined before its
    shuffle; there can be only rows / ``hot_rows`` of them. Their rows spread over ``salts`` tasks
    by a hash of ``salt_by`` (all columns by default) and only their matches are copied. Rows
    without a key match nothing and spread as well.
    """
    keys = [key] if isinstance(key, str) else list(key)
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    hot = counts.where(F.col("_n") > hot_rows).select(*keys, F.lit(True).alias("_hot"))
    row_hash = F.pmod(F.xxhash64(*(salt_by or df.columns)), F.lit(salts)).cast("int")
    apart = F.col("_hot")
    for k in keys:
        apart = apart | F.col(k).isNull()
    spread = df.join(F.broadcast(hot), keys, "left").withColumn("_salt", F.when(apart, row_hash).otherwise(0))
    every = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    copies = other.join(F.broadcast(hot), keys, "left").withColumn("_salt", F.explode(every))
    return spread.drop("_hot").join(copies.drop("_hot"), [*keys, "_salt"], how).drop("_salt")


def as_column(c: Column | str | int) -> Column:
    """A column from its name; numbers are literals."""
    if isinstance(c, Column):
        return c
    return F.col(c) if isinstance(c, str) else F.lit(c)
