"""Metadata manifests and the payloads landed for them."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FOOTER_READS = 16


def load_metadata_shards(
    spark: SparkSession, folder: str, n: int, pattern: str = "metadata.{i:02d}.parquet",
    schema: T.StructType | None = None,
) -> DataFrame:
    """Concatenate shards 0..n-1 in one scan.

    Every shard must have, in any order, the columns and types of ``schema``, or of the first shard if none
    is given; this reads footers only, those of several shards at a time.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    paths = [f"{folder.rstrip('/')}/{pattern.format(i=i)}" for i in range(n)]
    with ThreadPoolExecutor(FOOTER_READS) as pool:
        found = list(pool.map(lambda path: spark.read.parquet(path).schema, paths))
    schema = schema or found[0]
    wanted = sorted((f.name, f.dataType.simpleString()) for f in schema)
    for path, own in zip(paths, found):
        fields = sorted((f.name, f.dataType.simpleString()) for f in own)
        if fields != wanted:
            raise ValueError(f"{path} has schema {fields}, expected {wanted}")
    return spark.read.schema(schema).parquet(*paths)


def write_manifest(df: DataFrame, path: str) -> int:
    """Write the manifest and report how many rows lie there."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).count()


def project_manifest(
    df: DataFrame, url_col: str = "url", caption_col: str = "caption",
    extra: tuple[str, ...] = ("id", "source"),
) -> DataFrame:
    """The pass-through columns, then ``url`` and ``caption`` under their standard names."""
    return df.select(*extra, F.col(url_col).alias("url"), F.col(caption_col).alias("caption"))


def _landed(payloads: DataFrame, timeout_s: float, key: str) -> DataFrame:
    """(key, data, status), one row per key: a fetch that landed again counts once, the best first.

    Bytes of timed-out fetches go before anything is shuffled.
    """
    late = F.col("elapsed_s") > timeout_s
    status = (
        F.when(late, F.lit("timeout")).when(F.col("data").isNull(), F.lit("missing")).otherwise("ok")
    )
    data = F.when(~late, F.col("data"))
    rank = F.when(status == "ok", 0).when(status == "timeout", 1).otherwise(2)
    tried = payloads.select(
        key, F.struct(data.alias("data"), status.alias("status")).alias("_got"),
        F.struct(rank.alias("rank"), "elapsed_s", F.xxhash64("data").alias("hash")).alias("_order"),
    )
    return tried.groupBy(key).agg(F.min_by("_got", "_order").alias("_got")).select(key, "_got.*")


def attach_payloads(
    manifest: DataFrame, payloads: DataFrame, timeout_s: float = 8, *, key: str = "id"
) -> DataFrame:
    """Manifest rows with their landed ``data`` and a ``status``: ok, missing or timeout.

    A fetch slower than ``timeout_s`` counts as timed out and its bytes are dropped.
    ``payloads`` is (key, data, elapsed_s); of several rows of a key a usable one counts, the
    fastest if there are more. The join uses the grouping of that choice, so bytes move once.
    """
    joined = manifest.join(_landed(payloads, timeout_s, key), key, "left")
    return joined.withColumn("status", F.coalesce("status", F.lit("missing")))


def retry_list(
    manifest: DataFrame, payloads: DataFrame, timeout_s: float = 8, *, key: str = "id"
) -> DataFrame:
    """Manifest rows without a usable payload. No payload byte is shuffled."""
    usable = payloads.where((F.col("elapsed_s") <= timeout_s) & F.col("data").isNotNull()).select(key)
    return manifest.join(usable, key, "left_anti")


def list_assets(spark: SparkSession, folder: str) -> DataFrame:
    """(path) of every file below ``folder``; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select("path")


def count_assets(paths: DataFrame, path: str = "path") -> DataFrame:
    """(ext, n) per extension, case-insensitive; files without one count under ''."""
    ext = F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))
    return paths.groupBy(ext.alias("ext")).agg(F.count("*").alias("n"))
