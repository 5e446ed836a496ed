"""The manifest job: metadata shards to a manifest, fetched images in raw shards, and a list to retry."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pairloom.operators.images import plan_ingest_resize
from pairloom.sources.manifest import attach_payloads, load_metadata_shards, project_manifest, write_manifest
from pairloom.sources.shards import RAW_SHARD_ROWS, write_sample_shards

STATUSES = ("ok", "missing", "timeout")


@dataclass
class Ingested:
    """Where the job's tables lie below its folder, and how many rows they have."""

    manifest: str
    raw: str
    retry: str
    rows: int
    counts: dict[str, int]


def ingest(
    spark: SparkSession, metadata: str, n: int, payloads: DataFrame, out: str, *, pattern: str, url_col: str = "url",
    caption_col: str = "caption", extra: tuple[str, ...] = ("id", "source"), timeout_s: float = 8, size: int = 256,
    maxcount: int = RAW_SHARD_ROWS, key: str = "id",
) -> Ingested:
    """Consolidate ``n`` metadata shards and lay out what was fetched for them.

    ``payloads`` holds (key, data, elapsed_s, w, h, format) of landed fetches. The manifest is written
    and counted; its rows meet their payloads once, and one write lays them out by status and counts each.
    Usable images go on with their resize plan into raw shards of ``maxcount`` rows, numbered as they
    lie, so no image moves again; the others are the rows to retry, without bytes.
    """
    out = out.rstrip("/")
    place = Ingested(f"{out}/manifest", f"{out}/raw", f"{out}/retry", 0, {})
    shards = load_metadata_shards(spark, metadata, n, pattern)
    place.rows = write_manifest(project_manifest(shards, url_col, caption_col, extra), place.manifest)
    manifest = spark.read.parquet(place.manifest)

    seen = Observation("statuses")
    joined = attach_payloads(manifest, payloads.select(key, "data", "elapsed_s"), timeout_s, key=key)
    counted = joined.observe(seen, *[F.count_if(F.col("status") == s).alias(s) for s in STATUSES])
    counted.write.partitionBy("status").parquet(f"{out}/fetched")
    place.counts = {s: c for s, c in seen.get.items() if c}

    fetched = spark.read.schema(joined.schema).parquet(f"{out}/fetched")
    rest = fetched.where(F.col("status") != "ok")
    rest.select(*manifest.columns, "status").write.parquet(place.retry)
    sizes = payloads.where(F.col("data").isNotNull() & (F.col("elapsed_s") <= timeout_s)).groupBy(key).agg(
        F.min_by(F.struct("w", "h", "format"), "elapsed_s").alias("_size")
    )
    usable = fetched.where(F.col("status") == "ok").join(sizes, key).select(*manifest.columns, "data", "_size.*")
    planned = plan_ingest_resize(usable, size, format_col="format")
    planned.write.parquet(f"{out}/planned")
    write_sample_shards(spark.read.schema(planned.schema).parquet(f"{out}/planned"), place.raw, maxcount)
    return place
