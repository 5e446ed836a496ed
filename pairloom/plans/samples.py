"""Tar shards of images and captions to a sharded table of encoded samples."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.functions.arrays import round_bf16
from pairloom.operators.index import with_arrival_index
from pairloom.operators.latents import sample_latent
from pairloom.operators.samples import extract_caption, is_json, pick_first, split_valid, with_sample_key
from pairloom.operators.text import encode_batches
from pairloom.runtime import materialize
from pairloom.sources.shards import PREPARED_SHARD_ROWS
from pairloom.sources.tar import import_tar_shards

ENCODED = (
    "source_shard string, source_key string, caption string, latent_mean array<float>, "
    "latent_std array<float>, prompt_embeds array<float>"
)


def read_pairs(spark: SparkSession, tars: str) -> tuple[DataFrame, DataFrame]:
    """(pairs, rejected): image bytes with a caption, and records that lack either."""
    members = import_tar_shards(spark, tars).withColumn("note", F.decode("json", "UTF-8"))
    read = extract_caption(pick_first(members, ["jpg", "png"], "image"), "note")
    rules = {
        "no_image": F.col("image").isNotNull(),
        "bad_json": is_json("note"),
        "no_caption": F.col("caption").isNotNull(),
    }
    good, rejected = split_valid(read, rules)
    names = (F.col("shard").alias("source_shard"), F.col("key").alias("source_key"))
    return good.select(*names, "image", "caption"), rejected.select(*names, "reason")


def build_samples(
    pairs: DataFrame, out: str, encoder: Callable, *, seed: int, batch_size: int = 64,
    maxcount: int = PREPARED_SHARD_ROWS, name: str | None = None, source: str = "philox",
) -> None:
    """Encode pairs and write them below ``out/shard=<n>`` as (key, source names, latent, ...).

    ``encoder`` turns a batch of (source_shard, source_key, image, caption) into columns
    ``ENCODED``. Encoding is the costly part and is stored before rows are numbered; numbering
    by file position then moves none of the wide rows. The position key loses where a sample
    came from, so the source names stay beside it.
    """
    encoded = encode_batches(pairs, encoder, ENCODED, batch_size, name)
    identity = F.concat_ws("/", "source_shard", "source_key")
    drawn = sample_latent(
        encoded.withColumn("_id", identity), "latent_mean", "latent_std", seed, key="_id", source=source
    )
    latent = round_bf16(F.col("latent").cast("array<float>"))
    narrow = drawn.select(
        "source_shard", "source_key", "caption", latent.alias("latent"),
        round_bf16("prompt_embeds").alias("prompt_embeds"),
    )
    numbered = with_sample_key(with_arrival_index(materialize(narrow, "encoded")), batch_size)
    shard = F.floor(F.col("idx") / maxcount).cast("int")
    numbered.withColumn("shard", shard).drop("idx").write.partitionBy("shard").parquet(out)
