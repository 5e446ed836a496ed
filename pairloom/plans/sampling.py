"""Replay a guided sampling run from velocity tables, down to pixels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.functions.arrays import denormalize_latent, denormalize_pixels
from pairloom.operators.flow import guide, replay_predictions


def decoded_steps(
    noise_rows: DataFrame, cond: DataFrame, uncond: DataFrame | None = None, *, n: int = 50,
    cfg: float = 4.0, dim: int, shift: float, scale: float, wide: bool = False,
) -> DataFrame:
    """(key, step, latent): what each step would decode, on the image encoder's scale."""
    velocity = guide(cond, uncond, cfg, wide=wide)
    seen = replay_predictions(noise_rows, velocity, n, dim=dim)
    return seen.select("key", "step", denormalize_latent("z", shift, scale, wide).alias("latent"))


def to_pixels(df: DataFrame, image: Column | str = "image", out: str = "pixels") -> DataFrame:
    """Decoder output in [-1, 1] to 0..255. The decoder itself plugs in as an encoder does."""
    return df.withColumn(out, denormalize_pixels(F.col(image) if isinstance(image, str) else image))
