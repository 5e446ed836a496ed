"""Image geometry: what a resize or crop would do, from width and height alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def plan_ingest_resize(
    df: DataFrame, size: int = 256, width: str = "w", height: str = "h", format_col: str | None = None
) -> DataFrame:
    """Shrink so that the shorter side is ``size``; smaller images keep their bytes.

    New sides are rounded half to even. ``reencode`` is true for resized images and, where
    ``format_col`` names the source format, for any that is not already jpg.
    """
    w, h = F.col(width), F.col(height)
    short = F.least(w, h)
    bigger = short > size
    scale = F.lit(float(size)) / short

    def side(c):
        return F.when(bigger, F.bround(c * scale)).otherwise(c).cast("int")

    reencode = bigger
    if format_col:
        reencode = bigger | ~F.lower(format_col).isin("jpg", "jpeg")
    return df.select(
        "*", side(w).alias("out_w"), side(h).alias("out_h"), bigger.alias("resized"),
        reencode.alias("reencode"),
    )


def plan_center_crop(df: DataFrame, size: int = 256, width: str = "w", height: str = "h") -> DataFrame:
    """Bring the shorter side to ``size``, up or down, then crop the centre square.

    The longer side is truncated; offsets are rounded half to even.
    """
    w, h = F.col(width), F.col(height)
    longer = F.floor(F.lit(size) * F.greatest(w, h) / F.least(w, h)).cast("int")
    resized = df.select(
        "*",
        F.when(w <= h, F.lit(size)).otherwise(longer).alias("resized_w"),
        F.when(w <= h, longer).otherwise(F.lit(size)).alias("resized_h"),
    )

    def offset(c):
        return F.bround((F.col(c) - size) / 2.0).cast("int")

    return resized.select(
        "*", offset("resized_h").alias("crop_top"), offset("resized_w").alias("crop_left"),
        F.lit(size).alias("crop_size"),
    )
