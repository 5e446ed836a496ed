"""Latents: sampling around a mean, and patch rearrangement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.functions import kernels
from pairloom.functions.arrays import doubles
from pairloom.functions.rand import normals
from pairloom.runtime import as_column


def noise(n: Column, source: str, seed: int, stream: str, *keys: Column | str | int) -> Column:
    """Standard normals per row: ``md5`` in the JVM, ``philox`` in numpy for wide rows."""
    if source == "md5":
        return normals(n, seed, stream, *keys)
    if source == "philox":
        return kernels.philox_normals(n, seed, stream, *keys)
    raise ValueError(f"unknown noise source {source!r}")


def sample_latent(
    df: DataFrame, mean: str, std: str | float, seed: int, *, key: str = "id",
    source: str = "md5", out: str = "latent",
) -> DataFrame:
    """``mean + std * eps`` with eps drawn per element."""
    centre = doubles(mean)
    drawn = df.withColumn("_eps", noise(F.size(mean), source, seed, "latent", key))
    if isinstance(std, str):
        spread = F.zip_with(doubles(std), "_eps", lambda s, e: s * e)
    else:
        spread = F.transform("_eps", lambda e: F.lit(float(std)) * e)
    return drawn.withColumn(out, F.zip_with(centre, spread, lambda m, s: m + s)).drop("_eps")


def _check_patch(h: int, w: int, p: int) -> None:
    if h % p or w % p:
        raise ValueError(f"patch {p} does not divide {h}x{w}")


def patch_tokens(x: Column | str, c: int, h: int, w: int, p: int, wide: bool = True) -> Column:
    """Tokens of a flat (C, H, W) array, row-major over patches, each ordered (p1, p2, c).

    The Arrow kernel is the default: index arithmetic in lambdas took ten times as long even
    for 64 values.
    """
    _check_patch(h, w, p)
    if wide:
        return kernels.patches(x, c, h, w, p)
    data, across = doubles(x), w // p

    def value(patch: Column, j: Column) -> Column:
        channel = j % c
        row = F.floor(patch / across) * p + F.floor(j / (p * c))
        col = (patch % across) * p + F.floor(j / c) % p
        return data[(channel * (h * w) + row * w + col).cast("int")]

    inside = F.sequence(F.lit(0), F.lit(p * p * c - 1))
    return F.transform(
        F.sequence(F.lit(0), F.lit((h // p) * across - 1)),
        lambda patch: F.transform(inside, lambda j: value(patch, j)),
    )


def patchify(
    df: DataFrame, c: int, h: int, w: int, p: int = 2, *, key: str = "id", x: str = "x", wide: bool = True
) -> DataFrame:
    """(key, patch, token): one row per patch; no row crosses tasks."""
    return df.select(key, F.posexplode(patch_tokens(x, c, h, w, p, wide)).alias("patch", "token"))


def unpatchify(
    df: DataFrame, c: int, h: int, w: int, p: int = 2, *, key: str = "id", out: str = "x", wide: bool = True
) -> DataFrame:
    """Inverse of :func:`patchify`. A group holds the (h/p)(w/p) patches of one latent."""
    _check_patch(h, w, p)
    across, length = w // p, p * p * c
    ordered = F.array_sort(F.collect_list(F.struct("patch", "token")))
    flat = df.groupBy(key).agg(F.flatten(F.transform(ordered, lambda e: e["token"])).alias("_flat"))
    if wide:
        return flat.select(key, kernels.unpatch("_flat", c, h, w, p).alias(out))

    def value(o: Column) -> Column:
        channel = F.floor(o / (h * w))
        row = F.floor(o / w) % h
        col = o % w
        patch = F.floor(row / p) * across + F.floor(col / p)
        j = ((row % p) * p + col % p) * c + channel
        return F.col("_flat")[(patch * length + j).cast("int")]

    return flat.select(key, F.transform(F.sequence(F.lit(0), F.lit(c * h * w - 1)), value).alias(out))


def to_long(df: DataFrame, *keys: str, x: str, pos: str = "pos", value: str = "value") -> DataFrame:
    """One row per element: (keys, pos, value)."""
    return df.select(*keys, F.posexplode(as_column(x)).alias(pos, value))
