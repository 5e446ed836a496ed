"""Element-wise array arithmetic as Column expressions.

``wide=True`` picks the Arrow kernel, meant for rows of thousands of values; the default
stays in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairloom.functions import kernels
from pairloom.runtime import as_column


def doubles(x: Column | str) -> Column:
    """Array arithmetic on floats stays in single precision unless cast first."""
    return as_column(x).cast("array<double>")


def zeros(n: Column | int) -> Column:
    return F.array_repeat(F.lit(0.0), n)


def normalize_latent(x: Column | str, shift: float, scale: float, wide: bool = False) -> Column:
    """``(x - shift) * scale``; the constants belong to the image encoder."""
    if wide:
        return kernels.affine(x, shift, scale)
    return F.transform(doubles(x), lambda v: (v - F.lit(shift)) * F.lit(scale))


def denormalize_latent(x: Column | str, shift: float, scale: float, wide: bool = False) -> Column:
    """``x / scale + shift``."""
    if wide:
        return kernels.affine(x, 0.0, 1.0 / scale, shift)
    return F.transform(doubles(x), lambda v: v / F.lit(scale) + F.lit(shift))


def normalize_pixels(x: Column | str, wide: bool = False) -> Column:
    """0..255 to [0, 1], then centred to [-1, 1]."""
    if wide:
        return kernels.affine(x, 127.5, 1.0 / 127.5)
    return F.transform(doubles(x), lambda v: (v / 255.0 - 0.5) / 0.5)


def denormalize_pixels(x: Column | str) -> Column:
    """Back to 0..255: clipped, scaled and truncated, not rounded."""

    def pixel(v: Column) -> Column:
        unit = F.greatest(F.lit(0.0), F.least(F.lit(1.0), v * 0.5 + 0.5))
        return (unit * 255.0).cast("int")

    return F.transform(doubles(x), pixel)


def round_bf16(x: Column | str) -> Column:
    return kernels.round_bf16(x)


def mean_squared_error(a: Column | str, b: Column | str, wide: bool = False) -> Column:
    if wide:
        return kernels.mean_squared_error(a, b)
    squares = F.zip_with(doubles(a), doubles(b), lambda u, w: (u - w) * (u - w))
    total = F.aggregate(squares, F.lit(0.0), lambda acc, v: acc + v)
    return total / F.size(as_column(a))


def timestep_features(t: Column | str, dim: int = 256, max_period: float = 10000.0) -> Column:
    """Sinusoidal features: ``cos(t f_k)`` for all k, then ``sin(t f_k)``, 0-padded if odd."""
    half = dim // 2
    if half < 1:
        raise ValueError("dim must be at least 2")
    time = as_column(t).cast("double")
    ranks = F.sequence(F.lit(0), F.lit(half - 1))
    angles = F.transform(
        ranks, lambda k: time * F.exp(-F.log(F.lit(max_period)) * k.cast("double") / F.lit(half))
    )
    parts = [F.transform(angles, F.cos), F.transform(angles, F.sin)]
    if dim % 2:
        parts.append(F.array(F.lit(0.0)))
    return F.concat(*parts)
