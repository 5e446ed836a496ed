"""Seeded draws as functions of a row's own key.

A draw depends only on (seed, stream, keys), never on partition or task, so a retried task
or another partitioning gives the same values. Keys should be integers or strings.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairloom.runtime import as_column

TWO_32 = 4294967296.0

# Coefficients of Acklam's published rational approximation of the inverse
# normal distribution (relative error below 1.2e-9).
ICDF_A = (
    -3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02,
    1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00,
)
ICDF_B = (
    -5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02,
    6.680131188771972e01, -1.328068155288572e01,
)
ICDF_C = (
    -7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00,
    -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00,
)
ICDF_D = (
    7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00,
    3.754408661907416e00,
)
ICDF_LOW = 0.02425


def digest(seed: int, stream: str, *keys: Column | str | int) -> Column:
    """Hex md5 of ``seed|stream|key|...``."""
    parts = [as_column(k).cast("string") for k in keys]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(stream), *parts))


def word(hex_digest: Column, i: int) -> Column:
    """The i-th of four 32-bit words of a digest, as a uniform strictly inside (0, 1)."""
    value = F.conv(F.substring(hex_digest, 8 * i + 1, 8), 16, 10).cast("bigint")
    return (value.cast("double") + 0.5) / TWO_32


def shuffle_order(seed: int, stream: str, *keys: Column | str | int) -> Column:
    """A random string per row to sort by: half a digest, 64 bits."""
    return F.substring(digest(seed, stream, *keys), 1, 16)


def uniform(seed: int, stream: str, *keys: Column | str | int) -> Column:
    return word(digest(seed, stream, *keys), 0)


def _box_muller(u1: Column, u2: Column, trig) -> Column:
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * trig(F.lit(2.0 * math.pi) * u2)


def normal(seed: int, stream: str, *keys: Column | str | int) -> Column:
    d = digest(seed, stream, *keys)
    return _box_muller(word(d, 0), word(d, 1), F.cos)


def normals(n: Column | int, seed: int, stream: str, *keys: Column | str | int) -> Column:
    """``array<double>`` of n standard normals; one digest serves four of them."""
    size = as_column(n)
    blocks = F.sequence(F.lit(0), F.ceil(size / 4).cast("int") - 1)
    digests = F.transform(blocks, lambda b: digest(seed, stream, *keys, b))
    words = F.transform(digests, lambda d: F.array(*[word(d, i) for i in range(4)]))
    quads = F.transform(
        words,
        lambda w: F.array(
            _box_muller(w[0], w[1], F.cos),
            _box_muller(w[0], w[1], F.sin),
            _box_muller(w[2], w[3], F.cos),
            _box_muller(w[2], w[3], F.sin),
        ),
    )
    empty = F.array().cast("array<double>")
    return F.when(size > 0, F.slice(F.flatten(quads), F.lit(1), size)).otherwise(empty)


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def _horner(coefficients: tuple[float, ...], x: Column) -> Column:
    total = F.lit(coefficients[0])
    for c in coefficients[1:]:
        total = total * x + F.lit(c)
    return total


def inverse_normal(p: Column) -> Column:
    """Inverse normal distribution, i.e. ``sqrt(2) * erfinv(2p - 1)``."""
    centre = p - 0.5
    square = centre * centre
    middle = _horner(ICDF_A, square) * centre / (_horner(ICDF_B, square) * square + 1.0)

    def tail(q: Column) -> Column:
        r = F.sqrt(F.lit(-2.0) * F.log(q))
        return _horner(ICDF_C, r) / (_horner(ICDF_D, r) * r + 1.0)

    return (
        F.when(p < ICDF_LOW, tail(p))
        .when(p > 1.0 - ICDF_LOW, -tail(F.lit(1.0) - p))
        .otherwise(middle)
    )
