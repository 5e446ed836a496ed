from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.functions import rand
from pairloom.operators.latents import noise


def draws(spark, n, column, partitions=4):
    return [row[0] for row in spark.range(0, n, 1, partitions).select(column).collect()]


def test_uniform_is_inside_and_even(spark):
    u = np.array(draws(spark, 20_000, rand.uniform(1, "s", "id")))
    assert u.min() > 0 and u.max() < 1
    assert np.all(np.abs(np.histogram(u, 10, (0, 1))[0] - 2000) < 200)


@pytest.mark.parametrize("source", ["md5", "philox"])
def test_noise_is_standard_normal(spark, source):
    rows = draws(spark, 400, noise(F.lit(101), source, 5, "eps", 0, "id"))
    x = np.array(rows)
    assert x.shape == (400, 101)
    assert abs(x.mean()) < 0.02 and abs(x.std() - 1) < 0.02
    assert abs(np.corrcoef(x[:, 0], x[:, 1])[0, 1]) < 0.2


@pytest.mark.parametrize("source", ["md5", "philox"])
@pytest.mark.parametrize("partitions", [1, 4, 7])
def test_noise_does_not_depend_on_partitions(spark, source, partitions):
    column = noise(F.lit(9), source, 5, "eps", 0, "id")
    assert draws(spark, 50, column, partitions) == draws(spark, 50, column, 3)


@pytest.mark.parametrize("source", ["md5", "philox"])
def test_streams_seeds_and_epochs_differ(spark, source):
    seen = {
        tuple(draws(spark, 3, noise(F.lit(4), source, seed, stream, epoch, "id"))[0])
        for seed in (1, 2) for stream in ("a", "b") for epoch in (0, 1)
    }
    assert len(seen) == 8


def test_empty_noise(spark):
    assert draws(spark, 1, rand.normals(F.lit(0), 1, "s", "id")) == [[]]


def test_inverse_normal(spark):
    p = (F.col("id") + 0.5) / 2000
    got = draws(spark, 2000, rand.inverse_normal(p), 1)
    want = [NormalDist().inv_cdf((i + 0.5) / 2000) for i in range(2000)]
    assert np.allclose(got, want, atol=1e-8)
