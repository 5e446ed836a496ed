import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.functions import arrays
from pairloom.operators import latents as lat
from pairloom.schemas import checked_width


def wide(spark, n, rows=3, partitions=2):
    x = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: ((k + F.col("id") * 7) % 101).cast("float") / 10)
    return spark.range(0, rows, 1, partitions).select("id", x.alias("x"))


def grid(df, column="x"):
    return {r["id"]: np.array(r[column]) for r in df.collect()}


@pytest.mark.parametrize("wide_rows", [True, False])
def test_normalize_round_trip(spark, wide_rows):
    df = wide(spark, 100)
    y = arrays.normalize_latent("x", 0.1159, 0.3611, wide_rows)
    back = df.withColumn("y", y).withColumn("x2", arrays.denormalize_latent("y", 0.1159, 0.3611, wide_rows))
    for r in back.collect():
        assert np.allclose(r["x"], r["x2"])
        assert np.allclose((np.array(r["x"]) - 0.1159) * 0.3611, r["y"])


def test_wide_pixels_agree(spark):
    df = spark.range(1).select(F.sequence(F.lit(0), F.lit(255)).alias("x"))
    a, b = df.select(arrays.normalize_pixels("x"), arrays.normalize_pixels("x", wide=True)).first()
    assert np.allclose(a, b)


def test_kernels_keep_nulls_and_lengths(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, []), (3, [5.0])]
    df = spark.createDataFrame(rows, "id int, x array<double>").coalesce(1)
    out = {r["id"]: r["y"] for r in df.withColumn("y", arrays.normalize_latent("x", 1.0, 2.0, wide=True)).collect()}
    assert out == {0: [0.0, 2.0], 1: None, 2: [], 3: [8.0]}
    mse = df.withColumn("m", arrays.mean_squared_error("x", F.transform("x", lambda v: v + 2), wide=True))
    assert {r["id"]: r["m"] for r in mse.collect()} == {0: 4.0, 1: None, 2: None, 3: 4.0}


@pytest.mark.parametrize("wide_rows", [True, False])
@pytest.mark.parametrize("shape", [(4, 4, 4, 2), (3, 6, 4, 2), (2, 6, 6, 3), (1, 2, 2, 1)])
def test_patch_round_trip_and_order(spark, wide_rows, shape):
    c, h, w, p = shape
    df = wide(spark, c * h * w)
    patches = lat.patchify(df, c, h, w, p, wide=wide_rows)
    back = grid(lat.unpatchify(patches.repartition(5), c, h, w, p, wide=wide_rows))
    for key, x in grid(df).items():
        assert np.array_equal(back[key], x)
        image = x.reshape(c, h, w)
        for r in patches.where(F.col("id") == key).collect():
            top, left = (r["patch"] // (w // p)) * p, (r["patch"] % (w // p)) * p
            block = image[:, top : top + p, left : left + p]
            assert np.allclose(r["token"], block.transpose(1, 2, 0).reshape(-1))


def test_patch_must_divide(spark):
    with pytest.raises(ValueError):
        lat.patchify(wide(spark, 9), 1, 3, 3, 2)


def test_bf16_ties_go_to_even(spark):
    values = [1.0, 1.00390625, 1.01171875, -1.00390625, 0.0, 1e-40, float("inf"), float("nan"), 3.3895313892515355e38]
    df = spark.createDataFrame([(values,)], "x array<float>")
    got = df.select(arrays.round_bf16("x").alias("x")).first()["x"]
    assert got[:5] == [1.0, 1.0, 1.015625, -1.0, 0.0]
    assert got[6] == float("inf") and np.isnan(got[7])
    bits = np.array(got, np.float32).view(np.uint32)
    assert np.all((bits & 0xFFFF) == 0)


def test_timestep_features_golden(spark):
    df = spark.range(1).select(F.lit(0.0).alias("t"))
    assert df.select(arrays.timestep_features("t", 5)).first()[0] == [1.0, 1.0, 0.0, 0.0, 0.0]
    f = spark.range(1).select(arrays.timestep_features(F.lit(2.0), 8)).first()[0]
    freqs = np.exp(-np.log(10000) * np.arange(4) / 4)
    assert np.allclose(f, np.concatenate([np.cos(2 * freqs), np.sin(2 * freqs)]))


def test_sample_latent(spark):
    df = wide(spark, 2000, rows=4)
    for source in ("md5", "philox"):
        rows = grid(lat.sample_latent(df, "x", 0.5, 3, source=source), "latent")
        for key, x in grid(df).items():
            assert abs((rows[key] - x).std() - 0.5) < 0.05
    spread = df.withColumn("s", F.transform("x", lambda v: F.lit(0.0)))
    assert np.allclose(grid(lat.sample_latent(spread, "x", "s", 3), "latent")[1], grid(df)[1])


def test_checked_width(spark):
    assert checked_width(wide(spark, 8), "x", 8).count() == 3
    with pytest.raises(Exception, match="expected 9 values, got 8"):
        checked_width(wide(spark, 8), "x", 9).collect()
