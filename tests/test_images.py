import math

from pyspark.sql import functions as F

from pairloom.functions.arrays import denormalize_pixels, normalize_pixels
from pairloom.operators.images import plan_center_crop, plan_ingest_resize

SIZES = [(w, h) for w in (1, 3, 255, 256, 257, 300, 511, 512, 1023) for h in (2, 256, 257, 333, 512, 769)]


def frame(spark):
    return spark.createDataFrame(SIZES, "w int, h int")


def test_ingest_resize(spark):
    for r in plan_ingest_resize(frame(spark)).collect():
        short = min(r["w"], r["h"])
        if short > 256:
            scale = 256 / float(short)
            assert (r["out_w"], r["out_h"]) == (round(r["w"] * scale), round(r["h"] * scale))
        else:
            assert (r["out_w"], r["out_h"]) == (r["w"], r["h"])
        assert r["resized"] == r["reencode"] == (short > 256)


def test_other_formats_are_reencoded(spark):
    df = spark.createDataFrame([(10, 10, "JPG"), (10, 10, "png")], "w int, h int, f string")
    assert [r["reencode"] for r in plan_ingest_resize(df, format_col="f").collect()] == [False, True]


def test_center_crop(spark):
    for r in plan_center_crop(frame(spark)).collect():
        w, h = r["w"], r["h"]
        long = int(256 * max(w, h) / min(w, h))
        assert (r["resized_w"], r["resized_h"]) == ((256, long) if w <= h else (long, 256))
        assert r["crop_top"] == int(round((r["resized_h"] - 256) / 2.0))
        assert r["crop_left"] == int(round((r["resized_w"] - 256) / 2.0))


def test_pixels_come_back_within_one(spark):
    df = spark.range(1).select(F.sequence(F.lit(0), F.lit(255)).alias("px"))
    row = df.select(denormalize_pixels(normalize_pixels("px")).alias("px")).first()["px"]
    assert all(0 <= i - v <= 1 for i, v in enumerate(row))
    assert sum(i != v for i, v in enumerate(row)) == 20


def test_pixels_are_clipped(spark):
    df = spark.range(1).select(F.array(F.lit(-3.0), F.lit(3.0), F.lit(math.nan)).alias("px"))
    assert df.select(denormalize_pixels("px").alias("px")).first()["px"][:2] == [0, 255]
