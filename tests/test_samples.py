import pytest
from pyspark.sql import functions as F

from pairloom.operators import samples


def test_key_format(spark):
    rows = samples.with_sample_key(spark.range(130).withColumnRenamed("id", "idx")).orderBy("idx").collect()
    assert rows[0]["key"] == "000000_0"
    assert rows[63]["key"] == "000000_63"
    assert rows[129]["key"] == "000002_1"


def test_pick_first(spark):
    df = spark.createDataFrame([(1, "j", "p"), (2, None, "p"), (3, None, None)], "id int, jpg string, png string")
    assert [r["image"] for r in samples.pick_first(df, ["jpg", "png"], "image").orderBy("id").collect()] == ["j", "p", None]


def test_split_valid_keeps_every_row_once(spark):
    texts = ['{"caption": "a"}', '{"caption": 1', '{"x": 1}', None, "", '{"caption": "b"} tail', "[1]"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, json string")
    read = samples.extract_caption(df)
    rules = {"bad_json": samples.is_json("json"), "no_caption": F.col("caption").isNotNull()}
    good, rejected = samples.split_valid(read, rules)
    assert [r["id"] for r in good.collect()] == [0]
    reasons = {r["id"]: r["reason"] for r in rejected.collect()}
    assert reasons == {1: "bad_json", 2: "no_caption", 3: "bad_json", 4: "bad_json", 5: "bad_json", 6: "no_caption"}
    assert {r["reason"]: r["n"] for r in samples.reject_counts(rejected).collect()} == {"bad_json": 4, "no_caption": 2}


def test_null_rule_rejects(spark):
    good, rejected = samples.split_valid(spark.range(2), {"odd": F.lit(None).cast("boolean")})
    assert good.count() == 0 and rejected.count() == 2


def test_split_by_shard_refuses_overlap(spark):
    df = spark.range(10).withColumn("shard", F.col("id"))
    with pytest.raises(ValueError):
        samples.split_by_shard(df, (0, 5), (5, 6))
    train, test = samples.split_by_shard(df, (0, 5), (6, 9))
    assert train.count() == 6 and test.count() == 4


@pytest.mark.parametrize("text", ["{}", "[1, 2]", '"a"', "1.5", "null", ' {"a": {"b": []}} '])
def test_json(spark, text):
    assert spark.createDataFrame([(text,)], "j string").select(samples.is_json("j")).first()[0]


@pytest.mark.parametrize(
    "text", ["", " ", "{", "{} {}", "1, 2", "1] [2", '1} {"a":2', '1,"end":1} x', "{'a': 1}", "tail", None]
)
def test_not_json(spark, text):
    assert not spark.createDataFrame([(text,)], "j string").select(samples.is_json("j")).first()[0]
