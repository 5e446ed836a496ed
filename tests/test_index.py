import pytest
from pyspark.sql import functions as F

from pairloom.operators.index import with_arrival_index, with_index
from tests.plans import physical


@pytest.mark.parametrize("partitions", [1, 4, 7])
def test_index_is_consecutive(spark, partitions):
    ids = spark.range(0, 1003, 1, partitions).select((F.col("id") * 37 % 1003).alias("k"))
    rows = with_index(ids, "k", partitions=partitions).collect()
    assert sorted((r["k"], r["idx"]) for r in rows) == [(i, i) for i in range(1003)]


def test_index_with_a_hot_value(spark):
    rows = spark.range(3000).select(F.when(F.col("id") < 2000, "hot").otherwise("x").alias("s"), "id")
    got = with_index(rows, "s", "id", partitions=8).orderBy("idx").collect()
    assert [r["idx"] for r in got] == list(range(3000))
    assert [(r["s"], r["id"]) for r in got] == sorted((r["s"], r["id"]) for r in got)


def test_only_counts_meet_in_one_task(spark):
    lines = physical(with_index(spark.range(100), "id")).splitlines()
    single = [i for i, line in enumerate(lines) if "SinglePartition" in line]
    assert len(single) == 1 and "HashAggregate" in lines[single[0] + 1]
    assert any("BroadcastHashJoin" in line for line in lines)


def test_arrival_index_follows_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 500, 1, 5).write.parquet(path)
    scan = spark.read.parquet(path)
    rows = with_arrival_index(scan).collect()
    assert sorted(r["idx"] for r in rows) == list(range(500))
    assert len({r["id"] - r["idx"] for r in rows}) == 1


def test_arrival_index_moves_no_row(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 500, 1, 5).write.parquet(path)
    plan = physical(with_arrival_index(spark.read.parquet(path)))
    assert "rangepartitioning" not in plan and "SortMergeJoin" not in plan


def test_arrival_index_with_many_files_salts_instead(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    spark.range(0, 500, 1, 5).write.parquet(path)
    from pairloom import runtime
    from pairloom.operators import index

    monkeypatch.setattr(
        index, "lookup_join", lambda *a, **k: runtime.lookup_join(*a, **{**k, "limit": 0})
    )
    rows = index.with_arrival_index(spark.read.parquet(path)).collect()
    assert sorted(r["idx"] for r in rows) == list(range(500))


def test_rows_without_a_key_spread(spark):
    from pairloom.runtime import skewed_join

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(4000).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("k"), "id")
        other = spark.range(100).select(F.col("id").alias("k"), F.lit(1).alias("v"))
        joined = skewed_join(df, other, "k", salt_by=["id"])
        at = joined.where(F.col("k").isNull()).select(F.spark_partition_id().alias("p")).distinct().count()
        assert joined.count() == 4000 and joined.where("v = 1").count() == 50
        assert at > 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
