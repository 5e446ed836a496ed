from collections import Counter

import pytest
from pyspark.sql import functions as F

from pairloom.operators import epochs
from pairloom.operators.index import with_index
from pairloom.plans.epoch import attach_rows, plan_epoch


def sharded(spark, n=200, size=20, partitions=4):
    return spark.range(0, n, 1, partitions).withColumn("shard", F.floor(F.col("id") / size).cast("int"))


def test_draws_repeat_whole_shards(spark):
    rows = epochs.resample_shards(sharded(spark), 30, 7, 0).collect()
    per_draw = Counter(r["draw"] for r in rows)
    assert set(per_draw) == set(range(30)) and set(per_draw.values()) == {20}
    assert len(rows) == 600


def test_draws_skip_missing_shards(spark):
    df = sharded(spark).where("shard not in (2, 3)")
    drawn = epochs.draw_shards(df, 100, 7, 0).collect()
    assert len(drawn) == 100 and not {2, 3} & {r["shard"] for r in drawn}
    assert len({r["shard"] for r in drawn}) == 8


def test_long_epoch_uses_the_salted_join(spark, monkeypatch):
    monkeypatch.setattr(epochs, "DRAW_BYTES", 1 << 30)
    salted = epochs.resample_shards(sharded(spark), 30, 7, 0).collect()
    monkeypatch.undo()
    assert sorted(salted) == sorted(epochs.resample_shards(sharded(spark), 30, 7, 0).collect())


def test_epochs_differ(spark):
    picks = {tuple(r["shard"] for r in epochs.draw_shards(sharded(spark), 20, 7, e).orderBy("draw").collect()) for e in range(3)}
    assert len(picks) == 3


@pytest.mark.parametrize("partitions", [1, 4, 7])
def test_bounded_shuffle(spark, partitions):
    rows = with_index(spark.range(0, 500, 1, partitions), "id")
    moved = epochs.bounded_shuffle(rows, 32, 3, 0).collect()
    assert sorted(r["pos"] for r in moved) == list(range(500))
    assert max(abs(r["pos"] - r["idx"]) for r in moved) < 32
    assert any(r["pos"] != r["idx"] for r in moved)


def test_batches_round_trip(spark):
    rows = epochs.with_batches(with_index(spark.range(130), "id"), 64)
    grouped = epochs.batched(rows, "id")
    assert {r["batch_id"]: len(r["rows"]) for r in grouped.collect()} == {0: 64, 1: 64, 2: 2}
    back = epochs.unbatched(grouped)
    assert sorted((r["batch_id"], r["pos"], r["id"]) for r in back.collect()) == sorted(
        (r["batch_id"], r["pos"], r["id"]) for r in rows.collect()
    )
    assert epochs.epoch_limit(rows, 70, 64).count() == 64


def test_dropout_direction(spark):
    u = spark.createDataFrame([(0.05,), (0.5,)], "u double")
    kept = {m: [r[0] for r in u.select(epochs.keep_caption(F.col("u"), 0.1, m)).collect()] for m in ("reference", "drop")}
    assert kept == {"reference": [True, False], "drop": [False, True]}
    with pytest.raises(ValueError):
        epochs.keep_caption(F.col("u"), 0.1, "other")


def test_dropout_rate(spark):
    df = spark.range(5000).withColumn("prompt_embeds", F.array(F.lit(1.0), F.lit(-2.0)))
    rows = epochs.caption_dropout(df, 0.1, "reference", 3).collect()
    assert 400 < sum(r["kept"] for r in rows) < 600
    assert all(r["prompt_embeds"] == ([1.0, -2.0] if r["kept"] else [0.0, 0.0]) for r in rows)


def test_assign_shards(spark):
    rows = epochs.assign_shards(spark.range(12).withColumnRenamed("id", "shard"), 3, 2).orderBy("shard").collect()
    assert [(r["node"], r["worker"]) for r in rows[:7]] == [(0, 0), (1, 0), (2, 0), (0, 1), (1, 1), (2, 1), (0, 0)]


def test_one_pass_epoch_sees_each_sample_once(spark):
    plan = plan_epoch(sharded(spark), epoch=0, seed=1, b=16, max_items=10_000)
    rows = plan.collect()
    assert sorted(r["id"] for r in rows) == list(range(200))
    assert sorted((r["batch_id"], r["pos"]) for r in rows) == [(i // 16, i % 16) for i in range(200)]
    assert attach_rows(plan, sharded(spark)).count() == 200


@pytest.mark.parametrize("seed, max_items", [(1, 100), (2, 431), (3, 16), (4, 1000)])
@pytest.mark.parametrize("buf", [None, 32])
def test_drawn_epoch_fills_its_batches(spark, seed, max_items, buf):
    df = sharded(spark).where("id not in (41, 42, 43, 199)")
    plan = plan_epoch(df, epoch=1, seed=seed, b=16, max_items=max_items, resampled=True, buf=buf)
    full = max_items // 16 * 16
    assert sorted((r["batch_id"], r["pos"]) for r in plan.collect()) == [(i // 16, i % 16) for i in range(full)]


def test_filled_epoch_follows_its_draws(spark, monkeypatch):
    monkeypatch.setattr(epochs, "DRAW_BLOCK", 3)
    df = sharded(spark).where("id % 7 <> 3")
    rows = {r["idx"]: (r["draw"], r["id"]) for r in epochs.fill_epoch(df, 500, 7, 2).collect()}
    drawn = {r["draw"]: r["shard"] for r in epochs.draw_shards(df, 60, 7, 2).collect()}
    sequence = [(d, i) for d in range(60) for i in range(20 * drawn[d], 20 * drawn[d] + 20) if i % 7 != 3]
    assert [rows[i] for i in range(500)] == sequence[:500] and len(rows) == 500
    with pytest.raises(ValueError):
        epochs.fill_epoch(df.where("id < 0"), 10, 7, 2)


def test_shards_are_placed(spark):
    rows = epochs.place_shards(sharded(spark), 3, 2).withColumn("task", F.spark_partition_id()).collect()
    assert all(r["task"] == 2 * r["node"] + r["worker"] for r in rows) and len(rows) == 200
    assert {r["shard"] for r in rows if r["task"] == 0} == {0, 6}
