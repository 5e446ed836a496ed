import math

import pytest
from pyspark.sql import functions as F

from pairloom.operators import metrics


def test_bins_include_empty_ones(spark):
    df = spark.createDataFrame([(0.05, 2.0), (0.09, 4.0), (1.0, 8.0)], "t double, loss double")
    rows = {r["bin"]: (r["loss"], r["n"]) for r in metrics.loss_by_bin(df).collect()}
    assert rows[0] == (3.0, 2) and rows[9] == (8.0, 1)
    assert all(rows[k] == (0.0, 0) for k in range(1, 9))


def test_run_events_golden(spark):
    steps = spark.range(5001).withColumnRenamed("id", "step")
    rows = metrics.with_run_events(steps, 100, 2500, 2500).collect()
    assert sorted(r["step"] for r in rows if r["is_log"]) == list(range(0, 5001, 100))
    assert sorted(r["step"] + 1 for r in rows if r["is_checkpoint"]) == [2500, 5000]
    assert sorted(r["step"] + 1 for r in rows if r["is_eval"]) == [1, 2501, 5001]
    assert [r["step"] + 1 for r in rows if r["is_final"]] == [5001]


def schedule(s, top):
    warm = top // 20
    if s < warm:
        return s / max(1, warm)
    return max(0.0, 0.5 * (1 + math.cos(math.pi * (s - warm) / max(1, top - warm))))


def test_learning_rate(spark):
    for top in (10, 200):
        steps = spark.range(top + 3).withColumnRenamed("id", "step")
        for r in metrics.with_learning_rate(steps, 2.0, top).collect():
            assert abs(r["lr"] - 2.0 * schedule(r["step"], top)) < 1e-12


def test_log_row_at_step_zero(spark):
    steps = spark.range(250).select(F.col("id").alias("step"), F.lit(0).alias("epoch"), F.lit(1.5).alias("loss"))
    rows = metrics.train_log(steps, 100, 64, base_lr=1.0, max_steps=200).orderBy("step").collect()
    assert [r["step"] for r in rows] == [0, 100, 200]
    assert rows[0]["datapoints"] == 0 and rows[0]["lr"] == schedule(1, 200)
    assert rows[1]["datapoints"] == 6400


def test_eval_reads_21_batches(spark):
    df = spark.range(31).select(F.col("id").alias("batch_id"), F.col("id").cast("double").alias("loss"))
    row = metrics.eval_summary(df, 21).first()
    assert row["loss"] == 10.0 and row["batches"] == 21
    assert metrics.eval_summary(df).first()["batches"] == 31


def test_bins_keep_every_row(spark):
    df = spark.createDataFrame([(1, -0.5, 2.0), (1, 0.05, 4.0), (1, 1.5, 3.0), (2, 0.95, 5.0)], "run int, t double, loss double")
    rows = {r["bin"]: (r["loss"], r["n"]) for r in metrics.loss_by_bin(df).collect()}
    assert rows[0] == (3.0, 2) and rows[9] == (4.0, 2) and sum(n for _, n in rows.values()) == 4
    by_run = {(r["run"], r["bin"]): (r["loss"], r["n"]) for r in metrics.loss_by_bin(df, by=("run",)).collect()}
    assert len(by_run) == 20 and by_run[1, 9] == (3.0, 1) and by_run[2, 9] == (5.0, 1) and by_run[2, 0] == (0.0, 0)
    with pytest.raises(Exception, match="no timestep"):
        metrics.loss_by_bin(df.withColumn("t", F.lit(None).cast("double"))).collect()
