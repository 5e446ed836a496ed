import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.operators import flow
from pairloom.operators.epochs import with_batches
from pairloom.plans.loss_profile import loss_profile
from tests.plans import physical


def trajectory(spark):
    noise = spark.createDataFrame([("a", [10.0])], "key string, z array<double>")
    velocity = spark.createDataFrame([("a", 1, [4.0]), ("a", 2, [2.0])], "key string, step int, v array<double>")
    return noise, velocity


@pytest.mark.parametrize("width", [128, 0])
def test_replay_golden(spark, width, monkeypatch):
    monkeypatch.setattr(flow, "PLAIN_WIDTH", width)
    states = flow.replay_states(*trajectory(spark), 2, dim=1).orderBy("step").collect()
    assert [r["z"] for r in states] == [[10.0], [8.0], [7.0]]
    seen = flow.replay_predictions(*trajectory(spark), 2, dim=1).orderBy("step").collect()
    assert [r["z"] for r in seen] == [[10.0], [6.0], [7.0]]


@pytest.mark.parametrize("width", [128, 0])
def test_replay_against_a_loop(spark, width, monkeypatch):
    monkeypatch.setattr(flow, "PLAIN_WIDTH", width)
    rng = np.random.default_rng(0)
    start, v = rng.normal(size=(5, 3)), rng.normal(size=(5, 20, 3))
    noise = spark.createDataFrame([(k, start[k].tolist()) for k in range(5)], "key int, z array<double>")
    rows = [(k, s + 1, v[k, s].tolist()) for k in range(5) for s in range(20)]
    velocity = spark.createDataFrame(rows, "key int, step int, v array<double>").repartition(7)
    states = {(r["key"], r["step"]): r["z"] for r in flow.replay_states(noise, velocity, 20, dim=3).collect()}
    seen = {(r["key"], r["step"]): r["z"] for r in flow.replay_predictions(noise, velocity, 20, dim=3).collect()}
    assert len(states) == len(seen) == 5 * 21
    for k in range(5):
        z = start[k]
        for s in range(20):
            left = 20 - s
            assert np.allclose(seen[k, s + 1], z - left * v[k, s] / 20)
            z = z - v[k, s] / 20
            assert np.allclose(states[k, s + 1], z)
        assert np.allclose(states[k, 20], seen[k, 20])


def batches(spark, n=150, partitions=4):
    return with_batches(spark.range(0, n, 1, partitions).withColumn("idx", F.col("id")), 64)


@pytest.mark.parametrize("b", [64, None])
def test_stratified_has_one_draw_per_stratum(spark, b):
    for r in flow.sample_timesteps(batches(spark), "stratified", 3, b).collect():
        size = 64 if r["batch_id"] < 2 else 22
        z = np.log(r["t"] / (1 - r["t"]))
        from statistics import NormalDist

        assert int(NormalDist().cdf(z) * size) == r["pos"]


def test_known_batch_size_needs_no_window(spark):
    plan = flow.sample_timesteps(batches(spark), "stratified", 3, 64)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


@pytest.mark.parametrize("mode", ["logit_normal", "uniform"])
def test_timesteps_do_not_depend_on_partitions(spark, mode):
    runs = [
        sorted((r["id"], r["t"]) for r in flow.sample_timesteps(batches(spark, 100, p), mode, 3).collect())
        for p in (1, 4, 7)
    ]
    assert runs[0] == runs[1] == runs[2]
    assert all(0 < t < 1 for _, t in runs[0])


@pytest.mark.parametrize("source", ["md5", "philox"])
def test_flow_rows(spark, source):
    df = spark.range(20).select("id", F.array(*[F.lit(float(i)) for i in range(9)]).alias("x"))
    for r in flow.make_flow_rows(flow.sample_timesteps(df), 5, source=source).collect():
        x, eps = np.array(r["x"]), np.array(r["eps"])
        assert np.allclose(r["z_t"], (1 - r["t"]) * x + r["t"] * eps)
        assert np.allclose(r["v"], eps - x)


@pytest.mark.parametrize("wide", [True, False])
def test_loss(spark, wide):
    rows = spark.createDataFrame([(1, 0, [1.0, 3.0]), (2, 0, [0.0, 0.0])], "id int, batch_id int, v array<double>")
    guess = spark.createDataFrame([(1, [0.0, 1.0]), (2, [1.0, 1.0])], "id int, v_hat array<double>")
    losses = flow.flow_loss(rows, guess, wide=wide)
    assert {r["id"]: r["loss"] for r in losses.collect()} == {1: 2.5, 2: 1.0}
    assert flow.batch_loss(losses).first()["loss"] == 1.75
    assert {r["id"]: r["loss"] for r in flow.flow_loss(rows, wide=wide).collect()} == {1: 5.0, 2: 0.0}


@pytest.mark.parametrize("wide", [True, False])
def test_guidance(spark, wide):
    cond = spark.createDataFrame([("a", 1, [2.0, 1.0]), ("a", 2, [3.0, 1.0])], "key string, step int, v array<double>")
    uncond = spark.createDataFrame([("a", 1, [1.0, 1.0])], "key string, step int, v array<double>")
    out = flow.guide(cond, uncond, 4.0, wide=wide).orderBy("step").collect()
    assert [r["v"] for r in out] == [[5.0, 1.0], [3.0, 1.0]]
    assert [r["v"] for r in flow.guide(cond).orderBy("step").collect()] == [[2.0, 1.0], [3.0, 1.0]]


def test_wide_profile_agrees_in_distribution(spark):
    df = spark.range(0, 4000, 1, 4).select("id", F.array(*[F.lit(0.5)] * 16).alias("x"))
    both = [
        {r["bin"]: r["loss"] for r in loss_profile(df, shift=0.1, scale=1.0, source=s).collect() if r["n"] > 100}
        for s in ("md5", "philox")
    ]
    for k in set(both[0]) & set(both[1]):
        assert abs(both[0][k] - both[1][k]) < 0.25


@pytest.mark.parametrize("wide", [True, False])
def test_missing_and_misfit_predictions_fail(spark, wide):
    rows = spark.createDataFrame([(1, 0, [1.0, 3.0]), (2, 0, [0.0, 0.0])], "id int, batch_id int, v array<double>")
    for guess in ([(1, [0.0, 1.0])], [(1, [0.0, 1.0]), (2, [1.0])]):
        table = spark.createDataFrame(guess, "id int, v_hat array<double>")
        with pytest.raises(Exception, match="sample 2"):
            flow.flow_loss(rows, table, wide=wide).collect()
    uneven = spark.createDataFrame([(1, 1, [2.0])], "key int, step int, v array<double>")
    other = spark.createDataFrame([(1, 1, [2.0, 3.0])], "key int, step int, v array<double>")
    with pytest.raises(Exception, match="differ in length"):
        flow.guide(other, uneven, wide=wide).collect()


@pytest.mark.parametrize("width", [0, 128])
def test_replay_refuses_other_widths_and_orphans(spark, width, monkeypatch):
    monkeypatch.setattr(flow, "PLAIN_WIDTH", width)
    noise, velocity = trajectory(spark)
    with pytest.raises(Exception, match="expected 2 values"):
        flow.replay_states(noise, velocity, 2, dim=2).collect()
    with pytest.raises(Exception, match="without a start"):
        flow.replay_states(noise.limit(0), velocity, 2, dim=1).collect()


@pytest.mark.parametrize("name", ["guide", "guide_wide", "decode_steps"])
def test_velocities_of_one_placement_do_not_move(spark, sf, name):
    from registry.queries import QUERIES

    plan = physical(QUERIES[name](spark, sf))
    moved = [line for line in plan.splitlines() if "Exchange" in line]
    assert moved and all("REPARTITION_BY_NUM" in line for line in moved)
