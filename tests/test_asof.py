import random

import pytest

from pairloom.operators.asof import as_of
from pairloom.operators.metrics import eval_records, log_window, log_windows


@pytest.mark.parametrize("width", [0.5, 7.0, 1e9])
def test_last_fact_before(spark, width):
    rng = random.Random(3)
    facts = [(rng.randrange(3), rng.uniform(0, 50), i) for i in range(120)] + [(1, 20.0, 500), (1, 20.0, 501)]
    events = [(rng.randrange(4), rng.uniform(-5, 60), f"e{i}") for i in range(80)] + [(1, 20.0, "tie"), (None, 3.0, "null")]
    got = as_of(
        spark.createDataFrame(events, "run int, ts double, name string"),
        spark.createDataFrame(facts, "run int, ts double, step int"),
        ["run"], width=width, columns=["step"],
    ).collect()
    for r in got:
        before = [(t, s) for run, t, s in facts if run == r["run"] and t <= r["ts"]]
        assert r["step"] == (max(before)[1] if before else None)
    assert sorted(r["name"] for r in got) == sorted(e[2] for e in events)


def test_records_count_steps_done(spark):
    steps = spark.createDataFrame([(0, i, 0, i * 1.0) for i in range(10)], "run int, step long, epoch int, ts double")
    rows = [(0, 4.5, b, 0.05 + 0.5 * (b % 2), float(b)) for b in range(4) for _ in range(b + 1)] + [(0, -1.0, 0, 0.2, 7.0)]
    tests = spark.createDataFrame(rows, "run int, ts double, batch_id int, t double, loss double")
    got = {r["ts"]: r for r in eval_records(tests, steps, b=8, batches=3, width=2.0).collect()}
    assert (got[4.5]["step"], got[4.5]["datapoints"], got[4.5]["epoch"], got[4.5]["loss"]) == (5, 40, 0, 1.0)
    assert (got[4.5]["bin_0"], got[4.5]["bin_5"], got[4.5]["bin_9"]) == (1.5, 1.0, 0.0)
    assert (got[-1.0]["step"], got[-1.0]["epoch"], got[-1.0]["bin_2"]) == (0, None, 7.0)


def test_windows_end_with_their_log(spark):
    assert [r[0] for r in spark.range(7).select(log_window("id", 3)).collect()] == [0, 1, 1, 1, 2, 2, 2]
    rows = spark.createDataFrame([("a", i, 0.1, 1.0) for i in range(6)], "run string, step long, t double, loss double")
    assert {r["window"] for r in log_windows(rows, 3).collect()} == {0, 1, 2}
    assert {r["window"] for r in log_windows(rows, 3, whole=True).collect()} == {0, 1}
