import pytest
from pyspark.sql import functions as F

from pairloom.operators.buffer import buffered_shuffle, loader_order, picks


def plain(rows, seed, epoch, stream, buf, initial):
    """The buffer as a loop over a list."""
    draws, held, out, at = picks(seed, epoch, stream), [], [], 0
    while at < len(rows) or held:
        took = 0
        while at < len(rows) and took < 2 and (took == 0 or len(held) < buf):
            held.append(rows[at])
            at, took = at + 1, took + 1
        if took and len(held) < min(initial, buf):
            continue
        i = int(next(draws) * len(held))
        held[i], held[-1] = held[-1], held[i]
        out.append(held.pop())
    return out


@pytest.mark.parametrize("buf, initial", [(1, 1), (2, 5), (30, 10), (500, 100)])
@pytest.mark.parametrize("partitions", [1, 5])
def test_buffer_equals_a_loop(spark, buf, initial, partitions):
    df = spark.range(0, 400, 1, partitions).select("id", (F.col("id") % 3).alias("worker"), (-F.col("id")).alias("turn"))
    got = buffered_shuffle(df, buf, 5, 2, stream=("worker",), order=("turn",), initial=initial).collect()
    for worker in range(3):
        own = sorted((i for i in range(400) if i % 3 == worker), reverse=True)
        seen = [r["id"] for r in sorted(got, key=lambda r: r["pos"]) if r["worker"] == worker]
        assert seen == plain(own, 5, 2, (worker,), buf, initial)


def test_loader_equals_a_loop(spark):
    rows = spark.range(500).select((F.col("id") / 20).cast("int").alias("draw"), "id")
    got = loader_order(rows, 2, 3, 8, 5, 2, worker_buffer=50, node_buffer=64, initial=10, max_items=100).collect()
    for node in range(2):
        batches = {}
        for worker in range(3):
            own = [i for i in range(500) if i // 20 % 2 == node and i // 20 // 2 % 3 == worker]
            read = plain(own, 5, 2, (node, worker), 50, 10)
            batches |= {(k // 8, worker): read[k : k + 8] for k in range(0, len(read), 8)}
        merged = plain([i for key in sorted(batches) for i in batches[key]], 5, 2, (node,), 64, 10)
        seen = {(r["batch_id"], r["pos"]): r["id"] for r in got if r["node"] == node}
        assert seen == {(k // 8, k % 8): i for k, i in enumerate(merged) if k // 8 < 100 // 8}


def test_bad_buffer(spark):
    with pytest.raises(ValueError):
        buffered_shuffle(spark.range(3), 0, 1, 1, stream=("id",), order=("id",))
