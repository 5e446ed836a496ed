import random

import pytest

from pairloom.sources.rolling import roll_shards


def plain(weights, maxcount, maxbytes):
    out, shard, n, held = [], 0, 0, 0
    for w in weights:
        if n >= maxcount or held >= maxbytes:
            shard, n, held = shard + 1, 0, 0
        out.append(shard)
        n, held = n + 1, held + w
    return out


@pytest.mark.parametrize("rows, maxcount, maxbytes, block", [
    (0, 3, 10, 5), (1, 3, 10, 5), (7, 3, 1, 5), (500, 20, 900, 37), (500, 7, 1 << 40, 1), (500, 500, 120, 60), (64, 1, 1, 8),
])
def test_rolls_as_a_loop_does(spark, rows, maxcount, maxbytes, block):
    rng = random.Random(rows)
    weights = [rng.choice([0, 1, 5, 40, 300]) for _ in range(rows)]
    df = spark.createDataFrame([(i, w, "x") for i, w in enumerate(weights)], "idx long, bytes long, node string")
    got = roll_shards(df, maxcount, maxbytes, block_rows=block).collect()
    assert [r["shard"] for r in sorted(got)] == plain(weights, maxcount, maxbytes)


def test_limits_are_positive(spark):
    with pytest.raises(ValueError):
        roll_shards(spark.range(3).selectExpr("id AS idx", "id AS bytes"), 0, 10)
