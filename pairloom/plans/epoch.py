"""One training epoch as a plan table over keys, then one join with the payload."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.operators.epochs import bounded_shuffle, epoch_limit, fill_epoch, with_batches
from pairloom.operators.index import with_index


def plan_epoch(
    samples: DataFrame, *, epoch: int, seed: int, b: int, max_items: int, resampled: bool = False,
    buf: int | None = 1024, key: str = "id", shard: str = "shard",
) -> DataFrame:
    """(batch_id, pos, key) of one epoch of ``max_items // b`` batches.

    ``resampled`` draws shards with replacement until these batches are full, exactly. Else the
    epoch is one pass, which may end before. The same arguments give the same plan, so any epoch
    can be repeated or audited.
    """
    if resampled:
        numbered = fill_epoch(samples, max_items // b * b, seed, epoch, shard=shard, key=key)
    else:
        drawn = samples.select(key, F.col(shard).cast("bigint").alias("draw"))
        numbered = with_index(drawn, "draw", key)
    order = "idx"
    if buf is None or buf > 1:
        # A repeated sample is told apart by its draw.
        numbered = bounded_shuffle(numbered, buf, seed, epoch, key=("draw", key), out="_place")
        order = "_place"
    return epoch_limit(with_batches(numbered, b, index=order), max_items, b).select(
        "batch_id", "pos", key
    )


def attach_rows(plan: DataFrame, samples: DataFrame, key: str = "id") -> DataFrame:
    """Join the payload to a plan. AQE splits a sample drawn often enough to be skewed."""
    return plan.join(samples, key)
