"""Epoch plans: shard draws, shuffles, batches and caption dropout.

Run these on key columns and join the payload once at the end
(:mod:`pairloom.plans.epoch`): latents and embeddings are a thousand times wider.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.functions.arrays import doubles, zeros
from pairloom.functions.rand import shuffle_order, uniform
from pairloom.operators.index import with_index
from pairloom.runtime import lookup_join, materialize, measured_bytes

DRAW_BYTES = 32
# Draws whose sizes are summed in one task.
DRAW_BLOCK = 10_000


def draw_shards(df: DataFrame, n_draws: int, seed: int, epoch: int, *, shard: str = "shard") -> DataFrame:
    """(draw, shard): ``n_draws`` shards of ``df`` picked uniformly, with replacement."""
    if n_draws < 1:
        raise ValueError("n_draws must be at least 1")
    listed = df.select(shard).distinct()
    total = listed.count()
    numbered = with_index(listed, shard, out="_nth", rows=total)
    nth = F.floor(uniform(seed, "shard", epoch, "draw") * total).cast("bigint")
    draws = df_range(df, n_draws).withColumn("_nth", nth)
    return draws.join(numbered, "_nth").select("draw", shard)


def resample_shards(
    df: DataFrame, n_draws: int, seed: int, epoch: int, *, shard: str = "shard", key: str = "id"
) -> DataFrame:
    """All rows of every drawn shard; a shard drawn twice gives its rows twice.

    The table of draws is small by its own argument and is broadcast, so samples stay where
    they are; a very long epoch falls back to a join salted by row.
    """
    draws = draw_shards(df, n_draws, seed, epoch, shard=shard)
    return lookup_join(
        df, draws, [shard], size=n_draws * DRAW_BYTES, salt_by=[key], how="inner"
    )


def fill_draws(sizes: DataFrame, items: int, seed: int, epoch: int, *, shard: str = "shard") -> DataFrame:
    """(draw, shard, start, ...): shards picked uniformly, with replacement, until their rows reach ``items``.

    ``sizes`` holds (shard, n, ...) once per shard. ``start`` counts the rows of the draws before.
    Draws are made ahead from the mean size and doubled until they suffice; a draw depends on
    its number alone, so making more of them changes none. Running sums go over blocks of draws
    first, then over one row per block.
    """
    sizes = materialize(sizes.where(F.col("n") > 0), "sizes")
    total, rows = sizes.agg(F.count("*"), F.sum("n")).first()
    if not total:
        raise ValueError("there are no rows to draw from")
    numbered = materialize(with_index(sizes, shard, out="_nth", rows=total), "numbered")
    nth = F.floor(uniform(seed, "shard", epoch, "draw") * total).cast("bigint")
    ahead = -(-items * total * 5 // (rows * 4)) + 16
    while True:
        draws = df_range(sizes, ahead).withColumn("_nth", nth).join(numbered, "_nth").drop("_nth")
        if (draws.agg(F.sum("n")).first()[0] or 0) >= items:
            break
        ahead *= 2
    blocked = draws.withColumn("_block", F.floor(F.col("draw") / DRAW_BLOCK))
    sums = blocked.groupBy("_block").agg(F.sum("n").alias("_sum"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("_block", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("_block").orderBy("draw").rowsBetween(Window.unboundedPreceding, -1)
    placed = blocked.withColumn("_inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(bases, "_block")
    start = (F.col("_base") + F.col("_inside")).alias("start")
    return placed.select("draw", start, *sizes.columns).where(F.col("start") < items)


def df_range(like: DataFrame, n: int) -> DataFrame:
    return like.sparkSession.range(n).withColumnRenamed("id", "draw")


def fill_epoch(
    df: DataFrame, items: int, seed: int, epoch: int, *, shard: str = "shard", key: str = "id"
) -> DataFrame:
    """(draw, shard, key, idx): exactly ``items`` rows of drawn shards, ``idx`` from 0, the last draw cut short.

    Rows are numbered once, by one range sort of the keys; each draw adds its start to the place
    in the shard, so the epoch itself, however often shards repeat, is not sorted.
    """
    placed = with_index(df.select(shard, key), shard, key, out="_row")
    sizes = placed.groupBy(shard).agg(F.min("_row").alias("_first"), F.count("*").alias("n"))
    draws = materialize(fill_draws(sizes, items, seed, epoch, shard=shard), "draws")
    joined = lookup_join(
        placed, draws.drop("n"), [shard], size=measured_bytes(draws, fixed=2 * DRAW_BYTES), salt_by=[key], how="inner"
    )
    idx = F.col("start") + F.col("_row") - F.col("_first")
    return joined.withColumn("idx", idx).where(F.col("idx") < items).select("draw", shard, key, "idx")


def assign_shards(shards: DataFrame, world: int, workers: int, *, index: str = "shard") -> DataFrame:
    """Deal shards round-robin to nodes, then each node's shards to its workers."""
    i = F.col(index)
    return shards.select(
        "*",
        F.pmod(i, F.lit(world)).cast("int").alias("node"),
        F.pmod(F.floor(i / world), F.lit(workers)).cast("int").alias("worker"),
    )


def place_shards(df: DataFrame, world: int, workers: int, *, shard: str = "shard") -> DataFrame:
    """Rows with their shard's ``node`` and ``worker``, moved to partition ``node * workers + worker``.

    Placement is direct, not by hash: a task holds the shards of one worker and no others, and
    ``world * workers`` tasks hold them all.
    """
    dealt = assign_shards(df, world, workers, index=shard)
    return dealt.repartitionById(world * workers, F.col("node") * workers + F.col("worker"))


def bounded_shuffle(
    df: DataFrame, buf: int | None, seed: int, epoch: int, *, index: str = "idx",
    key: str | tuple[str, ...] = "id", out: str = "pos",
) -> DataFrame:
    """New position of each row: shuffled inside blocks of ``buf``, or fully for None.

    A row moves by less than ``buf`` places. Blocks are windows of at most ``buf`` rows.
    ``key`` identifies a row.
    """
    keys = (key,) if isinstance(key, str) else key
    order = df.withColumn("_h", shuffle_order(seed, "shuffle", epoch, *keys))
    if buf is None:
        return with_index(order, "_h", *keys, out=out).drop("_h")
    if buf < 1:
        raise ValueError("buf must be at least 1")
    block = F.floor(F.col(index) / buf).cast("bigint")
    inside = F.row_number().over(Window.partitionBy("_block").orderBy("_h", *keys))
    moved = order.withColumn("_block", block).withColumn(out, F.col("_block") * buf + inside - 1)
    return moved.drop("_h", "_block")


def with_batches(df: DataFrame, b: int, *, index: str = "idx") -> DataFrame:
    """``batch_id`` and ``pos`` from a consecutive index; the last batch may be short."""
    if b < 1:
        raise ValueError("b must be at least 1")
    i = F.col(index)
    return df.select(
        "*", F.floor(i / b).cast("bigint").alias("batch_id"), (i % b).cast("int").alias("pos")
    )


def batched(df: DataFrame, *columns: str) -> DataFrame:
    """One row per batch with its rows in order; a group holds one batch only."""
    row = F.struct("pos", *columns)
    return df.groupBy("batch_id").agg(F.array_sort(F.collect_list(row)).alias("rows"))


def unbatched(df: DataFrame) -> DataFrame:
    return df.select("batch_id", F.inline("rows"))


def epoch_limit(df: DataFrame, max_items: int, b: int) -> DataFrame:
    """Keep the first ``max_items // b`` batches: a filter, not a sort."""
    return df.where(F.col("batch_id") < max_items // b)


def keep_caption(u: Column, p: float, mode: str) -> Column:
    """``reference`` keeps iff ``u <= p``; ``drop`` zeroes iff ``u <= p``."""
    if mode == "reference":
        return u <= p
    if mode == "drop":
        return u > p
    raise ValueError(f"mode must be 'reference' or 'drop', not {mode!r}")


def caption_dropout(
    df: DataFrame, p: float, mode: str, seed: int, *, key: str = "id", epoch: int = 0,
    vec: str = "prompt_embeds",
) -> DataFrame:
    """Zero the text condition of random rows and flag the others ``kept``."""
    kept = df.withColumn("kept", keep_caption(uniform(seed, "dropout", epoch, key), p, mode))
    return kept.withColumn(vec, F.when(F.col("kept"), doubles(vec)).otherwise(zeros(F.size(vec))))
