"""Shards that roll over by rows or by bytes, whichever comes first."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairloom.runtime import lookup_join, materialize, ship_by_value

# Rows whose jumps one task computes, at least; it reads ``maxcount`` rows more.
BLOCK_ROWS = 200_000


def with_running_sum(rows: DataFrame, weight: str, block: int, out: str = "_before") -> DataFrame:
    """``out``: the sum of ``weight`` over all rows with a smaller ``idx``; sums of blocks of rows first."""
    cut = rows.withColumn("_block", F.floor(F.col("idx") / block).cast("bigint"))
    sums = cut.groupBy("_block").agg(F.sum(weight).alias("_sum"))
    # One row per block passes this window.
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("_block", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("_block").orderBy("idx").rowsBetween(Window.unboundedPreceding, -1)
    local = F.coalesce(F.sum(weight).over(inside), F.lit(0))
    return cut.withColumn("_local", local).join(bases, "_block").withColumn(out, F.col("_base") + F.col("_local")).drop("_base", "_local")


def _jumps(rows: dict[str, np.ndarray], maxcount: int, maxbytes: int) -> np.ndarray:
    """For each row, as the first of a shard, the row that begins the next one.

    ``_before`` are running sums. A shard is full once it has ``maxcount`` rows or ``maxbytes``, so
    the row that passes the limit is still in it.
    """
    before = rows["_before"]
    full = np.searchsorted(before + rows["w"], before + maxbytes, "left") + 1
    return rows["idx"][0] + np.minimum(np.arange(len(before)) + maxcount, full)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """Columns of each run of equal ``at`` in a sorted partition."""
    held: list[pa.RecordBatch] = []

    def whole() -> dict[str, np.ndarray]:
        table = pa.Table.from_batches(held)
        return {c: table.column(c).to_numpy() for c in table.column_names}

    for batch in batches:
        at = batch.column("at").to_numpy()
        ends = np.r_[np.flatnonzero(np.diff(at)) + 1, len(at)]
        start = 0
        for end in ends.tolist():
            if end == start:
                continue
            if held and held[-1].column("at")[0].as_py() != at[start]:
                yield whole()
                held = []
            held.append(batch.slice(start, end - start))
            start = end
    if held:
        yield whole()


def roll_shards(
    rows: DataFrame, maxcount: int, maxbytes: int, *, weight: str = "bytes", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``shard`` for rows with a consecutive ``idx``: a new shard begins where the one before is full.

    Where a shard begins depends on all shards before it. Each block of rows tells, for any row
    of it at which a shard may begin, at which row of a later block one then begins next; two
    neighbouring tables compose to one of their pair, pairs to fours, and so on. From row 0 the
    tables are then read downwards, which gives every block its first beginning. No task sees more than
    a block and ``maxcount`` rows, and the tables are narrow. Rows of 0 bytes count as rows.
    """
    if maxcount < 1 or maxbytes < 1:
        raise ValueError("maxcount and maxbytes must be at least 1")
    block = max(block_rows, maxcount)
    narrow = rows.select("idx", F.coalesce(F.col(weight).cast("bigint"), F.lit(0)).alias("w"))
    summed = materialize(with_running_sum(narrow, "w", block), "running-sums")
    n_blocks = summed.agg(F.max("_block")).first()[0]
    if n_blocks is None:
        return rows.withColumn("shard", F.lit(0).cast("int"))
    n_blocks += 1
    # A block's last shards end among the first rows of the next one.
    ahead = (F.col("_block") > 0) & (F.col("idx") % block <= maxcount)
    seen = summed.select("*", F.explode(F.when(ahead, F.array(F.col("_block") - 1, F.col("_block"))).otherwise(F.array("_block"))).alias("at"))

    def leave(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _blocks(batches):
            idx, jump = rows["idx"], _jumps(rows, maxcount, maxbytes)
            own = min(block, len(idx))
            out = jump[:own].copy()
            while len(inner := np.flatnonzero(out < idx[0] + own)):
                out[inner] = jump[out[inner] - idx[0]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows["at"][:own]), pa.array(idx[:own]), pa.array(out)], ["node", "enter", "leave"]
            )

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _blocks(batches):
            idx, jump = rows["idx"], _jumps(rows, maxcount, maxbytes)
            own, starts, place = min(block, len(idx)), [], int(rows["enter"][0])
            while place < idx[0] + own:
                starts.append(place)
                place = int(jump[place - idx[0]])
            local = np.searchsorted(np.array(starts, np.int64), idx[:own], "right")
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows["at"][:own]), pa.array(idx[:own]), pa.array(local)], ["_block", "idx", "_nth"]
            )

    def in_blocks(df: DataFrame) -> DataFrame:
        return df.repartition("at").sortWithinPartitions("at", "idx")

    jumps = in_blocks(seen).mapInArrow(leave, "node bigint, enter bigint, leave bigint")
    tables, width = [materialize(jumps, "jumps")], n_blocks
    while width > 1:
        now = tables[-1]
        left = now.where(F.col("node") % 2 == 0).select(F.col("node").alias("l"), "enter", F.col("leave").alias("mid"))
        right = now.where(F.col("node") % 2 == 1).select(F.col("enter").alias("mid"), "leave")
        pairs = left.join(right, "mid", "left").select(
            F.floor(F.col("l") / 2).cast("bigint").alias("node"), "enter", F.coalesce("leave", "mid").alias("leave")
        )
        tables.append(materialize(pairs, "jumps"))
        width = -(-width // 2)

    # The one entry of the whole, then those of its halves, down to the blocks.
    zero = F.lit(0).cast("bigint")
    entries = rows.sparkSession.range(1).select(zero.alias("node"), zero.alias("enter"))
    for table in reversed(tables[:-1]):
        halves = entries.select((F.col("node") * 2).alias("node"), "enter")
        passed = halves.join(table, ["node", "enter"], "left").select(
            (F.col("node") + 1).alias("node"), F.coalesce("leave", "enter").alias("enter")
        )
        entries = materialize(halves.unionByName(passed), "entries")

    known = lookup_join(
        seen, entries.withColumnRenamed("node", "at"), ["at"], size=n_blocks * 64, salt_by=["idx"], how="inner"
    )
    placed = materialize(in_blocks(known).mapInArrow(begin, "_block bigint, idx bigint, _nth bigint"), "placed")
    counts = placed.groupBy("_block").agg(F.max("_nth").alias("_count"))
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("_block", F.coalesce(F.sum("_count").over(earlier), F.lit(0)).alias("_base"))
    numbered = placed.join(bases, "_block").select("idx", (F.col("_base") + F.col("_nth") - 1).cast("int").alias("shard"))
    return rows.join(numbered, "idx")


ship_by_value(__name__)
