"""The loader's shuffle buffers: rows leave a bounded buffer at random, in every worker and again in every node."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.operators.epochs import assign_shards, epoch_limit, with_batches
from pairloom.runtime import ship_by_value

# Sizes of the workers' buffer and of the one behind them, and the fill at which rows begin to leave.
WORKER_BUFFER, NODE_BUFFER, INITIAL = 1000, 1024, 100
DRAWS = 4096


def picks(seed: int, epoch: int, stream: tuple) -> Iterator[float]:
    """Uniform draws that belong to one stream of one epoch."""
    name = "|".join(map(str, ("buffer", seed, epoch, *stream)))
    rng = np.random.Generator(np.random.Philox(key=zlib.crc32(name.encode())))
    while True:
        yield from rng.random(DRAWS).tolist()


def through_buffer(rows: Iterator, draws: Iterator[float], buf: int, initial: int) -> Iterator:
    """Rows as they leave a buffer that fills by two a step up to ``buf`` and gives one from ``initial`` on."""
    held: list = []

    def take():
        at = int(next(draws) * len(held))
        held[at], held[-1] = held[-1], held[at]
        return held.pop()

    rows = iter(rows)
    for row in rows:
        held.append(row)
        if len(held) < buf:
            held.extend(x for x in [next(rows, None)] if x is not None)
        if len(held) >= min(initial, buf):
            yield take()
    while held:
        yield take()


def buffered_shuffle(
    df: DataFrame, buf: int, seed: int, epoch: int, *, stream: tuple[str, ...], order: tuple[str, ...],
    initial: int = INITIAL, out: str = "pos",
) -> DataFrame:
    """``out``: the place of each row in its stream after a buffer of ``buf`` rows.

    A stream is what one loader worker reads, in ``order``, which must be unique in it; it passes
    through one task row by row, and the task holds a buffer and a batch. Pass key columns only.
    """
    if buf < 1:
        raise ValueError("buf must be at least 1")
    at = [df.columns.index(c) for c in stream]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None

        def rows() -> Iterator[tuple]:
            nonlocal schema
            for batch in batches:
                schema = batch.schema
                yield from zip(*(c.to_pylist() for c in batch.columns))

        def streams() -> Iterator[tuple]:
            pending = rows()
            row = next(pending, None)
            while row is not None:
                name = tuple(row[i] for i in at)

                def own(first=row, name=name):
                    nonlocal row
                    row = first
                    while row is not None and tuple(row[i] for i in at) == name:
                        yield row
                        row = next(pending, None)

                for place, one in enumerate(through_buffer(own(), picks(seed, epoch, name), buf, initial)):
                    yield *one, place

        done: list[tuple] = []

        def table() -> pa.RecordBatch:
            kinds = [*schema, pa.field(out, pa.int64())]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*done), kinds)], schema=pa.schema(kinds)
            )

        for row in streams():
            done.append(row)
            if len(done) == 10_000:
                yield table()
                done.clear()
        if done:
            yield table()

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + f", `{out}` bigint"
    placed = df.repartition(*stream).sortWithinPartitions(*stream, *order)
    return placed.mapInArrow(run, schema)


def loader_order(
    rows: DataFrame, world: int, workers: int, b: int, seed: int, epoch: int, *, max_items: int | None = None,
    order: tuple[str, ...] = ("draw", "id"), shard: str = "draw", worker_buffer: int = WORKER_BUFFER,
    node_buffer: int = NODE_BUFFER, initial: int = INITIAL,
) -> DataFrame:
    """(node, batch_id, pos, ...) as the nodes of a training run see key rows.

    Shards are dealt to nodes and workers. Each worker shuffles its rows in a buffer and cuts them into
    batches; a node takes a batch of each worker in turn, shuffles their rows in a second buffer
    and batches them again. ``max_items`` ends every node's epoch.
    """
    dealt = assign_shards(rows, world, workers, index=shard)
    read = buffered_shuffle(
        dealt, worker_buffer, seed, epoch, stream=("node", "worker"), order=order, initial=initial, out="_read"
    )
    turns = read.select(
        "*", F.floor(F.col("_read") / b).alias("_turn"), (F.col("_read") % b).alias("_inside")
    )
    merged = buffered_shuffle(
        turns, node_buffer, seed, epoch, stream=("node",), order=("_turn", "worker", "_inside"), initial=initial, out="_place"
    )
    batches = with_batches(merged, b, index="_place").drop("_read", "_turn", "_inside", "_place")
    return batches if max_items is None else epoch_limit(batches, max_items, b)


ship_by_value(__name__)
