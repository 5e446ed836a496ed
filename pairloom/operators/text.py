"""Captions: vocabulary, fixed-length ids, embedding lookup, pooling, encoders."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.functions import kernels
from pairloom.functions.arrays import doubles, zeros
from pairloom.operators import index
from pairloom.operators.index import with_index
from pairloom.runtime import (
    BROADCAST_BYTES,
    HOT_ROWS,
    lookup_join,
    materialize,
    measured_bytes,
    ship_by_value,
    skewed_join,
)

UNK = 0
# Rows and ids of a block of :func:`_pooled_by_blocks`, and its vectors that are added at once.
BLOCK_ROWS, BLOCK_IDS, BLOCK_VECTORS = 512, 200_000, 2048


def tokens(text: Column | str) -> Column:
    """Non-empty runs between spaces and newlines, case kept."""
    return F.filter(F.split(text, "[ \n]+"), lambda t: t != "")


def first_tokens(text: Column | str, n: int) -> Column:
    """Exactly ``tokens(text)[:n]``, without cutting up the rest of a long text.

    The last of n + 2 parts is that rest, and only the first part can be empty, so the n
    tokens are among the others.
    """
    parts = F.split(text, "[ \n]+", n + 2)
    return F.slice(F.filter(parts, lambda t: t != ""), 1, n)


def build_vocab(df: DataFrame, text_col: str, size: int) -> DataFrame:
    """(token, id, n): the ``size`` most frequent tokens, ids from 1; 0 is unknown and pad.

    Counts are combined before the shuffle, so a token in every caption costs one row per
    task. Only the top ``size`` rows are ever sorted together.
    """
    if size < 1:
        raise ValueError("size must be at least 1")
    counts = (
        df.select(F.explode(tokens(text_col)).alias("token"))
        .groupBy("token")
        .agg(F.count("*").alias("n"))
    )
    counts = counts.withColumn("_less", -F.col("n"))
    if size <= index.SINGLE_SORT_ROWS:
        ranked = with_index(counts.orderBy("_less", "token").limit(size), "_less", "token", rows=size)
    else:
        ranked = with_index(counts, "_less", "token").where(F.col("idx") < size)
    return ranked.select("token", (F.col("idx") + 1).cast("int").alias("id"), "n")


def encode_fixed_length(
    df: DataFrame, vocab: DataFrame, length: int = 128, *, key: str = "id", text_col: str = "caption",
    out: str = "ids", broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(key, ids): exactly ``length`` ids per row, cut or padded with the unknown id.

    ``key`` must be unique.

    The cut is the encoder's input length. Rows are placed by key before tokens are exploded, so tokens never move: the lookup is
    a broadcast for a vocabulary of checked size and a salted join beyond. Pass a stored
    vocabulary: one still to be built is built again for each use.
    """
    size = measured_bytes(vocab, "token")
    placed = df.select(key, first_tokens(text_col, length).alias("_tokens")).repartition(key)
    long = placed.select(key, F.posexplode_outer("_tokens").alias("_pos", "token"))
    found = lookup_join(
        long, vocab.select("token", F.col("id").cast("int").alias("_id")), ["token"],
        size=size, salt_by=[key, "_pos"], limit=broadcast_bytes,
    )
    entry = F.when(F.col("_pos").isNotNull(), F.struct("_pos", F.coalesce("_id", F.lit(UNK)).alias("_id")))
    ordered = F.array_sort(F.collect_list(entry))
    ids = F.transform(ordered, lambda e: e["_id"])
    padded = F.slice(F.concat(ids, F.array_repeat(F.lit(UNK), length)), 1, length)
    return found.groupBy(key).agg(padded.alias(out))


@dataclass
class SharedVocab:
    """A vocabulary made ready once for many uses: a broadcast variable if it is small enough."""

    table: DataFrame
    entries: object | None


def share_vocab(vocab: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> SharedVocab:
    """Measure a vocabulary and, within ``broadcast_bytes``, send it to the tasks."""
    if measured_bytes(vocab, "token") > broadcast_bytes:
        return SharedVocab(vocab, None)
    found = vocab.select("token", F.col("id").cast("int").alias("id")).toArrow().combine_chunks()
    entries = {"tokens": found["token"].combine_chunks(), "ids": found["id"].to_numpy()}
    return SharedVocab(vocab, vocab.sparkSession.sparkContext.broadcast(entries))


def encode_in_place(
    df: DataFrame, vocab: DataFrame | SharedVocab, length: int = 128, *, text_col: str = "caption",
    out: str = "ids", broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Like :func:`encode_fixed_length`, but keeps all columns and every row, whatever its key.

    A vocabulary of checked size travels to the tasks as a broadcast variable, and no row
    moves. For a larger one the rows are stored with a number of their own, by which the ids
    are joined back.
    """
    shared = vocab if isinstance(vocab, SharedVocab) else share_vocab(vocab, broadcast_bytes)
    if shared.entries is None:
        tagged = materialize(df.withColumn("_row", F.monotonically_increasing_id()), "captions")
        ids = encode_fixed_length(
            tagged, shared.table, length, key="_row", text_col=text_col, out=out, broadcast_bytes=broadcast_bytes,
        )
        return tagged.join(ids, "_row").select(*df.columns, out)
    cut = first_tokens(text_col, length)
    return df.withColumn(out, kernels.fixed_length_ids(cut, shared.entries, length, UNK))


def encode_whole(
    df: DataFrame, vocab: DataFrame | SharedVocab, *, text_col: str = "caption", out: str = "ids",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """All columns and the ids of every token of a text, uncut and without padding; none for a null text.

    Works as :func:`encode_in_place` does. Beyond a vocabulary that can be broadcast, the distinct
    tokens of blocks of rows are joined; a block, or a longer text, is the largest group.
    """
    shared = vocab if isinstance(vocab, SharedVocab) else share_vocab(vocab, broadcast_bytes)
    cut = F.coalesce(tokens(text_col), F.array().cast("array<string>"))
    if shared.entries is not None:
        return df.withColumn(out, kernels.token_ids(cut, shared.entries, UNK))
    return _ids_by_blocks(df, cut, shared.table, out)


def _ids_by_blocks(df: DataFrame, cut: Column, vocab: DataFrame, out: str) -> DataFrame:
    """All columns and the ids of the tokens ``cut`` by a join: a token moves once for each block of rows that has it.

    Rows are stored with their block and the places of their tokens in the block's list of distinct
    tokens. The list is joined and what is known of it comes back as one row per block, so that neither texts
    nor positions of tokens are joined, and a token has one row per block at most. Of a token that the vocabulary repeats all ids count.
    """
    stored = materialize(df.withColumn("_coded", kernels.coded_blocks(cut)), "captions")
    words = stored.select(F.col("_coded.block").alias("_block"), F.posexplode("_coded.words").alias("_at", "token"))
    known = vocab.groupBy("token").agg(F.sort_array(F.collect_list(F.coalesce(F.col("id").cast("int"), F.lit(UNK)))).alias("_ids"))
    listed = words.join(known, "token").groupBy("_block").agg(F.collect_list(F.struct("_at", "_ids")).alias("_known"))
    repeats = F.exists("_known", lambda e: F.size(e["_ids"]) > 1)
    blocks = listed.select(
        "_block",
        kernels.places("_known._at").alias("_place"),
        F.when(~repeats, F.transform("_known", lambda e: e["_ids"][0])).alias("_one"),
        F.when(repeats, F.col("_known._ids")).alias("_many"),
    )
    codes, rest = F.col("_coded.codes"), F.lit(UNK)
    ids = F.when(
        F.col("_many").isNull(), F.transform(codes, lambda c: F.coalesce(F.get("_one", F.get("_place", c)), rest))
    ).otherwise(F.flatten(F.transform(codes, lambda c: F.coalesce(F.get("_many", F.get("_place", c)), F.array(rest)))))
    joined = stored.join(blocks, F.col("_coded.block") == F.col("_block"), "left")
    return joined.select(*df.columns, ids.alias(out))


def expand_prompts(df: DataFrame, n: int) -> DataFrame:
    """``n`` consecutive copies of each row, numbered by ``copy``."""
    if n < 1:
        raise ValueError("n must be at least 1")
    return df.select("*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("copy"))


def named_rows(
    df: DataFrame, table: DataFrame, rows: int, *, ids: str, table_id: str, vec: str
) -> tuple[DataFrame, int]:
    """(table_id, vec) of a table of ``rows`` rows that some id of ``df`` names, stored, and how many rows are named.

    Ids repeat far more often than there are vectors, and are combined before they move.
    """
    at = F.pmod(F.col("_id").cast("bigint"), F.lit(rows)).alias("_row")
    named = materialize(df.select(F.explode(ids).alias("_id")).select(at).where("_row IS NOT NULL").distinct(), "named")
    n = named.count()
    vectors = table.select(table_id, vec, F.col(table_id).cast("bigint").alias("_row"))
    found = lookup_join(vectors, named, ["_row"], size=32 * n, salt_by=["_row"], how="left_semi")
    return materialize(found.drop("_row"), "vectors"), n


def lookup_embeddings(
    df: DataFrame, table: DataFrame, *, key: str = "id", ids: str = "ids",
    table_id: str = "token_id", vec: str = "vec", broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(key, pos, token_id, vec): one vector per position, ids taken modulo the table size.

    Of a table too large to broadcast only the vectors that some id names take part; if these are
    too large as well, ids are joined with salts, as padding alone can be most of the positions.
    The table's ids must be 0..rows-1.
    """
    rows, size = table.count(), measured_bytes(table, vec)
    if 0 < broadcast_bytes < size:
        table, _ = named_rows(df, table, rows, ids=ids, table_id=table_id, vec=vec)
        size = measured_bytes(table, vec)
    long = df.select(key, F.posexplode(ids).alias("pos", "token_id")).withColumn(
        "_row", F.pmod(F.col("token_id").cast("bigint"), F.lit(rows))
    )
    vectors = table.select(F.col(table_id).cast("bigint").alias("_row"), F.col(vec).alias("vec"))
    found = lookup_join(
        long, vectors, ["_row"], size=size, salt_by=[key, "pos"], how="inner", limit=broadcast_bytes,
    )
    return found.select(key, "pos", "token_id", "vec")


def mean_pool(
    df: DataFrame, key: str = "id", vec: str = "vec", *, dim: int, mask_padding: bool = False,
    token: str = "token_id", out: str = "pooled",
) -> DataFrame:
    """Mean vector per key over its positions, padding included unless masked.

    Sums are partial before the shuffle, so a key with very many positions moves one row
    per task. Vector sums took half the time of one average per dimension.
    """
    used = F.col(token) != UNK if mask_padding else F.lit(True)
    vectors = df.select(
        key, used.alias("_used"),
        array_to_vector(F.when(used, doubles(vec)).otherwise(zeros(dim))).alias("_v"),
    )
    totals = vectors.groupBy(key).agg(
        vector_to_array(Summarizer.sum(F.col("_v"))).alias("_sum"),
        F.count_if("_used").alias("_n"),
    )
    # A masked caption of padding only keeps its row, as zeros.
    return totals.select(
        key, F.transform("_sum", lambda v: v / F.greatest(F.col("_n"), F.lit(1))).alias(out)
    )


def pool_embeddings(
    df: DataFrame, table: DataFrame, *, key: str = "id", ids: str = "ids", table_id: str = "token_id",
    vec: str = "vec", dim: int, mask_padding: bool = False, out: str = "pooled",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(key, pooled): the mean vector of each row's ids.

    A table of checked size travels to the tasks, which gather and average in place: nothing is
    exploded and no row moves. Of a larger one the vectors that some id names travel so. If these
    are too large as well, vectors are joined with blocks of rows, see :func:`_pooled_by_blocks`,
    and averaged by ``key``, which must then be unique. The table's ids must be 0..rows-1.
    """
    pad = UNK if mask_padding else None
    rows, whole = table.count(), table
    if measured_bytes(table, vec) > broadcast_bytes:
        if broadcast_bytes:
            table, n = named_rows(df, table, rows, ids=ids, table_id=table_id, vec=vec)
        if not broadcast_bytes or table.count() != n or measured_bytes(table, vec) > broadcast_bytes:
            return _pooled_by_blocks(
                df, whole, rows, key=key, ids=ids, table_id=table_id, vec=vec, dim=dim, pad=pad, out=out
            )
    held = table.select(F.col(table_id).alias("at"), F.col(vec).alias("vec")).toArrow()
    at = held["at"].to_numpy()
    order = np.argsort(at)
    matrix = np.stack(held["vec"].to_pandas().to_numpy())[order]
    # Without a place of its own a vector stands at its id.
    places = None if table is whole else at[order].astype(np.int64)
    shared = df.sparkSession.sparkContext.broadcast((matrix, places, rows))
    return df.select(key, kernels.pooled_rows(ids, shared, pad).alias(out))


def _pooled_by_blocks(
    df: DataFrame, table: DataFrame, rows: int, *, key: str, ids: str, table_id: str, vec: str, dim: int,
    pad: int | None, out: str,
) -> DataFrame:
    """Mean vectors by a join: a vector moves once for each block of rows that names it.

    Blocks are neighbouring rows of a task, ``BLOCK_ROWS`` at most, and end at ``BLOCK_IDS`` ids; a row is the
    smallest block. Positions without a vector do not count, nor do rows without any.
    """
    kind = df.schema[key].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(lengths)
            values, start = lists.flatten(), 0
            while start < len(lengths):
                before = ends[start] - lengths[start]
                stop = min(start + BLOCK_ROWS, max(start + 1, int(np.searchsorted(ends, before + BLOCK_IDS, "right"))))
                own = values.slice(before, ends[stop - 1] - before)
                row = np.repeat(np.arange(stop - start), lengths[start:stop])
                given = own.is_valid().to_numpy(zero_copy_only=False)
                own = own.drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
                names, at = np.unique(own, return_inverse=True)
                pairs, n = np.unique(at * BLOCK_ROWS + row[given], return_counts=True)
                offsets = np.searchsorted(pairs, np.arange(len(names) + 1) * BLOCK_ROWS).astype(np.int32)
                block, size = uuid.uuid4().bytes, len(names) + 1
                keys = batch.column("key").slice(start, stop - start)
                none = pa.array([0], pa.int32())
                columns = [
                    pa.array([block] * size, pa.binary()),
                    pa.concat_arrays([pa.array(names, pa.int64()), pa.nulls(1, pa.int64())]),
                    pa.ListArray.from_arrays(pa.array(np.r_[offsets, offsets[-1]]), pa.array((pairs % BLOCK_ROWS).astype(np.int32))),
                    pa.ListArray.from_arrays(pa.array(np.r_[offsets, offsets[-1]]), pa.array(n.astype(np.int32))),
                    pa.concat_arrays([
                        pa.ListArray.from_arrays(pa.array(np.zeros(size, np.int32)), keys.slice(0, 0)),
                        pa.ListArray.from_arrays(pa.concat_arrays([none, pa.array([len(keys)], pa.int32())]), keys),
                    ]),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["block", "id", "rows", "n", "keys"])
                start = stop

    schema = f"block binary, id bigint, rows array<int>, n array<int>, keys array<{kind}>"
    cuts = df.select(F.col(key).alias("key"), F.col(ids).alias("ids")).mapInArrow(cut, schema)
    blocks = materialize(cuts.withColumn("_row", F.pmod("id", F.lit(rows))), "blocks")
    vectors = table.select(F.col(table_id).cast("bigint").alias("_row"), doubles(vec).alias("vec"), F.lit(True).alias("found"))
    joined = skewed_join(blocks, vectors, "_row", salt_by=["block"]).drop("_row")

    def add(group: pa.Table) -> pa.Table:
        last = group.filter(pc.is_null(group["id"]))
        keys = last["keys"].combine_chunks().flatten()
        named = group.filter(pc.fill_null(group["found"], False))
        if named["vec"].null_count:
            raise ValueError("an id names no vector")
        total, used, seen = np.zeros((len(keys), dim)), np.zeros(len(keys)), np.zeros(len(keys))
        for part in range(0, named.num_rows, BLOCK_VECTORS):
            some = named.slice(part, BLOCK_VECTORS).combine_chunks()
            at = some["rows"].combine_chunks()
            count = np.zeros((len(keys), len(at)))
            place = np.repeat(np.arange(len(at)), pc.list_value_length(at).to_numpy())
            count[at.flatten().to_numpy(), place] = some["n"].combine_chunks().flatten().to_numpy()
            seen += count.sum(axis=1)
            if pad is not None:
                count[:, some["id"].to_numpy() == pad] = 0.0
            used += count.sum(axis=1)
            total += count @ some["vec"].combine_chunks().flatten().to_numpy().reshape(-1, dim)
        kept = pa.array(seen > 0)
        sums = pa.FixedSizeListArray.from_arrays(pa.array(total.reshape(-1)), dim).cast(pa.list_(pa.float64()))
        result = pa.table({"key": keys, "_sum": sums, "_n": pa.array(used.astype(np.int64))})
        return result.filter(kept)

    sums = joined.groupBy("block").applyInArrow(add, f"key {kind}, _sum array<double>, _n bigint")
    vectors = sums.select(F.col("key").alias(key), array_to_vector("_sum").alias("_v"), "_n")
    totals = vectors.groupBy(key).agg(vector_to_array(Summarizer.sum(F.col("_v"))).alias("_sum"), F.sum("_n").alias("_n"))
    return totals.select(key, F.transform("_sum", lambda v: v / F.greatest(F.col("_n"), F.lit(1))).alias(out))


def encode_batches(
    df: DataFrame, encoder: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]],
    schema: T.StructType | str, batch_size: int = 64, name: str | None = None,
) -> DataFrame:
    """Run a pluggable encoder over a table in batches of a fixed size.

    ``encoder()`` loads the model and returns a function from a pandas batch to a pandas
    batch. It is called once per Python worker when ``name`` identifies it, else once per
    task. Filter and project before this call: nothing is pushed below it.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        loaded = sys.modules.setdefault("_pairloom_encoders", types.ModuleType("_pairloom_encoders"))
        encode = loaded.__dict__.get(name) if name else None
        if encode is None:
            encode = encoder()
            if name:
                loaded.__dict__[name] = encode
        held: list[pd.DataFrame] = []
        waiting = 0
        for frame in frames:
            held.append(frame)
            waiting += len(frame)
            if waiting < batch_size:
                continue
            rows = pd.concat(held, ignore_index=True)
            full = waiting - waiting % batch_size
            for start in range(0, full, batch_size):
                yield encode(rows.iloc[start : start + batch_size].reset_index(drop=True))
            held, waiting = [rows.iloc[full:]], waiting - full
        if waiting:
            yield encode(pd.concat(held, ignore_index=True))

    return df.mapInPandas(run, schema)


def fill_condition(
    df: DataFrame, cond: DataFrame, mode: str, *, key: str = "id", vec: str = "vec",
    width: int | None = None, empty: DataFrame | None = None, out: str = "cond",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Attach each row's condition; where it is absent use the unconditional input.

    ``mode="zero"`` fills ``width`` zeros, as in training. ``mode="empty_prompt"`` fills the
    single vector of ``empty``, the encoding of "", as in sampling. ``cond`` has each key
    once; one that very many rows of ``df`` share is split over tasks.
    """
    if mode == "zero":
        if width is None:
            raise ValueError("mode 'zero' needs width")
        default = zeros(width)
    elif mode == "empty_prompt":
        if empty is None:
            raise ValueError("mode 'empty_prompt' needs the encoding of the empty prompt")
        default = empty.select(doubles(vec)).scalar()
    else:
        raise ValueError(f"unknown mode {mode!r}")
    given = cond.select(key, doubles(vec).alias("_given"))
    joined = skewed_join(df, given, key, hot_rows=hot_rows)
    return joined.withColumn(out, F.coalesce("_given", default)).withColumn(
        "is_conditional", F.col("_given").isNotNull()
    ).drop("_given")


ship_by_value(__name__)
