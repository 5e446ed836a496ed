"""Places that texts sharing a passage choose alike, and the documents that share one.

In every window of ``size`` words the k-word run with the smallest hash is the window's anchor
(its minimiser). Equal windows have equal anchors, wherever they stand, so only texts that share
an anchor can share a window, and about 2 / (size - k + 2) of the runs are anchors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.words import chunks, gram_hashes, hash_words, scrambled, sliding_argmin, utf8
from pairloom.runtime import materialize, ship_by_value, skewed_join

# Documents without an id come after all others.
LAST_ID = (1 << 63) - 1
COMBINE_BYTES = 6 << 20
NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)


def numbered(docs: DataFrame, *more) -> DataFrame:
    """(id, row, text, ...) with null ids as ``LAST_ID`` and null texts as empty.

    ``row`` tells texts of one id apart, so that what is gathered for a document is never more than
    one text's, however many rows share its id or have none.
    """
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST_ID)).alias("id"), F.xxhash64(text).alias("row"),
        text.alias("text"), *more,
    )


def real_id() -> Column:
    """``id`` as it was before ``numbered``."""
    return F.when(F.col("id") != LAST_ID, F.col("id")).alias("doc_id")


def exact_copies(source: DataFrame, *more: Column) -> tuple[DataFrame, DataFrame]:
    """``source`` plus ``twin``: another id with the same text (the smallest, or for that one the
    largest), null if there is none. Then the rows that have one: (id, row, twin, and ``more``).

    Only ids and SHA-256 digests are compared; a text that very many documents share is combined
    before the shuffle and its rows spread over tasks.
    """
    narrow = materialize(source.select("id", "row", F.sha2("text", 256).alias("digest"), *more), "digests")
    groups = narrow.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    groups = materialize(groups.where(F.col("first") < F.col("last")), "copied")
    found = skewed_join(narrow, groups, "digest", salt_by=["id", "row"]).where(F.col("first").isNotNull())
    twin = F.when(F.col("id") > F.col("first"), F.col("first")).otherwise(F.col("last"))
    found = found.withColumn("twin", twin).drop("first", "last", "digest")
    twins = materialize(found.groupBy("id", "row").agg(F.min("twin").alias("twin")), "twins")
    # A merge join, so that all uses of the result share one exchange of the texts.
    return source.join(twins.hint("merge"), ["id", "row"], "left"), found


@dataclass
class Texts:
    """Words of some texts end to end, their hashes, and the windows inside single texts."""

    words: list[bytes]
    hashes: np.ndarray
    sizes: np.ndarray
    starts: np.ndarray  # of texts
    owner: np.ndarray  # text of each word
    window: np.ndarray  # first word of each window
    anchor: np.ndarray  # first word of each window's anchor
    gram: np.ndarray  # hash of the run at each word


def read_texts(texts: list[bytes], k: int, size: int) -> Texts:
    each = [t.split() for t in texts]
    sizes = np.fromiter(map(len, each), np.int64, len(each))
    words = [w for own in each for w in own]
    hashes = hash_words(words)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(each)), sizes)
    left = np.repeat(ends, sizes) - np.arange(len(words))  # words from here to the text's end
    gram = gram_hashes(hashes, k)
    gram[left[: len(gram)] < k] = NEVER
    at = sliding_argmin(gram, size - k + 1)
    window = np.flatnonzero(left[: len(at)] >= size)
    return Texts(words, hashes, sizes, ends - sizes, owner, window, at[window], gram)


def anchor_rows(docs: DataFrame, k: int, size: int) -> DataFrame:
    """(key, id, row, h) of the distinct anchors of each text.

    An anchor that several texts of a batch have is taken to recur: each of them gets a row
    under a key of its own with the anchor in ``h``. Only the smallest id of a batch is filed
    under the anchor itself, so a passage that a third of all documents share files few rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, row, texts = batch.column("id").to_numpy(), batch.column("row").to_numpy(), utf8(batch, "text")
            found = [(np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64))]
            for start, end in chunks(texts):
                part = read_texts(texts[start:end], k, size)
                at = np.unique(part.anchor)
                own = start + part.owner[at]
                found.append((part.gram[at], ids[own], row[own]))
            h, own, text = (np.concatenate(c) for c in zip(*found))
            order = np.lexsort((text, own, h))
            h, own, text = h[order], own[order], text[order]
            new = np.r_[True, (h[1:] != h[:-1]) | (own[1:] != own[:-1]) | (text[1:] != text[:-1])][: len(h)]
            h, own, text = h[new], own[new], text[new]
            first = np.r_[True, h[1:] != h[:-1]][: len(h)]
            count = np.diff(np.r_[np.flatnonzero(first), len(h)])
            known = np.repeat(count > 1, count)
            key = np.r_[h[first], scrambled(h[known] ^ (own[known] ^ text[known]).view(np.uint64))].view(np.int64)
            tag = pa.array(np.r_[h[first], h[known]].view(np.int64), mask=np.r_[np.ones(first.sum(), bool), np.zeros(known.sum(), bool)])
            columns = [pa.array(key), pa.array(np.r_[own[first], own[known]]), pa.array(np.r_[text[first], text[known]]), tag]
            yield pa.RecordBatch.from_arrays(columns, ["key", "id", "row", "h"])

    return docs.select("id", "row", "text").mapInArrow(run, "key bigint, id bigint, row bigint, h bigint")


def recurring_anchors(docs: DataFrame, k: int, size: int) -> DataFrame:
    """(id, row, marks): for each text the anchors that another document has too, and perhaps more.

    One shuffle of narrow rows. Marks say where to look, not what repeats.
    """
    same = Window.partitionBy("key")
    rows = anchor_rows(docs, k, size).withColumn("lo", F.min("id").over(same)).withColumn("hi", F.max("id").over(same))
    marks = rows.where(F.col("h").isNotNull() | (F.col("lo") < F.col("hi")))
    return marks.groupBy("id", "row").agg(F.collect_set(F.coalesce("h", "key")).alias("marks"))


def marked(part: Texts, marks: list[np.ndarray]) -> np.ndarray:
    """Which windows have an anchor that recurs, as a mask."""
    sizes = np.fromiter(map(len, marks), np.int64, len(marks))
    salt = scrambled(np.arange(1, len(marks) + 1, dtype=np.uint64))
    wanted = np.concatenate(marks).view(np.uint64) ^ np.repeat(salt, sizes)
    return np.isin(part.gram[part.anchor] ^ salt[part.owner[part.anchor]], wanted)


def mark_arrays(batch: pa.RecordBatch) -> list[np.ndarray]:
    column = batch.column("marks")
    flat, at = column.flatten().to_numpy(), column.offsets.to_numpy()
    return [flat[s:e] for s, e in zip(at[:-1] - at[0], at[1:] - at[0])]


def shards(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[bool, pa.RecordBatch]]:
    """Rows of a partition sorted by ``key`` as (False, whole runs of about ``limit`` rows) and,
    for runs longer than that, (True, a piece of the run)."""
    done: list[pa.RecordBatch] = []
    open_run: list[pa.RecordBatch] = []
    key, hot = None, False

    def rows(parts: list[pa.RecordBatch]) -> int:
        return sum(p.num_rows for p in parts)

    for batch in batches:
        keys = batch.column("key").to_numpy()
        if not len(keys):
            continue
        begin = 0
        if key is not None and keys[0] == key:
            begin = int(np.searchsorted(keys, key, "right"))
            open_run.append(batch.slice(0, begin))
        if hot or rows(open_run) > limit:
            hot = True
            yield from ((True, p) for p in open_run)
            open_run = []
        if begin == len(keys):
            continue
        done += open_run
        hot, key = False, keys[-1]
        last = int(np.searchsorted(keys, key, "left"))
        if last > begin:
            done.append(batch.slice(begin, last - begin))
        open_run = [batch.slice(max(last, begin))]
        if rows(done) >= limit:
            yield False, pa.concat_batches(done)
            done = []
    if hot or rows(open_run) > limit:
        yield from ((True, p) for p in open_run)
        open_run = []
    if done or open_run:
        yield False, pa.concat_batches(done + open_run)


ship_by_value(__name__)
