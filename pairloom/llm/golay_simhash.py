"""SimHash near-duplicates found by Golay-code fuzzy hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.components import components
from pairloom.llm.golay import error_patterns, near_codewords
from pairloom.llm.words import utf8
from pairloom.runtime import materialize, ship_by_value, skewed_join

# A fingerprint's segments: shift and bits. Each is decoded as a 23-bit word with leading zeros.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
MAX_BITS = 3
# Fingerprints of one key compared at once; larger groups are cut into blocks for other tasks.
BLOCK = 4096
HASH_SEED = 42


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """64-bit SimHash of a UTF-8 text over word shingles, repeats included, as a signed integer."""
    words = text.lower().split()
    if not words:
        return 0
    runs = zip(*(words[i:] for i in range(shingle))) if len(words) >= shingle else [words]
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(b" ".join(run), HASH_SEED) for run in runs], np.uint64)
    ones = np.zeros(64, np.int64)
    for start in range(0, len(h), 1 << 16):
        block = h[start : start + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h)).view(np.int64)[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, fp) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t, shingle) for t in utf8(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    return docs.select("doc_id", F.col(text).alias("text")).mapInArrow(run, "doc_id bigint, fp bigint")


def keys_of(fps: np.ndarray, patterns: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(keys, rows, asks) by which fingerprints within three bits meet.

    Three errors over three segments leave either one segment without an error and another
    with one at most, or one error in each. So each pair of segments gives a key from the
    first's bits and the second's codeword, and all three codewords give one more. A
    fingerprint is filed under the nearest codeword and asks under all within four bits, of
    which there are six or one; that finds every pair with one error there.
    """
    u = fps.view(np.uint64)
    bits = [((u >> np.uint64(s)) & np.uint64((1 << n) - 1)).astype(np.int64) for s, n in SEGMENTS]
    near = [near_codewords(b, patterns) for b in bits]
    rows = np.arange(len(fps))

    def tagged(family: int, value: np.ndarray) -> np.ndarray:
        return value | np.int64(family << 40)

    def spread(families: list[np.ndarray], picks: list[tuple[int, ...]]):
        """Rows and codeword indices for every choice of columns that exists."""
        for pick in picks:
            chosen = [f[:, j] for f, j in zip(families, pick)]
            there = np.logical_and.reduce([c >= 0 for c in chosen])
            yield rows[there], [c[there] for c in chosen]

    family = 0
    for x in range(3):
        for y in range(3):
            if x == y:
                continue
            yield tagged(family, bits[x] << 12 | near[y][:, 0]), rows, False
            for at, (c,) in spread([near[y]], [(j,) for j in range(6)]):
                yield tagged(family, bits[x][at] << 12 | c), at, True
            family += 1
    first = near[0][:, 0] << 24 | near[1][:, 0] << 12
    for at, (c,) in spread([near[2]], [(j,) for j in range(6)]):
        yield tagged(family, first[at] | c), at, False
    for at, (a, b) in spread(near[:2], [(i, j) for i in range(6) for j in range(6)]):
        yield tagged(family, a << 24 | b << 12 | near[2][at, 0]), at, True


class Forest:
    """Which fingerprints a task has linked so far; a link that says nothing new is not repeated."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        top = x
        while (p := up.get(top, top)) != top:
            top = p
        while (p := up.get(x, x)) != top and p != x:
            up[x], x = top, p
        return top

    def link(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def _pairs(own: np.ndarray, asks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs within three bits of two blocks, by place."""
    i, j = np.nonzero(np.bitwise_count(own[:, None] ^ asks[None, :]) <= MAX_BITS)
    return i, j


EDGES = "a bigint, b bigint, block bigint, asks boolean"


def _linked(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    """Links inside each run of equal keys of a sorted partition.

    A run with more than ``block`` rows of a kind is not compared here but handed on as pairs
    of blocks, each a key of its own.
    """
    forest = Forest()

    def table(a, b, key, asks) -> pa.RecordBatch:
        columns = [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(key, pa.int64()), pa.array(asks, pa.bool_())]
        return pa.RecordBatch.from_arrays(columns, ["a", "b", "block", "asks"])

    def deferred(key: int, own: np.ndarray, asking: np.ndarray) -> Iterator[pa.RecordBatch]:
        own_blocks, ask_blocks = (range(0, len(x), block) for x in (own, asking))
        for i in own_blocks:
            for j in ask_blocks:
                name = xxhash.xxh3_64_intdigest(f"{key} {i} {j}".encode()) >> 1
                for part, kind in ((own[i : i + block], False), (asking[j : j + block], True)):
                    n = len(part)
                    yield table(part.view(np.int64), [None] * n, [name] * n, [kind] * n)

    def run(key: np.ndarray, fp: np.ndarray, asks: np.ndarray) -> Iterator[pa.RecordBatch]:
        edges = np.flatnonzero(np.diff(key)) + 1
        starts, ends = np.r_[0, edges], np.r_[edges, len(key)]
        asking = np.add.reduceat(asks.astype(np.int64), starts)
        some = (asking > 0) & (asking < ends - starts)
        found_a, found_b = [], []
        for s, e in zip(starts[some], ends[some]):
            values, kinds = fp[s:e], asks[s:e]
            own, asked = values[~kinds], values[kinds]
            if len(own) > block or len(asked) > block:
                yield from deferred(int(key[s]), own, asked)
                continue
            for o in range(0, len(own), 256):
                left = own[o : o + 256]
                i, j = _pairs(left, asked)
                a, b = left[i].view(np.int64), asked[j].view(np.int64)
                other = a != b
                for x, y in zip(a[other].tolist(), b[other].tolist()):
                    if forest.link(x, y):
                        found_a.append(x)
                        found_b.append(y)
        if found_a:
            n = len(found_a)
            yield table(found_a, found_b, [None] * n, [None] * n)

    held: list[tuple[np.ndarray, ...]] = []
    for batch in batches:
        columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "fp", "asks")]
        if not len(columns[0]):
            continue
        key = columns[0]
        last = int(np.searchsorted(key, key[-1], "left"))
        if last == 0 and held and held[-1][0][-1] == key[0]:
            held.append(tuple(columns))  # the run goes on
            continue
        whole = [np.concatenate([h[c] for h in held] + [columns[c][:last]]) for c in range(3)]
        held = [tuple(c[last:] for c in columns)]
        if len(whole[0]):
            yield from run(whole[0], whole[1].view(np.uint64), whole[2].astype(bool))
    if held:
        whole = [np.concatenate([h[c] for h in held]) for c in range(3)]
        yield from run(whole[0], whole[1].view(np.uint64), whole[2].astype(bool))


def fingerprint_links(fps: DataFrame, block: int = BLOCK) -> DataFrame:
    """(a, b): links that connect all distinct fingerprints within three bits, as chains of such.

    Every pair within three bits is compared; a pair that others already connect in the same
    task is left out. Two stored tables: the links, and the blocks of keys too large for one
    task.
    """

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = error_patterns()
        for batch in batches:
            values = batch.column("fp").to_numpy()
            for start in range(0, len(values), 10_000):
                part = values[start : start + 10_000]
                for key, rows, asks in keys_of(part, patterns):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key), pa.array(part[rows]), pa.array(np.full(len(key), asks))], ["key", "fp", "asks"]
                    )

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _linked(batches, block)

    def linked(keyed: DataFrame) -> DataFrame:
        return keyed.repartition("key").sortWithinPartitions("key").mapInArrow(link, EDGES)

    keyed = fps.mapInArrow(file, "key bigint, fp bigint, asks boolean")
    found = materialize(linked(keyed), "links")
    large = found.where(F.col("block").isNotNull()).select(F.col("block").alias("key"), F.col("a").alias("fp"), "asks")
    rest = linked(large)
    return found.where(F.col("block").isNull()).select("a", "b").unionByName(rest.select("a", "b"))


def near_duplicates(docs: DataFrame, text: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, fp, component_id): documents whose fingerprints link, directly or through others.

    ``component_id`` is the smallest doc_id of the class. Fingerprints link at three differing
    bits or fewer; null and empty texts have fingerprint zero and link like any other. Copies
    share a fingerprint and meet once, as that fingerprint. A row without an id takes part, but
    cannot name its class: the class of such rows only has component_id null. Repeated rows give
    repeated result rows, an empty table none.
    """
    prints = materialize(fingerprints(docs, text, shingle), "fingerprints")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(fingerprint_links(distinct.select("fp")))
    placed = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    placed = materialize(placed, "classes")
    names = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    named = skewed_join(placed.select("fp", "root"), names, "root", salt_by=["fp"]).drop("root")
    return skewed_join(prints, named, "fp", salt_by=["doc_id"])


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The document with the smallest id of each class, with the columns of ``docs``.

    Rows that repeat an id are one document, of which one row stays. Rows without an id cannot
    be told apart by it: they stay, less exact repeats.
    """
    found = near_duplicates(docs, **options)
    kept = found.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    named = docs.where(F.col("doc_id").isNotNull()).join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    unnamed = docs.where(F.col("doc_id").isNull()).dropDuplicates()
    return named.select(*docs.columns).unionByName(unnamed)


def hex_fingerprint(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


ship_by_value(__name__)
