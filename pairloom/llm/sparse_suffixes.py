"""Repeated passages from a sparse suffix array.

Only suffixes that start at minimiser positions are kept. They are sorted by what follows and,
reversed, by what precedes; neighbours are compared in both orders, and a passage is the sum of
the match to the left and the match to the right of such a position.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.anchors import (
    COMBINE_BYTES, exact_copies, mark_arrays, marked, numbered, read_texts, real_id, recurring_anchors, shards,
)
from pairloom.llm.words import chunks, count_words, scrambled, utf8
from pairloom.runtime import materialize, ship_by_value, skewed_join

SIZE, ANCHOR = 50, 8
# Suffixes compared at once, and those in the last round, when only very common ones are left.
SHARD_ROWS, LAST_ROWS = 6_000, 20_000
SUFFIXES = "key bigint, id bigint, row bigint, at bigint, left int, text binary, other bigint, size int"
WINDOWS = "id bigint, row bigint, start bigint, end bigint, other bigint, text binary, least bigint"
REPEATS = "id bigint, start_word bigint, end_word bigint, other_id bigint"


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    arrays = [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


def suffixes(marked_docs: DataFrame, size: int, k: int) -> DataFrame:
    """The words around each anchor that recurs, filed under the anchor.

    ``text`` runs from the earliest to the latest word that a window with this anchor can hold,
    ``left`` of them before the anchor, ``at`` is its first word's place. Of equal ones in one
    batch that with the smallest id is sent, with another's id in ``other``, as it stands for
    both. All of them are known to repeat: they also come without text, under scattered keys.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, row, marks = batch.column("id").to_numpy(), batch.column("row").to_numpy(), mark_arrays(batch)
            texts = utf8(batch, "text")
            for start, end in chunks(texts, COMBINE_BYTES):
                part = read_texts(texts[start:end], k, size)
                some = np.unique(part.anchor[marked(part, marks[start:end])])
                own = part.owner[some]
                begin = np.maximum(part.starts[own], some - (size - k))
                stop = np.minimum(part.starts[own] + part.sizes[own], some + size)
                groups: dict[tuple[int, bytes], list[int]] = {}
                for i in np.lexsort((some, ids[start + own])).tolist():
                    text = b" ".join(part.words[begin[i] : stop[i]])
                    groups.setdefault((int(some[i] - begin[i]), text), []).append(i)
                rows: list[tuple] = []
                for (left, text), members in groups.items():
                    first, last = (int(ids[start + own[i]]) for i in (members[0], members[-1]))
                    for i in members:
                        doc, place = start + int(own[i]), int(begin[i] - part.starts[own[i]])
                        this = int(ids[doc]), int(row[doc]), place, left
                        if i == members[0] or this[0] == first:
                            partner = last if first != last else None
                            rows.append((int(part.gram[some[i]].view(np.int64)), *this, text, partner, None))
                        if first != last:
                            mixed = scrambled(np.array([this[1] ^ place], np.int64).view(np.uint64)).view(np.int64)
                            other = last if this[0] == first else first
                            rows.append((int(mixed[0]), *this, None, other, int(stop[i] - begin[i])))
                yield _batch(rows, SUFFIXES)

    return marked_docs.select("id", "row", "text", "marks").mapInArrow(run, SUFFIXES)


def _sorted_classes(key: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows by key and codes, and how many codes each shares with the row before (-1: other key)."""
    big = np.ascontiguousarray(np.c_[key.view(np.uint64).astype(">u8").view(">u4").reshape(-1, 2), codes.astype(">u4")])
    big = big.astype(">u4")
    order = np.argsort(big.view(f"S{big.shape[1] * 4}").ravel(), kind="stable")
    a, b = codes[order[1:]], codes[order[:-1]]
    shared = np.minimum.accumulate((a == b) & (a > 0), axis=1).sum(axis=1)
    shared[key[order[1:]] != key[order[:-1]]] = -1
    return order, shared


def _largest_neighbour(order: np.ndarray, shared: np.ndarray) -> np.ndarray:
    both = np.r_[-1, shared, -1]
    out = np.empty(len(order), np.int64)
    out[order] = np.maximum(both[:-1], both[1:])
    return out


def _class_at(order: np.ndarray, shared: np.ndarray, depth: int) -> np.ndarray:
    out = np.empty(len(order), np.int64)
    out[order] = np.r_[0, np.cumsum(shared < depth)]
    return out


def matches(
    key: np.ndarray, ids: np.ndarray, others: np.ndarray, left: np.ndarray, texts: list[bytes], size: int, k: int
) -> list[tuple]:
    """(place, first word, end, other id) of rows whose words match another document's.

    A row stands for the documents ``ids`` and ``others`` (the same if it stands for one).

    Two suffixes of one anchor match over ``size`` words, ``a`` of them to the left, if they
    are in one class of the left order at depth ``a`` and of the right order at depth
    ``size - a``; neighbours in both orders say which rows can match at all.
    """
    codes: dict[bytes, int] = {}
    flat = [[codes.setdefault(w, len(codes) + 1) for w in text.split(b" ")] for text in texts]
    lengths = np.fromiter(map(len, flat), np.int64, len(flat))
    word = np.fromiter((c for own in flat for c in own), np.int64, int(lengths.sum()))
    begin = np.cumsum(lengths) - lengths

    def matrix(steps: np.ndarray, ok: np.ndarray) -> np.ndarray:
        return np.where(ok, word[np.where(ok, begin[:, None] + steps, 0)], 0).astype(np.uint32)

    ahead = left[:, None] + np.arange(size)
    back = left[:, None] - 1 - np.arange(max(1, size - k))
    right = _sorted_classes(key, matrix(ahead, ahead < lengths[:, None]))
    before = _sorted_classes(key, matrix(back, back >= 0))
    possible = _largest_neighbour(*right) + np.maximum(_largest_neighbour(*before), 0) >= size
    low = np.full(len(texts), size + 1)
    high = np.full(len(texts), -1)
    other = np.full(len(texts), np.iinfo(np.int64).max)
    for a in range(size - k + 1 if possible.any() else 0):
        rows = np.flatnonzero(possible & (left >= a) & (lengths - left >= size - a))
        if len(rows) < 2:
            continue
        pair = _class_at(*right, size - a)[rows] * len(texts) + _class_at(*before, a)[rows]
        order = np.argsort(pair, kind="stable")
        rows, pair = rows[order], pair[order]
        start = np.r_[0, np.flatnonzero(np.diff(pair)) + 1]
        count = np.diff(np.r_[start, len(pair)])
        least = np.repeat(np.minimum.reduceat(np.minimum(ids, others)[rows], start), count)
        most = np.repeat(np.maximum.reduceat(np.maximum(ids, others)[rows], start), count)
        hit = least != most
        found = rows[hit]
        low[found] = np.minimum(low[found], a)
        high[found] = np.maximum(high[found], a)
        other[found] = np.minimum(other[found], np.where(ids[found] == least[hit], most[hit], least[hit]))
    # Windows around one anchor overlap, so what matches is one run of words.
    return [(int(i), int(left[i] - high[i]), int(left[i] - low[i] + size), int(other[i])) for i in np.flatnonzero(high >= 0)]


def _refiled(suffix: tuple, size: int, k: int) -> Iterator[tuple]:
    """A suffix of a very common anchor under longer keys.

    Of ``size`` words half at least lie to the right of the anchor's start or half to its left,
    so two suffixes that match share the words of one of these halves.
    """
    _, doc, row, at, left, text, other, _ = suffix
    words, half = text.split(b" "), size // 2
    if len(words) - left >= half:
        yield _long_key(b"right", words[left : left + max(half, k)]), doc, row, at, left, text, other, None
    if left >= half:
        yield _long_key(b"left", words[left - half : left + k]), doc, row, at, left, text, other, None


def _long_key(side: bytes, words: list[bytes]) -> int:
    return xxhash.xxh3_64_intdigest(b" ".join([side, *words])) - (1 << 63)


def _search(batches: Iterator[pa.RecordBatch], size: int, k: int, last: bool) -> Iterator[pa.RecordBatch]:
    """Spans found in a sorted partition of suffixes; spans found before pass through.

    Suffixes of a run that is too long for a shard go on, under longer keys or, in the ``last``
    round, as they are.
    """
    for hot, batch in shards(batches, LAST_ROWS if last else SHARD_ROWS):
        rows = list(zip(*(c.to_pylist() for c in batch.columns)))
        real = [r for r in rows if r[5] is not None]
        out = [r for r in rows if r[5] is None]
        if hot:
            out += real if last else [new for r in real for new in _refiled(r, size, k)]
        elif real:
            array = lambda c: np.array([r[c] for r in real], np.int64)
            others = np.array([r[1] if r[6] is None else r[6] for r in real], np.int64)
            for i, s, e, other in matches(array(0), array(1), others, array(4), [r[5] for r in real], size, k):
                _, doc, row, at, *_ = real[i]
                out.append((doc ^ row, doc, row, at + s, None, None, other, e - s))
        yield _batch(out, SUFFIXES)


ORDERED = SUFFIXES + ", ahead binary, shared int"


def _shared(a: bytes, b: bytes) -> int:
    """Words at the beginning of both; each word of either is followed by a space."""
    return os.path.commonprefix((a, b)).count(b" ")


def _with_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[tuple], list[int]]]:
    """Rows of each batch of a sorted partition, and how many words each shares with a neighbour at most.

    Of equal beginnings in a sorted list the longest are neighbours'. The first and the last row of a partition
    have neighbours elsewhere; all their words count as shared.
    """
    at, key = ORDERED.split(", ").index("ahead binary"), 0
    before, held = None, []

    def judged(rows: list[tuple], after: tuple | None, first: bool):
        bounds = []
        around = [before if not first else None, *rows, after]
        pairs = [
            (-1 if a is None or b is None else _shared(a[at], b[at]) if a[key] == b[key] else 0)
            for a, b in zip(around, around[1:])
        ]
        for row, low, high in zip(rows, pairs, pairs[1:]):
            bounds.append(row[at].count(b" ") if -1 in (low, high) else max(low, high))
        return rows, bounds

    for batch in batches:
        rows = list(zip(*(c.to_pylist() for c in batch.columns)))
        if not rows:
            continue
        if held:
            yield judged(held, rows[0], before is None)
            before = held[-1]
        held = rows
    if held:
        yield judged(held, None, before is None)


def _reach(words: list[bytes], left: int, behind: int, ahead: int, size: int, k: int) -> range:
    """How many words before the anchor a window may begin that repeats."""
    return range(max(0, size - min(ahead, len(words) - left)), min(behind, left, size - k) + 1)


def hot_spans(hot: DataFrame, size: int, k: int) -> DataFrame:
    """(id, row, start, end, other) for suffixes of runs that no task holds.

    They are sorted by what follows the anchor over all tasks, then by what precedes it. How
    much a suffix shares with its neighbours in both orders says which of its windows can repeat
    at all; those are compared by their words, within a batch first. What repeats there is reported,
    and once more stands for its batch; only what is alone in its batch and yet possible goes on by itself.
    """

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns)))
            yield _batch([(*r, b" ".join([*r[5].split(b" ")[r[4] :], b""]), None) for r in rows], ORDERED)

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, bounds in _with_neighbours(batches):
            out = []
            for r, n in zip(rows, bounds):
                back = r[5].split(b" ")[: r[4]][::-1]
                out.append((*r[:8], b" ".join([*back, b""]), n))
            yield _batch(out, ORDERED)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, bounds in _with_neighbours(batches):
            least: dict[bytes, int] = {}
            most: dict[bytes, int] = {}
            possible: list[list[tuple[int, bytes]]] = []
            for r, behind in zip(rows, bounds):
                words, left, ids = r[5].split(b" "), r[4], (r[1], r[1] if r[6] is None else r[6])
                own = [
                    (left - a, b" ".join(words[left - a : left - a + size]))
                    for a in _reach(words, left, behind, r[9], size, k)
                ]
                for _, text in own:
                    least[text] = min(least.get(text, ids[0]), *ids)
                    most[text] = max(most.get(text, ids[0]), *ids)
                possible.append(own)
            out = []
            for r, own in zip(rows, possible):
                _, doc, row, at, *_ = r
                here = [(place, text) for place, text in own if least[text] < most[text]]
                if here:
                    text = here[0][1]
                    other = least[text] if doc != least[text] else most[text]
                    # Windows around one anchor overlap; they begin from the last place to the first.
                    out.append((doc, row, at + here[-1][0], at + here[0][0] + size, other, None, None))
                out += [
                    (doc, row, at + place, at + place + size, None, text, doc) for place, text in own if least[text] == most[text]
                ]
            # What repeats here may be alone elsewhere.
            out += [(None, None, None, None, most[text], text, low) for text, low in least.items() if low < most[text]]
            yield _batch(out, WINDOWS)

    right = hot.mapInArrow(order, ORDERED).repartitionByRange("key", "ahead", "id", "at")
    left = right.sortWithinPartitions("key", "ahead", "id", "at").mapInArrow(turn, ORDERED)
    left = left.repartitionByRange("key", "ahead", "id", "at").sortWithinPartitions("key", "ahead", "id", "at")
    found = materialize(left.mapInArrow(compare, WINDOWS), "windows")
    alone = found.where(F.col("text").isNotNull())
    ends = alone.groupBy("text").agg(F.min("least").alias("lo"), F.max(F.coalesce("other", "least")).alias("hi"))
    met = skewed_join(alone.where(F.col("id").isNotNull()), ends.where(F.col("lo") < F.col("hi")), "text", salt_by=["id", "row"])
    partner = F.when(F.col("id") == F.col("lo"), F.col("hi")).otherwise(F.col("lo"))
    late = met.where(F.col("lo").isNotNull()).select("id", "row", "start", "end", partner.alias("other"))
    return found.where(F.col("text").isNull()).select("id", "row", "start", "end", "other").unionByName(late)


def matched_spans(filed: DataFrame, size: int, k: int) -> DataFrame:
    """(id, row, start, end, other) of passages that another document has too."""

    def search(suffixes: DataFrame, last: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return _search(batches, size, k, last)

        return suffixes.repartition("key").sortWithinPartitions("key").mapInArrow(run, SUFFIXES)

    found = materialize(search(search(filed, False), True), "suffixes")
    known = found.where(F.col("text").isNull()).select(
        "id", "row", F.col("at").alias("start"), (F.col("at") + F.col("size")).alias("end"), "other"
    )
    hot = found.where(F.col("text").isNotNull())
    return known if hot.isEmpty() else known.unionByName(hot_spans(hot, size, k))


def repeated_passages(docs: DataFrame, *, size: int = SIZE, anchor: int = ANCHOR) -> DataFrame:
    """(doc_id, start_word, end_word, other_id): passages that stand in another document too.

    A row is a longest run of words of a document in which every word belongs to ``size`` words
    in a row that another document has as well; ``other_id`` is one of those. All documents with
    such a passage are reported, the first included; repeats inside one document alone are not.
    Words are compared unchanged. Documents without an id count as one document, null and short
    texts have no passage, rows that repeat id and text are reported once.
    """
    source, copied = exact_copies(numbered(docs), count_words("text").alias("end"))
    # A text with a copy is a passage as a whole; its first document stands for all in the search.
    start = F.lit(0).cast("bigint").alias("start")
    whole = copied.where(F.col("end") >= size).select("id", "row", start, "end", F.col("twin").alias("other"))
    single = source.where(F.coalesce(F.col("twin") > F.col("id"), F.lit(True)))
    marks = recurring_anchors(single, anchor, size)
    spans = matched_spans(suffixes(single.join(marks, ["id", "row"]), size, anchor), size, anchor).unionByName(whole)
    grouped = spans.groupBy("id", "row").agg(F.sort_array(F.collect_set(F.struct("start", "end", "other"))).alias("spans"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc, own in zip(batch.column("id").to_pylist(), batch.column("spans").to_pylist()):
                start = end = other = None
                for span in own:
                    if end is not None and span["start"] <= end:
                        end, other = max(end, span["end"]), min(other, span["other"])
                        continue
                    if end is not None:
                        rows.append((doc, start, end, other))
                    start, end, other = span["start"], span["end"], span["other"]
                rows.append((doc, start, end, other))
            yield _batch(rows, REPEATS)

    merged = grouped.select("id", "spans").mapInArrow(merge, REPEATS)
    return merged.select(real_id(), "start_word", "end_word", "other_id")


ship_by_value(__name__)
