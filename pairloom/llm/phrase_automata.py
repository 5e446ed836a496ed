"""Substring dedup by automata of repeated phrases.

Windows whose anchor recurs are gathered by anchor. Each shard of anchors confirms by text which
windows start in several documents, compiles those into an Aho-Corasick automaton, and streams
the passages of all documents with these anchors through it to find every occurrence.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.anchors import (
    COMBINE_BYTES, Texts, exact_copies, mark_arrays, marked, numbered, read_texts, real_id, recurring_anchors, shards,
)
from pairloom.llm.words import chunks, gram_hashes, hash_words, scrambled, utf8
from pairloom.runtime import materialize, ship_by_value, skewed_join

SIZE, ANCHOR = 13, 5
SHARD_ROWS = 16_000
PASSAGES = "key bigint, id bigint, row bigint, start bigint, text binary, flags binary"
FOUND = "id bigint, row bigint, flags binary, text binary"


class Codes(dict):
    """Numbers of words in the order of their first occurrence."""

    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self)
        return code


def _codes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(Codes().__getitem__, words), np.int64, len(words))


def _equal(codes: np.ndarray, a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """Which windows at ``a`` hold the words of those at ``b``."""
    same = np.ones(len(a), bool)
    for i in range(size):
        same &= codes[a + i] == codes[b + i]
    return same


def _packed(owner: np.ndarray, places: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Places of each owner as bytes; ``owner`` is sorted."""
    if len(owner):
        cuts = np.r_[0, np.flatnonzero(np.diff(owner)) + 1, len(owner)]
        for s, e in zip(cuts[:-1], cuts[1:]):
            yield int(owner[s]), places[s:e].astype(np.int64).tobytes()


def _stretches(part: Texts, window: np.ndarray, anchor: np.ndarray, size: int) -> Iterator[tuple[int, int, int]]:
    """(window's first place in the list, first word, word after) of neighbours with one anchor."""
    if len(window):
        cut = np.flatnonzero((np.diff(window) != 1) | (np.diff(anchor) != 0)) + 1
        for s, e in zip(np.r_[0, cut], np.r_[cut, len(window)]):
            yield int(s), int(window[s]), int(window[e - 1]) + size


def passages(marked_docs: DataFrame, size: int, k: int) -> DataFrame:
    """Passages to compare, filed under their anchor.

    A window whose words a smaller id of the same batch has too need not be compared with other
    batches. It is known to repeat: its place comes in ``flags``, under a scattered key.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, row, texts, marks = batch.column("id").to_numpy(), batch.column("row").to_numpy(), utf8(batch, "text"), mark_arrays(batch)
            for start, end in chunks(texts, COMBINE_BYTES):
                part = read_texts(texts[start:end], k, size)
                some = marked(part, marks[start:end])
                window, anchor = part.window[some], part.anchor[some]
                own = ids[start + part.owner[window]]
                wh = gram_hashes(part.hashes, size)[window]
                order = np.lexsort((window, own, wh))
                new = np.r_[True, wh[order][1:] != wh[order][:-1]][: len(order)]
                lead = order[new][np.cumsum(new) - 1]
                later = own[order] > own[lead]
                codes = _codes(part.words) if later.any() else None
                if codes is not None:
                    # Equal hashes are not enough.
                    at = np.flatnonzero(later)
                    later[at] = _equal(codes, window[order[at]], window[lead[at]], size)
                known = np.sort(order[later])
                sent = np.sort(order[~later])
                rows: tuple[list, ...] = ([], [], [], [], [], [])
                text_of = part.owner[window[known]]
                for i, flags in _packed(text_of, window[known] - part.starts[text_of]):
                    doc, text = ids[start + i], row[start + i]
                    key = int(scrambled(np.array([doc ^ text], np.int64).view(np.uint64)).view(np.int64)[0])
                    for column, value in zip(rows, (key, int(doc), int(text), None, None, flags)):
                        column.append(value)
                keys = part.gram[anchor[sent]].view(np.int64)
                for at, s, e in _stretches(part, window[sent], anchor[sent], size):
                    i = int(part.owner[s])
                    record = int(keys[at]), int(ids[start + i]), int(row[start + i]), s - int(part.starts[i]), b" ".join(part.words[s:e]), None
                    for column, value in zip(rows, record):
                        column.append(value)
                kinds = [pa.int64()] * 4 + [pa.binary()] * 2
                names = [c.split()[0] for c in PASSAGES.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, kinds)], names)

    return marked_docs.select("id", "row", "text", "marks").mapInArrow(run, PASSAGES)


class Shard:
    """Passages of some anchors, end to end, as codes of their words."""

    def __init__(self, texts: list[bytes], ids: list[int], size: int) -> None:
        codes = Codes()
        split = [t.split(b" ") for t in texts]
        lengths = np.fromiter(map(len, split), np.int64, len(split))
        words = [w for own in split for w in own]
        self.codes = np.fromiter(map(codes.__getitem__, words), np.int64, len(words))
        self.size, self.ends = size, np.cumsum(lengths)
        self.starts = self.ends - lengths
        hashes = gram_hashes(hash_words(list(codes))[self.codes], size)
        left = np.repeat(self.ends, lengths) - np.arange(len(words))
        self.window = np.flatnonzero(left[: len(hashes)] >= size)
        self.hashes = hashes[self.window]
        self.owner = np.repeat(np.arange(len(split)), lengths)[self.window]
        self.ids = np.array(ids, np.int64)
        # One character for each word: from 1 on, without the range that no string may hold.
        letters = self.codes + 1
        letters[letters >= 0xD800] += 0x800
        self.string = letters.astype("<u4").tobytes().decode("utf-32-le")

    def groups(self) -> np.ndarray:
        """A number for each window, the same for windows of the same words."""
        order = np.argsort(self.hashes, kind="stable")
        new = np.r_[True, self.hashes[order][1:] != self.hashes[order][:-1]][: len(order)]
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(new) - 1
        first = self.window[order[new]][number]
        if _equal(self.codes, self.window, first, self.size).all():
            return number
        # Different words with one hash: compare all windows as strings.
        known: dict[str, int] = {}
        return np.array([known.setdefault(self.string[w : w + self.size], len(known)) for w in self.window.tolist()], np.int64)

    def recurring(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows that start in several documents: a place and the smallest id of each, and the
        passages that hold them in a later document."""
        if not len(self.window):
            return (np.empty(0, np.int64),) * 3
        group, own = self.groups(), self.ids[self.owner]
        order = np.lexsort((own, group))
        group, own = group[order], own[order]
        start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        count = np.diff(np.r_[start, len(group)])
        first = own[start]
        several = own[start + count - 1] > first
        later = order[own > np.repeat(first, count)]
        return self.window[order[start[several]]], first[several], np.unique(self.owner[later])

    def occurrences(self) -> Iterator[tuple[int, np.ndarray]]:
        """(passage, places in it) of windows that start in an earlier document too.

        The automaton is compiled from the words of the recurring windows; what it does not find
        does not count.
        """
        places, first, passages = self.recurring()
        if not len(places):
            return
        automaton = ahocorasick.Automaton()
        for at, doc in zip(places.tolist(), first.tolist()):
            automaton.add_word(self.string[at : at + self.size], doc)
        automaton.make_automaton()
        for i in passages.tolist():
            doc = int(self.ids[i])
            found = automaton.iter(self.string[int(self.starts[i]) : int(self.ends[i])])
            at = [end - self.size + 1 for end, earliest in found if earliest < doc]
            if at:
                yield i, np.array(at, np.int64)


def repeated_windows(filed: DataFrame, size: int) -> DataFrame:
    """(id, row, flags): places of a text's windows that start in an earlier document too.

    Anchors with more passages than a shard holds, such as very common phrases, are cut into
    single windows; the smallest id of each, by its words, is combined before the shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hot, batch in shards(batches, SHARD_ROWS):
            rows: list[tuple] = []
            ids, row, begin, texts, flags = (batch.column(c).to_pylist() for c in ("id", "row", "start", "text", "flags"))
            rows += [(doc, r, f, None) for doc, r, f in zip(ids, row, flags) if f is not None]
            real = [i for i, text in enumerate(texts) if text is not None]
            if hot:
                for i in real:
                    words = texts[i].split(b" ")
                    rows += [
                        (ids[i], row[i], np.int64(begin[i] + j).tobytes(), b" ".join(words[j : j + size]))
                        for j in range(len(words) - size + 1)
                    ]
            else:
                shard = Shard([texts[i] for i in real], [ids[i] for i in real], size)
                for n, places in shard.occurrences():
                    i = real[n]
                    rows.append((ids[i], row[i], (places + begin[i]).tobytes(), None))
            columns = list(zip(*rows)) if rows else [()] * 4
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["id", "row", "flags", "text"])

    gathered = filed.repartition("key").sortWithinPartitions("key")
    found = materialize(gathered.mapInArrow(run, FOUND), "windows")
    known = found.where(F.col("text").isNull()).select("id", "row", "flags")
    single = found.where(F.col("text").isNotNull())
    first = single.groupBy("text").agg(F.min("id").alias("_first"))
    later = skewed_join(single, first, "text", salt_by=["id", "row"]).where(F.col("id") > F.col("_first"))
    return known.unionByName(later.select("id", "row", "flags"))


CUT = "id bigint, n_words bigint, n_removed bigint, kept string, kept_sha256 string"


def cut_repeats(docs: DataFrame, *, size: int = SIZE, anchor: int = ANCHOR, texts: bool = True) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, kept_sha256): each text without what earlier ones hold.

    A word goes if a window of ``size`` words around it also starts in a document with a smaller
    id; windows are judged on the input. ``kept`` joins the words left by single spaces (null
    unless ``texts``). Documents without an id come last and are never earlier than another;
    rows that share an id do not count against each other. Null, empty and short texts lose
    nothing, and an empty table gives none.
    """
    source, _ = exact_copies(numbered(docs))
    # A copy of an earlier text goes as a whole, and shows others nothing that the first does not.
    copy = F.coalesce(F.col("twin") < F.col("id"), F.lit(False))
    single = source.where(~copy)
    marks = recurring_anchors(single, anchor, size)
    filed = passages(single.join(marks, ["id", "row"]), size, anchor)
    flags = repeated_windows(filed, size).groupBy("id", "row").agg(F.collect_set("flags").alias("flags"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            packed, copies = (batch.column(c).to_pylist() for c in ("flags", "copy"))
            for text, own, copy in zip(utf8(batch, "text"), packed, copies):
                words = text.split()
                kept = words
                if copy:
                    kept = words if len(words) < size else []
                elif own:
                    at = np.frombuffer(b"".join(own), np.int64)
                    change = np.zeros(len(words) + 1, np.int64)
                    np.add.at(change, at, 1)
                    np.add.at(change, at + size, -1)
                    kept = [w for w, c in zip(words, np.cumsum(change[:-1])) if not c]
                joined = b" ".join(kept)
                rows.append((len(words), len(words) - len(kept), joined if texts else None, hashlib.sha256(joined).hexdigest()))
            columns = list(zip(*rows)) if rows else [(), (), (), ()]
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.string()]
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds)]
            arrays[2] = arrays[2].cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *arrays], ["id", "n_words", "n_removed", "kept", "kept_sha256"]
            )

    joined = source.join(flags, ["id", "row"], "left").select("id", "text", copy.alias("copy"), "flags")
    return joined.mapInArrow(run, CUT).select(real_id(), "n_words", "n_removed", "kept", "kept_sha256")


ship_by_value(__name__)
