"""Spelling variants: words one edit apart, found by pivotal bigrams, and the form each belongs to."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.runtime import materialize, ship_by_value

LEAST_CHARS, LEAST_TIMES = 7, 2
# A form occurs this many times as often as the word it stands for.
FORM_TIMES = 10
# Distinct words a task counts before it hands them on.
HELD_WORDS = 300_000
# Letters of a run, one byte each in Latin-1: other characters become spaces, A-Z become a-z.
LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256)
)


def runs_of(text: str) -> list[bytes]:
    """Maximal runs of ``[A-Za-z\\u00C0-\\u00FF]`` as Latin-1, with A-Z in lower case."""
    return text.encode("latin-1", "replace").translate(LETTERS).split()


def typo(run: bytes, seed: int) -> bytes:
    """``run`` less one letter if 31 divides its crc32, which goes on from ``seed``."""
    h = crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
    if h % 31:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_CHARS) -> DataFrame:
    """(word, n) over all texts, typos put in: words of ``least`` letters or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def table() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in held], pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc, body in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                seed = crc32(f"{'' if doc is None else doc}:".encode())
                for word, n in Counter(w for w in runs_of(body or "") if len(w) >= least).items():
                    word = typo(word, seed)
                    if len(word) >= least:
                        held[word] += n
                if len(held) > HELD_WORDS:
                    yield table()
                    held.clear()
        if held:
            yield table()

    counted = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def gram_counts(words: DataFrame) -> dict[str, int]:
    """How many bigrams of the vocabulary are which; of 90 letters there are at most 8,100."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in batches:
            for w in batch.column("word").to_pylist():
                held.update(map("".join, zip(w, w[1:])))
        grams = pa.array(list(held), pa.string())
        yield pa.RecordBatch.from_arrays([grams, pa.array(list(held.values()), pa.int64())], ["gram", "df"])

    rows = words.select("word").mapInArrow(run, "gram string, df bigint").groupBy("gram").agg(F.sum("df"))
    return dict(rows.collect())


def prefix_of(word: str, rank: dict[str, int]) -> list[tuple[int, int]]:
    """(rank, position) of the three rarest bigrams of a word and of all as rare as the third.

    One edit changes two bigrams at most, so words one edit apart share one of them.
    """
    grams = sorted((rank[word[i : i + 2]], i) for i in range(len(word) - 1))
    last = grams[min(2, len(grams) - 1)][0]
    return [g for g in grams if g[0] <= last]


def pivots_of(prefix: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Two disjoint bigrams of a prefix, the rarest pair of such, by dynamic programming from left to right.

    An edit touches one of the two at most, so the other stands in the other word too. If that
    word's prefix ends with a bigram as common or more, the pivot is in it.
    """
    best: list[list[tuple[int, list]]] = [[(0, [])], [], []]  # by number of pivots: (sum of ranks, pivots) so far
    for rank, at in sorted(prefix, key=lambda g: g[1]):
        for n in (1, 0):
            fits = [(total + rank, [*chosen, (rank, at)]) for total, chosen in best[n] if not chosen or chosen[-1][1] + 2 <= at]
            if fits:
                best[n + 1].append(min(fits))
    return min(best[2])[1]


def _key(rank: int, at: int, size: int, side: str, part: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{rank} {at} {size} {side} {part}".encode()) - (1 << 63)


def _part(word: str, other: int, side: str) -> str:
    """The half of a word that one of ``other`` letters has too, if their one edit is in the other half.

    Halves are those of the shorter of both.
    """
    short = min(len(word), other)
    half = short // 2
    return word[:half] if side == "l" else word[len(word) - (short - half) :]


def filed(word: str, prefix: list[tuple[int, int]]) -> dict[int, int]:
    """Keys of a word's prefix: bigram, position and length, with the half that stays, and where that is cut off."""
    size = len(word)
    parts = {(side, _part(word, other, side)) for other in (size - 1, size, size + 1) for side in "lr"}
    return {_key(rank, at, size, side, part): _cut(side, part) for rank, at in prefix for side, part in parts}


def asked(word: str, pivots: list[tuple[int, int]]) -> dict[int, int]:
    """Keys under which words one edit apart that share a pivot are filed, likewise.

    An edit in one half leaves the other as it is. A pivot in the left half keeps its position if that
    stays, one in the right half moves with the length if that stays; any other may do both.
    """
    size, out = len(word), {}
    for rank, at in pivots:
        for other in (size - 1, size, size + 1):
            half, moved = min(size, other) // 2, at + other - size
            for side in "lr":
                inside = at + 2 <= half if side == "l" else at >= size - (min(size, other) - half)
                part = _part(word, other, side)
                for p in ({at} if side == "l" else {moved}) if inside else {at, moved}:
                    out[_key(rank, p, other, side, part)] = _cut(side, part)
    return out


def _cut(side: str, part: str) -> int:
    return len(part) if side == "l" else -len(part)


def _rest(word: str, cut: int) -> str:
    return word[cut:] if cut >= 0 else word[:cut]


def one_edit(a: str, b: str) -> bool:
    """Do two strings differ by exactly one inserted, deleted or replaced character?"""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def _shorter(word: str) -> set[str]:
    return {word[:i] + word[i + 1 :] for i in range(len(word))}


def _holed(word: str) -> list[str]:
    return [f"{word[:i]}\0{word[i + 1 :]}" for i in range(len(word))]


def _met(own: list[tuple[str, str]], asking: list[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """(word, near) of one key's (word, rest) rows whose rests are one edit apart.

    Many rows are looked up by their rests less one letter, so the work grows with the rows.
    """
    if len(own) * len(asking) <= 16:
        for word, a in asking:
            yield from ((word, near) for near, b in own if one_edit(a, b))
        return
    exact, cut, holed = defaultdict(list), defaultdict(list), defaultdict(list)
    for near, b in own:
        exact[b].append(near)
        for x in _shorter(b):
            cut[x].append(near)
        for x in _holed(b):
            holed[x].append(near)
    for word, a in asking:
        yield from ((word, near) for near in cut.get(a, ()))
        for x in _shorter(a):
            yield from ((word, near) for near in exact.get(x, ()))
        for x in _holed(a):
            yield from ((word, near) for near in holed.get(x, ()) if near != word)


def _matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs from the runs of equal keys of a sorted partition; a task holds a batch and the run it ends in."""

    def pairs(table: pa.Table) -> pa.RecordBatch:
        key, asks, cut = (table.column(c).to_numpy() for c in ("key", "asks", "cut"))
        starts = np.r_[0, np.flatnonzero(np.diff(key)) + 1]
        ends = np.r_[starts[1:], len(key)]
        asking = np.add.reduceat(asks.astype(np.int64), starts)
        some = (asking > 0) & (asking < ends - starts)
        words = table.column("word").combine_chunks()
        # Most words meet only themselves.
        two = np.flatnonzero(some & (ends - starts == 2))
        same = pc.equal(words.take(pa.array(starts[two])), words.take(pa.array(starts[two] + 1)))
        some[two[same.to_numpy(zero_copy_only=False)]] = False
        found = set()
        for s, e in zip(starts[some].tolist(), ends[some].tolist()):
            rows = [(w, _rest(w, c)) for w, c in zip(words.slice(s, e - s).to_pylist(), cut[s:e].tolist())]
            kinds = asks[s:e].tolist()
            found.update(_met([r for r, k in zip(rows, kinds) if not k], [r for r, k in zip(rows, kinds) if k]))
        columns = list(zip(*found)) if found else [(), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["word", "near"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column("key").to_numpy()
        last = int(np.searchsorted(key, key[-1], "left"))
        if last or held and held[-1].column("key")[0].as_py() != key[0]:
            whole = pa.Table.from_batches([*held, batch.slice(0, last)])
            if whole.num_rows:
                yield pairs(whole)
            held = []
        held.append(batch.slice(last))
    if held:
        yield pairs(pa.Table.from_batches(held))


def near_words(words: DataFrame) -> DataFrame:
    """(word, near) for all pairs of words that differ by one inserted, deleted or replaced code point, both ways.

    Words of four letters or more, each once. Each word asks with its two pivots and is filed under
    its prefix; what meets under a key shares half of its letters, and the other half is verified.
    """
    counts = gram_counts(words)
    rank = {gram: i for i, gram in enumerate(sorted(counts, key=lambda g: (counts[g], g)))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, names, cuts, asks = [], [], [], []
            for w in batch.column("word").to_pylist():
                prefix = prefix_of(w, rank)
                for kind, found in ((False, filed(w, prefix)), (True, asked(w, pivots_of(prefix)))):
                    keys.extend(found)
                    cuts.extend(found.values())
                    names.extend([w] * len(found))
                    asks.extend([kind] * len(found))
            columns = [pa.array(keys, pa.int64()), pa.array(names, pa.string()), pa.array(cuts, pa.int32()), pa.array(asks, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "word", "cut", "asks"])

    keyed = words.select("word").mapInArrow(run, "key bigint, word string, cut int, asks boolean")
    met = keyed.repartition("key").sortWithinPartitions("key").mapInArrow(_matched, "word string, near string")
    met = materialize(met.distinct(), "near")
    return met.unionByName(met.select(F.col("near").alias("word"), F.col("word").alias("near"))).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of a (word, form) table: forms are followed to the last.

    A form occurs ten times as often as its word, so a chain has at most 19 of them, and a word
    is the form of its few thousand neighbours at most: no key is hot.
    """
    links = forms.select(F.col("word").alias("root"), F.col("form").alias("next"))
    now = forms.select("word", F.col("form").alias("root"))
    while True:
        now = materialize(now.join(links, "root", "left"), "roots")
        if now.where(F.col("next").isNotNull()).isEmpty():
            return now.select("word", "root")
        now = now.select("word", F.coalesce("next", "root").alias("root"))


def spelling_variants(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_CHARS, times: int = LEAST_TIMES,
    ratio: int = FORM_TIMES,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of ``least`` letters that occurs ``times`` or more.

    ``form`` is the word one edit away that occurs most often, if ``ratio`` times as often; of ties
    the smallest by code point. ``root`` is the last of the chain of forms, the word itself without
    one. Null texts have no words, a null id hashes like an empty one, repeated rows count again,
    an empty table gives none. Columns other than ``key`` and ``text`` are ignored. ``least`` must
    be 4 or more, so that a word has two disjoint pivots.
    """
    if least < 4:
        raise ValueError("words need four letters to have two disjoint bigrams")
    words = materialize(word_counts(docs, key, text, least).where(F.col("n") >= times), "vocabulary")
    pairs = near_words(words)
    counts = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    nearest = pairs.join(counts, "near").groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("form"))).alias("top")
    )
    form_n = -F.col("top.minus")
    fits = form_n >= ratio * F.col("n")
    joined = materialize(
        words.join(nearest, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(fits, F.col("top.form")).alias("form"), F.when(fits, form_n).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(joined.where(F.col("form").isNotNull()).select("word", "form"))
    return joined.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


ship_by_value(__name__)
