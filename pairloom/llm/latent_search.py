"""Benchmark decontamination: latent semantic retrieval, then alignment and answer checks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.words import scrambled, text_chunks
from pairloom.runtime import arrow_batches, materialize, ship_by_value

BUCKETS = 1 << 17
WINDOW, STRIDE = 32, 16
PUNCTUATION = b".,;:!?\"'()[]{}<>|*#$%&"
# The latent space: its directions, and the passages for which the corpus counts beside the benchmark, at most.
RANK, EXTRA, SIDE_WEIGHT = 128, 32, 8192
# Items, and windows of items, searched for in one pass over the documents, at most.
PASS_ITEMS, PASS_WINDOWS = 10_000, 20_000
# Windows projected and multiplied at once.
BLOCK = 512
# The cosine that any candidate has.
LOW = 0.3
# Terms widened, scaled or added up at once.
TERMS = 8192
# Passages weighed or projected at once, and the terms whose sums move as one row.
PASSAGE_BLOCK, TERM_BLOCK = 16384, 64
# Passages of a task of the fit, about: each task sends a sum per term once.
TASK_PASSAGES = 1_000_000
# Bytes of text of one step of the fit, beside which a task holds the sums, and rows that it is sent at once.
FIT_BYTES, FIT_ROWS = 1 << 20, 2048
LEAST_WEIGHT = 0.01


def tokens(text: bytes) -> list[bytes]:
    """Words without case of A-Z and without punctuation."""
    return text.lower().translate(None, PUNCTUATION).split()


# A text as words end to end: A-Z in lower case, white space as spaces; punctuation goes.
PLAIN = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256))
FACTOR = 0x9E3779B97F4A7C15


def _powers(factor: int, n: int) -> np.ndarray:
    out = np.full(n, factor, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out, out=out)


class Words:
    """Hashes the words of texts without taking them apart.

    A word's hash is a polynomial in its bytes, the difference of two running sums over all texts.
    """

    def __init__(self) -> None:
        self.up = self.down = np.empty(0, np.uint64)

    def read(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Words of each text, and all their buckets end to end."""
        plain = [t.translate(PLAIN, PUNCTUATION) for t in texts]
        data = np.frombuffer(b" ".join([b"", *plain, b""]), np.uint8)
        if len(self.up) <= len(data):
            # Chunks are of about one size: a little more serves the next, and the old tables go first.
            self.up = self.down = np.empty(0, np.uint64)
            size = len(data) + len(data) // 8 + 1
            self.up, self.down = _powers(FACTOR, size), _powers(pow(FACTOR, -1, 1 << 64), size)
        space = data == 32
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        start, end = edge[::2], edge[1::2]
        sums = data.astype(np.uint64)
        sums += np.uint64(1)
        sums *= self.up[: len(data)]
        np.cumsum(sums, out=sums)
        h = scrambled((sums[end - 1] - sums[start - 1]) * self.down[start])
        cuts = np.cumsum([1, *(len(t) + 1 for t in plain)])
        sizes = np.diff(np.searchsorted(start, cuts))
        return sizes, (h & np.uint64(BUCKETS - 1)).astype(np.int32)


def buckets(text: bytes) -> np.ndarray:
    return Words().read([text])[1]


def window_starts(n: int) -> range:
    """Overlapping windows that cover n words; a last one ends with the text."""
    return range(0, max(1, n - WINDOW + STRIDE), STRIDE)


def laid_out(bins: np.ndarray, sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts end to end as rows of ``width`` words, each text from a row of its own, and rows per text.

    What is left of a text's last row is filled with the bucket after the last, which no word has.
    """
    per = -(-sizes // width)
    first = np.cumsum(per) - per
    place = np.arange(len(bins)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(first * width, sizes)
    out = np.full(int(per.sum()) * width, BUCKETS, np.int32)
    out[place] = bins
    return out.reshape(-1, width), per


def passage_counts(docs: DataFrame) -> DataFrame:
    """(bucket, n): passages of all documents that hold a hashed term; bucket -1: passages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, total, words = np.zeros(BUCKETS + 1, np.int64), 0, Words()
        for batch in batches:
            for _, texts in text_chunks(batch, "text"):
                sizes, bins = words.read(texts)
                rows = np.sort(laid_out(bins, sizes, WINDOW)[0], axis=1)
                once = np.ones(rows.shape, bool)
                once[:, 1:] = rows[:, 1:] != rows[:, :-1]
                counts += np.bincount(rows[once], minlength=BUCKETS + 1)
                total += len(rows)
        some = np.flatnonzero(counts[:BUCKETS])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[-1, some]), pa.array(np.r_[total, counts[some]])], ["bucket", "n"]
        )

    found = docs.select("text").mapInArrow(run, "bucket bigint, n bigint")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def inverse_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """log(passages / passages with the term) of every hashed term, a table of fixed size; and the passages.

    A term that all passages hold keeps a little weight, as in a corpus of one passage all do.
    """
    with arrow_batches(docs.sparkSession, FIT_ROWS):
        rows = passage_counts(docs).toArrow()
    bucket, n = rows.column("bucket").to_numpy(), rows.column("n").to_numpy()
    total = int(n[bucket == -1].sum())
    table = np.zeros(BUCKETS)
    table[bucket[bucket >= 0]] = n[bucket >= 0]
    return np.maximum(np.log((total + 1.0) / (table + 1.0)), LEAST_WEIGHT).astype(np.float32), total


PASSAGES = "at array<int>, weight array<float>"


def weighted(bins: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Terms of a passage and their TF-IDF weights, of unit length together."""
    terms, counts = np.unique(bins, return_counts=True)
    x = counts * idf[terms]
    return terms, (x / (np.sqrt((x * x).sum()) or 1.0)).astype(np.float32)


def weighted_rows(rows: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """:func:`weighted` of rows of words as :func:`laid_out` gives them: terms and weights end to end, terms per row."""
    rows = np.sort(rows, axis=1)
    first = np.ones(rows.shape, bool)
    first[:, 1:] = rows[:, 1:] != rows[:, :-1]
    begin = np.flatnonzero(first)
    terms, counts = rows.ravel()[begin], np.diff(np.append(begin, rows.size))
    used = terms < BUCKETS
    terms, row = terms[used], begin[used] // rows.shape[1]
    x = counts[used] * idf[terms]
    length = np.sqrt(np.bincount(row, x * x, len(rows)))
    return terms, (x / np.where(length, length, 1.0)[row]).astype(np.float32), np.bincount(row, minlength=len(rows))


def passage_batches(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Makes TF-IDF passages of batches of (text, length): all passages of a text, each of that length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, words = shared.value, Words()
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            for first, texts in text_chunks(batch, "text", FIT_BYTES):
                sizes, bins = words.read(texts)
                rows, per = laid_out(bins, sizes, WINDOW)
                length = np.repeat(lengths[first : first + len(texts)], per).astype(np.float32)
                for begin in range(0, len(rows), PASSAGE_BLOCK):
                    some = slice(begin, begin + PASSAGE_BLOCK)
                    terms, x, n = weighted_rows(rows[some], idf)
                    ends = pa.array(np.append(0, np.cumsum(n)).astype(np.int32))
                    lists = [pa.ListArray.from_arrays(ends, pa.array(v)) for v in (terms, x * np.repeat(length[some], n))]
                    yield pa.RecordBatch.from_arrays(lists, ["at", "weight"])

    return run


def measured(docs: DataFrame, length: float) -> DataFrame:
    return docs.select("text", F.lit(float(length)).alias("length"))


def passages(docs: DataFrame, shared, length: float = 1.0) -> DataFrame:
    """TF-IDF passages of texts, all of them, each of ``length``."""
    return measured(docs, length).mapInArrow(passage_batches(shared), PASSAGES)


def _gram(rows: DataFrame, make, width: int) -> np.ndarray:
    """Sum of products of fixed size, one per partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            x = make(batch).astype(np.float64)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["z"])

    parts = rows.mapInArrow(run, "z binary").toArrow().column("z").to_pylist()
    return np.sum([np.frombuffer(p).reshape(width, width) for p in parts], axis=0)


def _add(out: np.ndarray, to: np.ndarray, sizes: np.ndarray, weight: np.ndarray, at: np.ndarray, matrix: np.ndarray) -> None:
    """Adds ``weight`` times the row ``at`` of a matrix over runs of ``sizes``, which lie end to end, to a row ``to`` of its own.

    Runs of about one size are small products of equal shape; a long one is a product by itself.
    """

    def rows(places: np.ndarray) -> np.ndarray:
        return matrix[places].astype(np.float32, copy=False)

    start = np.cumsum(sizes) - sizes
    for k in np.flatnonzero(sizes > 64).tolist():
        for low in range(start[k], start[k] + sizes[k], TERMS):
            some = slice(low, min(low + TERMS, start[k] + sizes[k]))
            out[to[k]] += weight[some] @ rows(at[some])
    for width in (1, 2, 4, 8, 16, 32, 64):
        alike = np.flatnonzero((sizes <= width) & (sizes > width // 2))
        for begin in range(0, len(alike), TERMS // width):
            some = alike[begin : begin + TERMS // width]
            inside = np.arange(width) < sizes[some, None]
            place = np.where(inside, start[some, None] + np.arange(width), 0)
            out[to[some]] += ((weight[place] * inside)[:, None, :] @ rows(at[place]))[:, 0]


def latent_basis(
    rows: DataFrame, size: int, rank: int, *, make: Callable | None = None, extra: int = EXTRA, seed: int = 5
) -> np.ndarray:
    """(size, rank): what takes a TF-IDF vector to its place in the latent space of a (at, weight) table A.

    ``make`` makes such batches of those of ``rows`` in the task that adds them up.

    Randomised SVD in one pass over all rows. For a random matrix W of signs, Y = AW gives small products Y'Y,
    by which Y R is orthonormal; A'Y is summed per term in Spark, and R'(A'Y)' is A seen from there. Its
    own small products give the singular values and vectors. Folding in divides by the singular values, so that no
    direction, such as that of a language, outweighs the others. A task holds W and its sum A'Y, which it sends
    once; the driver sees matrices of (rank + extra) squared, and the result.
    """
    width = min(size, rank + extra)
    schema = "block int, z binary"

    def blocks(items: Iterator[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for block, z in items:
            columns = [pa.array([block], pa.int32()), pa.array([z.tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["block", "z"])

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        random, sums, gram = None, None, np.zeros((width, width))
        for batch in make(batches) if make else batches:
            if random is None:
                random = np.random.default_rng(seed).integers(0, 2, (size, width), np.int8)
                random *= np.int8(2)
                random -= np.int8(1)
                sums = np.zeros((-(-size // TERM_BLOCK) * TERM_BLOCK, width), np.float32)
            at, weight = batch.column("at"), batch.column("weight").flatten().to_numpy()
            sizes, terms = np.diff(at.offsets.to_numpy()), at.flatten().to_numpy()
            y = np.zeros((len(sizes), width), np.float32)
            _add(y, np.arange(len(sizes)), sizes, weight, terms, random)
            for low in range(0, len(y), TERMS):
                some = y[low : low + TERMS].astype(np.float64)
                gram += some.T @ some
            order = np.argsort(terms, kind="stable")
            begin = np.flatnonzero(np.diff(terms[order], prepend=-1))
            row = np.repeat(np.arange(len(sizes)), sizes)
            _add(sums, terms[order[begin]], np.diff(begin, append=len(order)), weight[order], row[order], y)
        random = None
        if sums is not None:
            parts = enumerate(sums.reshape(-1, TERM_BLOCK, width))
            # The small products go as block -1, in double precision.
            yield from blocks([(-1, gram)])
            yield from blocks((i, part) for i, part in parts if part.any())

    def add(parts: pa.Table) -> pa.Table:
        """The sum of a block, to which each task of the fit gave one part."""
        block = parts["block"][0].as_py()
        kind = np.float64 if block < 0 else np.float32
        total = sum(np.frombuffer(z.as_buffer(), kind).astype(np.float64) for z in parts["z"])
        return pa.table({"block": pa.array([block], pa.int32()), "z": pa.array([total.astype(kind).tobytes()], pa.binary())})

    with arrow_batches(rows.sparkSession, FIT_ROWS):
        summed = materialize(rows.mapInArrow(project, schema).groupBy("block").applyInArrow(add, schema), "projections")
    gram = [r["z"] for r in summed.where("block < 0").collect()]
    summed = summed.where("block >= 0")
    values, vectors = np.linalg.eigh(np.frombuffer(gram[0]).reshape(width, width) if gram else np.zeros((width, width)))
    # Of weaker directions single precision leaves little.
    good = values > max(values[-1] * 1e-6, 0.0)
    if not good.any():
        return np.zeros((size, 1), np.float32)
    turned = (vectors[:, good] / np.sqrt(values[good])).astype(np.float32)
    inner = turned.shape[1]

    def dense(batch: pa.RecordBatch) -> np.ndarray:
        return np.frombuffer(b"".join(batch.column("z").to_pylist()), np.float32).reshape(-1, width) @ turned

    squares, turn = np.linalg.eigh(_gram(summed, dense, inner))
    squares, turn = squares[::-1][:rank], turn[:, ::-1][:, :rank]
    used = squares > squares[0] * 1e-8
    fold = (turn[:, used] / squares[used] * np.sqrt(squares[0])).astype(np.float32)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            folded = (dense(batch) @ fold).reshape(batch.num_rows, TERM_BLOCK, -1)
            yield from blocks(zip(batch.column("block").to_pylist(), folded))

    found = summed.mapInArrow(place, schema).toArrow()
    basis = np.zeros((size, fold.shape[1]), np.float32)
    # Block by block, so that the driver holds the result and what came, and no third copy.
    for batch in found.to_batches():
        for block, z in zip(batch.column("block").to_pylist(), batch.column("z")):
            part = basis[block * TERM_BLOCK : (block + 1) * TERM_BLOCK]
            part[:] = np.frombuffer(z.as_buffer(), np.float32).reshape(TERM_BLOCK, -1)[: len(part)]
    return basis


class Space:
    """A latent space: the place of each hashed term, times its weight."""

    def __init__(self, basis: np.ndarray, idf: np.ndarray) -> None:
        # Half precision halves what is sent; a task widens it once. The row after the last is zero. Blocks
        # of terms, as the driver makes it.
        blocks = [slice(start, start + TERMS) for start in range(0, len(basis), TERMS)]
        top = max((float(np.abs(basis[b] * idf[b, None]).max()) for b in blocks), default=0.0) or 1.0
        self.half = np.zeros((len(basis) + 1, basis.shape[1]), np.float16)
        for b in blocks:
            self.half[:-1][b] = basis[b] * idf[b, None] / top
        self.wide: np.ndarray | None = None

    def __getstate__(self) -> dict:
        return {"half": self.half, "wide": None}

    def places(self, rows: np.ndarray, widen: bool = True) -> np.ndarray:
        """Sum of the terms of each row of buckets; a few rows need not widen the whole table for it."""
        if widen and self.wide is None:
            self.wide = self.half.astype(np.float32)
        table = self.wide if widen else self.half
        out = np.empty((len(rows), table.shape[1]), np.float32)
        for start in range(0, len(rows), BLOCK):
            out[start : start + BLOCK] = table[rows[start : start + BLOCK]].astype(np.float32, copy=False).sum(axis=1)
        return out

    def windows(self, bins: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(places, text, first word) of all windows of texts end to end: two neighbouring half windows each."""
        halves, per = laid_out(bins, sizes, STRIDE)
        x = self.places(halves)
        owner = np.repeat(np.arange(len(sizes)), per)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
        begins = (inside == 0) | (inside < per[owner] - 1)
        second = begins & (per[owner] > 1)
        at = np.flatnonzero(begins)
        both = x[at]
        more = second[at]
        both[more] += x[at[more] + 1]
        return both, owner[at], inside[at] * STRIDE


def common_length(masks: dict[bytes, int], size: int, words: list[bytes]) -> int:
    """Longest common subsequence with a text of ``size`` words, one machine step per word."""
    full = (1 << size) - 1
    state = full
    for word in words:
        hit = state & masks.get(word, 0)
        if hit:
            state = ((state + hit) | (state - hit)) & full
    return size - state.bit_count()


@dataclass
class Item:
    item_id: int
    words: list[bytes]
    masks: dict[bytes, int]
    answer: set[bytes]
    rows: int = 1  # of the benchmark


def make_item(item_id: int, text: str | None, idf: np.ndarray, answer_terms: int, rows: int = 1) -> Item:
    words = tokens((text or "").encode())
    masks: dict[bytes, int] = {}
    for i, word in enumerate(words):
        masks[word] = masks.get(word, 0) | 1 << i
    rare = sorted(masks, key=lambda w: (-float(idf[buckets(w)[0]]), w))
    return Item(item_id, words, masks, set(rare[:answer_terms]), rows)


class Matcher:
    """Finds the items that a text holds; windows name items by their place."""

    def __init__(
        self, space: Space, items: list[Item], cosine: float, covered: float, copied: float, paraphrased: float, answered: float
    ) -> None:
        self.space, self.items = space, items
        self.cosine, self.covered = cosine, covered
        self.copied, self.paraphrased, self.answered = copied, paraphrased, answered
        words, windows, self.terms = Words(), [], []
        for k, item in enumerate(items):
            bins = words.read([b" ".join(item.words)])[1]
            self.terms.append(np.unique(bins))
            windows += [(k, bins[s : s + WINDOW]) for s in window_starts(len(bins))]
        sizes = np.array([len(bins) for _, bins in windows])
        self.owner = np.array([k for k, _ in windows])
        self.queries = space.places(laid_out(np.concatenate([bins for _, bins in windows]), sizes, WINDOW)[0], widen=False)
        self.lengths = np.maximum(np.sqrt((self.queries**2).sum(axis=1)), 1e-12)

    def near(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, item, cosine) of windows close to an item in the latent space.

        Close is a cosine of ``cosine``, or one of ``LOW`` with a product that is ``covered`` of the
        item window's own with itself: other words in the window of a short item lower the cosine
        but not this.
        """
        unit = np.ascontiguousarray((self.queries / self.lengths[:, None]).T)
        reach = self.covered * self.lengths[None, :]
        found = ([], [], [])
        for start in range(0, len(windows), BLOCK):
            block = windows[start : start + BLOCK]
            norm = np.maximum(np.sqrt(np.einsum("ij,ij->i", block, block)), 1e-12)[:, None]
            product = block @ unit
            at = np.flatnonzero(product >= np.minimum(self.cosine * norm, np.maximum(reach, LOW * norm)))
            i, q = np.divmod(at, product.shape[1])
            found[0].append(i + start)
            found[1].append(self.owner[q])
            found[2].append(product.ravel()[at] / norm[i, 0])
        return tuple(np.concatenate(f) for f in found)

    def find(self, texts: list[bytes], words: Words) -> list[tuple]:
        """(row, item, cosine, coverage, answer, start, end) over a chunk of texts."""
        sizes, bins = words.read(texts)
        if not len(bins):
            return []
        places, owner, local = self.space.windows(bins, sizes)
        window, item, score = self.near(places)
        # An item may be close to a window by several of its own: the closest counts.
        order = np.lexsort((-score, item, window))
        first = np.r_[True, (np.diff(window[order]) != 0) | (np.diff(item[order]) != 0)][: len(order)]
        window, item, score = (part[order[first]] for part in (window, item, score))
        some = self.may_hold(bins, sizes, owner[window], local[window], item)
        window, item, score = window[some], item[some], score[some]
        best: dict[tuple[int, int], tuple] = {}
        each = {row: tokens(texts[row]) for row in np.unique(owner[window]).tolist()}
        for c, w, k in sorted(zip((-score).tolist(), window.tolist(), item.tolist())):
            row = int(owner[w])
            known = best.get((row, k))
            if not known or known[1] < self.copied:
                verdict = self.check(self.items[k], each[row], int(local[w]))
                if verdict and (not known or verdict[0] > known[1]):
                    best[row, k] = (-c, *verdict)
        found = []
        for (row, k), rest in best.items():
            found += [(row, self.items[k].item_id, *rest)] * self.items[k].rows
        return sorted(found, key=lambda f: (f[0], f[1] is None, f[1] or 0))

    def may_hold(self, bins: np.ndarray, sizes: np.ndarray, text: np.ndarray, at: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Which candidates have enough words of the item around, in any order, to hold it in order."""
        out = np.zeros(len(item), bool)
        ends = np.cumsum(sizes)
        own = np.zeros(BUCKETS, bool)
        order = np.argsort(item, kind="stable")
        for group in np.split(order, np.flatnonzero(np.diff(item[order])) + 1) if len(order) else ():
            k = int(item[group[0]])
            size, low = len(self.items[k].words), (ends - sizes)[text[group]]
            start = np.maximum(low, low + at[group] - size)
            length = np.minimum(ends[text[group]], low + at[group] + WINDOW + size) - start
            first = np.cumsum(length) - length
            places = np.arange(int(length.sum())) - np.repeat(first - start, length)
            own[self.terms[k]] = True
            count = np.add.reduceat(own[bins[places]], first, dtype=np.int64)
            own[self.terms[k]] = False
            out[group] = count >= self.paraphrased * size
        return out

    def check(self, item: Item, words: list[bytes], at: int) -> tuple | None:
        """(coverage, answer, start, end) if the words around a window hold the item."""
        size = len(item.words)
        start, end = max(0, at - size), min(len(words), at + WINDOW + size)
        region = words[start:end]
        coverage = common_length(item.masks, size, region) / size
        answer = len(item.answer.intersection(region)) / len(item.answer)
        held = coverage >= self.copied or (coverage >= self.paraphrased and answer >= self.answered)
        return (coverage, answer, start, end) if held else None


LEAKS = "doc_id bigint, item_id bigint, cosine double, coverage double, answer double, start_word bigint, end_word bigint"


def _matchers(
    docs: DataFrame, benchmark: DataFrame, *, rank: int = RANK, cosine: float = 0.45, covered: float = 0.5,
    copied: float = 0.8, paraphrased: float = 0.6, answered: float = 0.8, answer_terms: int = 5,
    side_weight: int = SIDE_WEIGHT,
) -> Iterator:
    """A broadcast matcher for every block of benchmark items, so of bounded size.

    One latent space serves all blocks. It is fitted on every passage of the corpus and the
    benchmark. If one of them has more than ``side_weight`` passages, all of these weigh as much together as
    so many would, so that a large corpus does not drown the benchmark's words. A block has about
    ``PASS_WINDOWS`` windows and ``PASS_ITEMS`` items at most; equal rows are one item.
    """
    spark = docs.sparkSession
    plain = F.translate("text", PUNCTUATION.decode(), "")
    n_words = F.regexp_count(plain, F.lit(r"[^\x20\x09-\x0D]+"))
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text", n_words.alias("n")).where("n > 0")
    items = items.groupBy("item_id", "text", "n").agg(F.count("*").alias("rows"))
    windows = F.ceil(F.greatest(F.lit(1), F.col("n") - WINDOW + STRIDE) / STRIDE)
    n_items, n_windows = items.agg(F.count("*"), F.coalesce(F.sum(windows), F.lit(0))).first()
    if not n_items:
        return
    blocks = max(-(-n_items // PASS_ITEMS), -(-n_windows // PASS_WINDOWS))
    idf, n_passages = inverse_frequencies(docs)
    shared = spark.sparkContext.broadcast(idf)
    both = measured(items, min(1.0, side_weight / n_windows) ** 0.5).unionByName(
        measured(docs, min(1.0, side_weight / max(1, n_passages)) ** 0.5)
    )
    tasks = max(2, -(-(n_windows + n_passages) // TASK_PASSAGES))
    space = Space(latent_basis(both.coalesce(tasks), BUCKETS, rank, make=passage_batches(shared)), idf)
    for i in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == i).orderBy("item_id", "text").collect()
        if own:
            made = [make_item(r["item_id"], r["text"], idf, answer_terms, r["rows"]) for r in own]
            yield spark.sparkContext.broadcast(Matcher(space, made, cosine, covered, copied, paraphrased, answered))


def find_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """(doc_id, item_id, cosine, coverage, answer, start_word, end_word) of documents holding items.

    Windows of 32 words, half overlapping, of every whole text are folded into a latent space of all
    TF-IDF passages of the corpus and the benchmark; term weights come from all documents. Windows
    with a cosine of ``cosine`` or more with one of an item's there are candidates, and those that
    hold ``covered`` of it at a cosine of ``LOW``. An item counts as held if its longest common
    subsequence with the words around reaches ``copied`` of it, or ``paraphrased`` of it while
    ``answered`` of its rarest terms, which stand for its answer, occur there. Null and empty
    texts and items match nothing; null ids stay; repeated rows are reported alike.
    """
    found = []
    for shared in _matchers(docs, benchmark, **options):

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            words = Words()
            for batch in batches:
                ids = batch.column("doc_id").to_pylist()
                rows = []
                for first, texts in text_chunks(batch, "text"):
                    rows += [(ids[first + row[0]], *row[1:]) for row in shared.value.find(texts, words)]
                columns = list(zip(*rows)) if rows else [()] * 7
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]
                names = [f.split()[0] for f in LEAKS.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
            shared.value.space.wide = None

        found.append(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, LEAKS))
    if not found:
        return docs.sparkSession.createDataFrame([], LEAKS)
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return whole


def without_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that hold an item; no text is shuffled.

    All columns stay. Null and empty texts hold nothing and stay, as all do without items; rows
    that repeat an id are judged by their own text. An empty table stays empty.
    """
    for shared in _matchers(docs, benchmark, **options):

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            words = Words()
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for first, texts in text_chunks(batch, "text"):
                    for row in shared.value.find(texts, words):
                        keep[first + row[0]] = False
                yield batch.filter(pa.array(keep))
            shared.value.space.wide = None

        docs = docs.mapInArrow(run, docs.schema)
    return docs


ship_by_value(__name__)
