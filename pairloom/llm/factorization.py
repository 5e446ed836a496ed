"""Toxicity: a factorization machine over hashed terms."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.decision_lists import labelled_sample
from pairloom.runtime import materialize, ship_by_value

TERM = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5, 6)
BUCKET_BITS = 20
CACHED_WORDS = 400_000
# Deviations from which a term counts by itself, and a pair of terms by what it adds to them.
LEAST_Z, PAIR_Z = 3.0, 6.0
# Terms whose pairs are counted, those of pairs that take part at most, and rows multiplied at once.
PAIR_TERMS, MOST_PAIRED, PAIR_ROWS, PAIR_PARTS = 1024, 256, 4096, 4


def buckets_of(word: str) -> list[int]:
    """Hashed terms of a word: itself, and its beginnings, which inflected forms share."""
    terms = [word, *(f"{word[:n]}*" for n in PREFIXES if len(word) > n)]
    mask = (1 << BUCKET_BITS) - 1
    return [xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")) & mask for t in terms]


@dataclass
class Machine:
    """Weights of the terms that count: bias, linear part and factors, by position in ``terms``."""

    terms: np.ndarray
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def score(self, rows: list[np.ndarray]) -> np.ndarray:
        at, starts = _flat(rows)
        return _sigmoid(_forward(at, starts, self.bias, self.linear, self.factors)[0])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def _flat(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    at = np.concatenate(rows) if len(rows) else np.empty(0, np.int64)
    return at.astype(np.int64), np.r_[0, np.cumsum(sizes)]


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0)])
    return total[starts[1:]] - total[starts[:-1]]


def _forward(at, starts, bias, linear, factors):
    """Raw scores, and each row's sum of factors: pairs cost no more than single terms."""
    v = factors[at]
    both = _sums(v, starts)
    pairs = 0.5 * ((both**2).sum(axis=1) - _sums((v**2).sum(axis=1), starts))
    return bias + _sums(linear[at], starts) + pairs, both


def _gradient(at, starts, y, weight, bias, linear, factors):
    raw, both = _forward(at, starts, bias, linear, factors)
    error = (_sigmoid(raw) - y) * weight
    each = np.repeat(error, np.diff(starts))
    d_linear = np.bincount(at, each, len(linear))
    gap = np.repeat(both, np.diff(starts), axis=0) - factors[at]
    d_factors = np.stack(
        [np.bincount(at, each * gap[:, k], len(linear)) for k in range(factors.shape[1])], axis=1
    )
    return error.sum(), d_linear, d_factors


def _words(text: str | None) -> set[str]:
    return set(TERM.findall(text.lower())) if text else set()


def term_counts(sample: DataFrame) -> DataFrame:
    """(term, n, bad): documents with each hashed term, and toxic ones among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, list[int]] = {}
        size = 1 << BUCKET_BITS
        counts = np.zeros((2, size), np.int64)
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("_label").to_pylist()):
                own = np.fromiter({b for w in _words(text) for b in _cached(cache, w)}, np.int64)
                counts[0, own] += 1
                counts[1, own] += int(label == 1)
        some = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(some), pa.array(counts[0, some]), pa.array(counts[1, some])], ["term", "n", "bad"]
        )

    found = sample.select("text", "_label").mapInArrow(run, "term bigint, n bigint, bad bigint")
    return found.groupBy("term").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))


def _cached(cache: dict[str, list[int]], word: str) -> list[int]:
    found = cache.get(word)
    if found is None:
        if len(cache) >= CACHED_WORDS:
            cache.clear()
        found = cache[word] = buckets_of(word)
    return found


def choose_terms(counts: DataFrame, rows: int, bad: int, size: int, least: int) -> np.ndarray:
    """Terms whose share of toxic documents differs most, in deviations, from the overall share."""
    rate = bad / rows
    z = (F.col("bad") - F.col("n") * rate) / F.sqrt(F.col("n") * rate * (1 - rate))
    chosen = counts.where(F.col("n") >= least).select("term", F.abs(z).alias("z")).where(F.col("z") > LEAST_Z)
    picked = chosen.orderBy(F.desc("z"), "term").limit(size).collect()
    return np.array([r["term"] for r in picked], np.int64)


def encoded_rows(sample: DataFrame, terms: np.ndarray) -> DataFrame:
    """(at, y): places in ``terms`` of each text's terms, and its label."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(terms)
        for batch in batches:
            rows = [reader.row(t).astype(np.int32) for t in batch.column("text").to_pylist()]
            y = [int(v == 1) for v in batch.column("_label").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int32())), pa.array(y, pa.int32())], ["at", "y"])

    return sample.select("text", "_label").mapInArrow(encode, "at array<int>, y int")


def choose_pairs(sample: DataFrame, counts: DataFrame, rows: int, bad: int, size: int, least: int) -> np.ndarray:
    """Terms of pairs that tell more together than their single shares do.

    Of the ``PAIR_TERMS`` terms that divide the texts most evenly all pairs are counted, as products of
    matrices, one small matrix per partition. A pair counts if its share of toxic texts is many
    deviations from the sum of what its two terms add to the overall share. A term may have no
    deviation of its own.
    """
    rate = bad / rows
    even = F.col("n") * (rows - F.col("n"))
    spread = counts.where((F.col("n") >= least) & (F.col("n") <= rows - least)).orderBy(F.desc(even), "term")
    terms = np.array([r["term"] for r in spread.limit(PAIR_TERMS).collect()], np.int64)
    n = len(terms)
    if n < 2:
        return np.empty(0, np.int64)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, n, n), np.float32)
        for batch in batches:
            at, y = batch.column("at"), batch.column("y").to_numpy()
            sizes = np.diff(at.offsets.to_numpy())
            for start in range(0, len(sizes), PAIR_ROWS):
                stop = min(start + PAIR_ROWS, len(sizes))
                flat = at.slice(start, stop - start).flatten().to_numpy()
                x = np.zeros((stop - start, n), np.float32)
                x[np.repeat(np.arange(stop - start), sizes[start:stop]), flat] = 1
                total[0] += x.T @ x
                toxic = x[y[start:stop] == 1]
                total[1] += toxic.T @ toxic
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["c"])

    parts = encoded_rows(sample, terms).coalesce(PAIR_PARTS).mapInArrow(multiply, "c binary").toArrow().column("c").to_pylist()
    both, toxic = np.sum([np.frombuffer(p, np.float32).reshape(2, n, n) for p in parts], axis=0, dtype=np.float64)
    single = np.diag(toxic) / np.maximum(np.diag(both), 1)
    expected = np.clip(single[:, None] + single[None, :] - rate, 0.5 / rows, 1 - 0.5 / rows)
    z = np.abs(toxic - both * expected) / np.sqrt(np.maximum(both, 1) * expected * (1 - expected))
    i, j = np.triu_indices(n, 1)
    some = (both[i, j] >= least) & (z[i, j] > PAIR_Z)
    i, j = i[some], j[some]
    order = np.lexsort((terms[j], terms[i], -z[i, j]))
    ranked = np.stack([terms[i[order]], terms[j[order]]], axis=1).ravel()
    _, first = np.unique(ranked, return_index=True)
    return ranked[np.sort(first)][:size]


def fit(
    sample: DataFrame, *, terms: int = 4096, factors: int = 4, steps: int = 60, rate: float = 0.05,
    decay: float = 1e-4, least: int = 4, parts: int = 8, seed: int = 7,
) -> Machine | None:
    """A machine from (text, _label) rows, None if they have one label only.

    At most ``terms`` hashed terms take part, by what they and their pairs say over the whole sample. Each step
    is a Spark job: partitions of the stored rows add up gradients, and the driver, which sees
    one gradient per partition and no row, moves the weights (Adam). Rare labels weigh more.
    """
    n, bad = sample.agg(F.count("*"), F.coalesce(F.sum((F.col("_label") == 1).cast("int")), F.lit(0))).first()
    if not bad or bad == n:
        return None
    counts = materialize(term_counts(sample), "term-counts")
    own = choose_terms(counts, n, bad, terms, least)
    paired = choose_pairs(sample, counts, n, bad, min(terms // 4, MOST_PAIRED), least)
    chosen = np.unique(np.r_[own[: terms - len(paired)], paired])

    encoded = materialize(encoded_rows(sample, chosen).coalesce(parts), "terms")
    rng = np.random.default_rng(seed)
    size = len(chosen)
    bias, linear, v = 0.0, np.zeros(size), rng.normal(0, 0.02, (size, factors))
    rare = min(10.0, (n - bad) / bad)
    moments = [np.zeros(1 + size * (1 + factors)), np.zeros(1 + size * (1 + factors))]
    context = sample.sparkSession.sparkContext
    for step in range(1, steps + 1):
        shared = context.broadcast((bias, linear, v))

        def gradients(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            b, w, f = shared.value
            total = np.zeros(1 + size * (1 + factors))
            for batch in batches:
                y = batch.column("y").to_numpy()
                at = batch.column("at")
                flat, starts = at.flatten().to_numpy().astype(np.int64), at.offsets.to_numpy().astype(np.int64)
                weight = np.where(y == 1, rare, 1.0)
                d_b, d_w, d_f = _gradient(flat, starts - starts[0], y, weight, b, w, f)
                total += np.concatenate([[d_b], d_w, d_f.ravel()])
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["g"])

        parts_of = encoded.mapInArrow(gradients, "g binary").toArrow().column("g").to_pylist()
        g = np.sum([np.frombuffer(p) for p in parts_of], axis=0) / n
        g += decay * np.concatenate([[0.0], linear, v.ravel()])
        moments[0] = 0.9 * moments[0] + 0.1 * g
        moments[1] = 0.99 * moments[1] + 0.01 * g * g
        move = rate * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-8)
        bias -= move[0]
        linear = linear - move[1 : 1 + size]
        v = v - move[1 + size :].reshape(size, factors)
        shared.destroy()
    return Machine(chosen, bias, linear, v)


class Reader:
    """Positions of a text's chosen terms."""

    def __init__(self, terms: np.ndarray) -> None:
        self.place = {int(t): i for i, t in enumerate(terms)}
        self.cache: dict[str, tuple[int, ...]] = {}

    def row(self, text: str | None) -> np.ndarray:
        found: set[int] = set()
        cache = self.cache
        for word in _words(text):
            own = cache.get(word)
            if own is None:
                if len(cache) >= CACHED_WORDS:
                    cache.clear()
                own = cache[word] = tuple(self.place[b] for b in buckets_of(word) if b in self.place)
            if own:
                found.update(own)
        return np.fromiter(sorted(found), np.int64, len(found))


def held_out(doc_id: Column) -> Column:
    """Rows that are never learnt from: crc32 of the id as text is a multiple of five."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0, F.lit(False))


def score_toxicity(docs: DataFrame, labels: DataFrame, *, fit_rows: int = 20_000, **options) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document.

    The machine is fitted on ``labels.toxic`` of at most ``fit_rows`` documents that are not held
    out, and scores whole texts by the set of their terms: order and repeats do not matter. A
    null or empty text scores as the bias alone, which is the score of a text without any term
    that counts. Null ids are scored and not held out. Without labels of both kinds every score
    is 0. Repeated rows score alike.
    """
    sample = labelled_sample(docs, labels, "toxic", fit_rows, ~held_out(F.col("doc_id")))
    machine = fit(materialize(sample, "sample"), **options)
    size = 0 if machine is None else len(machine.terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(machine.terms) if size else None
        for batch in batches:
            texts = batch.column("text").to_pylist()
            if machine is None:
                scores = np.zeros(len(texts))
            elif not size:
                scores = np.full(len(texts), float(_sigmoid(np.array(machine.bias))))
            else:
                scores = machine.score([reader.row(t) for t in texts])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, score double"
    )
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


ship_by_value(__name__)
