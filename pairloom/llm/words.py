"""Words as the operators of this package understand them, in SQL expressions and over bytes.

A word is a run of characters other than space, tab, newline, vertical tab, form feed and
carriage return. ``bytes.split()`` cuts UTF-8 at exactly these, and ``bytes.lower()`` changes
only A-Z. A null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.runtime import ship_by_value

WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
# Texts handled together by one vectorised step.
CHUNK_BYTES = 2 << 20


def text_of(text: str | Column) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def wrapped(docs: DataFrame, *names: str | Column) -> DataFrame:
    """``names`` of a table beside its whole row as ``_doc``, so that no column of it can clash
    with one that an operator adds. ``select("_doc.*")`` gives the table back."""
    return docs.select(*names, F.struct("*").alias("_doc"))


def count_words(text: str | Column) -> Column:
    return F.regexp_count(text_of(text), F.lit(WORD)).cast("bigint")


def words_of(text: str | Column) -> Column:
    return F.regexp_extract_all(text_of(text), F.lit(WORD), F.lit(0))


def utf8(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A text column as UTF-8, nulls as empty."""
    return [b or b"" for b in batch.column(name).cast(pa.binary()).to_pylist()]


def chunks(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``limit`` bytes of text each, one row at least."""
    start = total = 0
    for i, text in enumerate(texts):
        if total and total + len(text) > limit:
            yield start, i
            start, total = i, 0
        total += len(text)
    if start < len(texts):
        yield start, len(texts)


def text_chunks(batch: pa.RecordBatch, name: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts) of the :func:`chunks` of a text column: of a batch only one chunk is held as Python bytes."""
    column = batch.column(name).cast(pa.binary())
    start = total = 0
    for i, size in enumerate(pc.fill_null(pc.binary_length(column), 0).to_pylist()):
        if total and total + size > limit:
            yield start, [b or b"" for b in column.slice(start, i - start).to_pylist()]
            start, total = i, 0
        total += size
    if start < len(column):
        yield start, [b or b"" for b in column.slice(start).to_pylist()]


def hash_words(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter(map(digest, words), np.uint64, len(words))


def scrambled(h: np.ndarray) -> np.ndarray:
    """Mix 64-bit values so that their order says nothing about where they came from."""
    h = h.copy()
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h ^= h >> np.uint64(shift)
        h *= np.uint64(factor)
    return h ^ (h >> np.uint64(31))


def gram_hashes(word_hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k consecutive words; empty if there are fewer."""
    n = len(word_hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(k):
        total = total * np.uint64(0x9E3779B97F4A7C15) + word_hashes[i : i + n]
    return scrambled(total)


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost smallest value in each window of ``width`` values.

    Windows of doubling width are combined, so the cost is a few vector operations.
    """
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, np.int64)
    at, have = np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        left, right = at[:-step], at[step:]
        at = np.where(values[right] < values[left], right, left)
        have += step
    return at[:n]


ship_by_value(__name__)
