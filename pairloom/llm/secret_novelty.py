"""Secret scan: known patterns, and strings that zstandard cannot explain from their surroundings."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.runtime import ship_by_value

KINDS = ("assign", "access", "hex", "novel")
# The base patterns, as (pattern, group measured, least length).
BASE = {
    "assign": (
        r"(?ai:(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+))", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
}
# Runs of hex digits that are too short never count, and prose is full of them.
HEX_RUN = r"(?<![0-9a-f])[0-9a-f]{24,}"
# A string that may be a secret, and the words that make its place a sensitive one.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
SENSITIVE_WORDS = (
    "passw", "passphrase", "secret", "token", "credential", "apikey", "api_key", "accesskey", "access_key",
    "privatekey", "private_key", "auth", "bearer", "signature", "session",
)
# Further parts may follow dots, as in a JSON web token.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}(?:\.+[A-Za-z0-9+/_-]+={0,2})*")
PART = r"[^.]{16,}"
LEAST_CHARS = 16
# What may stand between a sensitive word and an assigned value: the rest of the name, and the separator.
NAME = re.compile(r"[A-Za-z0-9_-]*+")
SEPARATOR = re.compile(r"""["']?\s*[:=]+\s*["']?""")
SENSITIVE = f"(?ai:{'|'.join(SENSITIVE_WORDS)})"
IDENTIFIER = r"(?a:[A-Za-z_][A-Za-z_]{2,30})"
# Words of code around keys and tokens.
CODE_WORDS = (
    "access account api app auth authorization base64 bearer begin bucket build cache certificate class client "
    "config const content cookie credential data database default define dict digest endpoint env export false "
    "file function hash header host https id import index init int key let localhost login main message name null "
    "object open optional option output package param passphrase password path port private project public query "
    "region request response return root secret self server service session setting sha1 sha256 signature source "
    "static std string test this token true type update url user username value var version"
).split()
NEAR_CHARS = 48  # how close a sensitive word must be before a candidate
AROUND_CHARS = 256  # how much of the surroundings primes the compressor
MIN_BITS = 4.0  # marginal bits per character from which a candidate is novel
ALPHABET = re.compile(r"[A-Za-z]")
DIGIT = re.compile(r"[0-9]")


def _holds(low: str, words: tuple[str, ...]) -> bool:
    return any(word in low for word in words)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns: leftmost, not overlapping within a kind."""
    spans = []
    low = text.lower()
    if _holds(low, ASSIGN_WORDS):
        pattern, group, least = BASE["assign"]
        spans += [(m.start(), 0, m.end()) for m in re.finditer(pattern, text) if len(m[group]) >= least]
    if "AKIA" in text:
        pattern, _, least = BASE["access"]
        spans += [(m.start(), 1, m.end()) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    spans += [(m.start(), 2, m.end()) for m in re.finditer(HEX_RUN, text)]
    return sorted(spans)


def sensitive_words(text: str) -> Iterator[re.Match]:
    """A plain search first: it is much faster than the pattern, and most texts have none."""
    return re.finditer(SENSITIVE, text) if _holds(text.lower(), SENSITIVE_WORDS) else iter(())


def sensitive_places(text: str) -> list[tuple[int, int]]:
    """Spans of candidates that follow a sensitive word closely.

    One pass from left to right: the end of a name, what follows it, and the end of a candidate are
    the same for all sensitive words in it and are looked for once.
    """
    found = []
    name_end, value = -1, None
    known_start = known_end = -1
    for word in sensitive_words(text):
        if word.end() > name_end:
            name_end = NAME.match(text, word.end()).end()
            assigned = SEPARATOR.match(text, name_end)
            value = assigned.end() if assigned else None
        begin = word.end() if value is None else value
        at = begin
        # Only the beginning has to be near: a candidate is looked for there, then read to its end.
        while near := CANDIDATE.search(text, at, begin + NEAR_CHARS + LEAST_CHARS):
            start = near.start()
            if not known_start <= start < known_end:
                known_start, known_end = start, CANDIDATE.match(text, start).end()
            at = known_end
            # A word that merely contains the sensitive one goes on from it.
            if (value is not None or start > begin) and (not found or found[-1][1] <= start):
                found.append((start, at))
    return found


class Novelty:
    """Marginal compressed size of a string, given identifiers and its surroundings."""

    def __init__(self, identifiers: list[str]) -> None:
        # The end of a dictionary is the cheapest to refer to: the common words go there.
        words = " ".join([*reversed(identifiers), *CODE_WORDS])
        self.words = words.encode()

    def bits(self, text: str, start: int, end: int) -> float:
        """Bits per character that the candidate adds to what surrounds it."""
        before = text[max(0, start - AROUND_CHARS) : start].encode("utf-8", "replace")
        after = text[end : end + AROUND_CHARS].encode("utf-8", "replace")
        candidate = text[start:end].encode("utf-8", "replace")
        prime = zstandard.ZstdCompressionDict(self.words + b"\n" + after + b"\n" + before, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        packer = zstandard.ZstdCompressor(level=12, dict_data=prime, write_content_size=False, write_checksum=False)
        once, none = len(packer.compress(candidate)), len(packer.compress(b""))
        return 8.0 * (once - none) / len(candidate)

    def bits_once(self, text: str, start: int, end: int) -> float:
        """The same as if the candidate stood nowhere else around: a copy does not explain it."""
        candidate, blank = text[start:end], " " * (end - start)
        # A copy at the edge of the surroundings is seen whole.
        reach = AROUND_CHARS + len(candidate)
        before = text[max(0, start - reach) : start].replace(candidate, blank)[-AROUND_CHARS:]
        after = text[end : end + reach].replace(candidate, blank)[:AROUND_CHARS]
        return self.bits(before + candidate + after, len(before), len(before) + len(candidate))


def _novel(text: str, start: int, end: int, novelty: Novelty, min_bits: float) -> bool:
    # Letters alone, or digits alone, are words and numbers, not keys.
    keyed = ALPHABET.search(text, start, end) and DIGIT.search(text, start, end)
    return bool(keyed) and novelty.bits_once(text, start, end) >= min_bits


def _joined(spans: list[tuple[int, int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of spans sorted by start, those that overlap as one."""
    starts: list[int] = []
    ends: list[int] = []
    for start, _, end in spans:
        if ends and start < ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return starts, ends


def novel_spans(text: str, novelty: Novelty, taken: list[tuple[int, int, int]], min_bits: float) -> list[tuple[int, int, int]]:
    """Candidates outside the base spans (sorted) that the compressor cannot explain."""
    spans = []
    starts, ends = _joined(taken)
    judged: dict[tuple[str, str, str], bool] = {}
    for start, end in sensitive_places(text):
        last = bisect_left(starts, end) - 1
        if last >= 0 and ends[last] > start:
            continue
        for part in re.finditer(PART, text[start:end]):
            s, e = start + part.start(), start + part.end()
            # The same part in the same surroundings is compressed once.
            own = text[max(0, s - AROUND_CHARS) : s], part[0], text[e : e + AROUND_CHARS]
            if own not in judged:
                judged[own] = _novel(text, s, e, novelty, min_bits)
            if judged[own]:
                spans.append((start, 3, end))
                break
    return spans


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _text_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for batch in batches:
        yield batch, [t or "" for t in batch.column("text").to_pylist()]


def identifier_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of identifiers near sensitive words, over whole texts of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in _text_batches(batches):
            counts: Counter[str] = Counter()
            for text in texts:
                before = -1
                for m in sensitive_words(text):
                    # Sensitive words end to end are one place.
                    before, adjoins = m.end(), m.start() == before
                    if adjoins:
                        continue
                    near = text[max(0, m.start() - NEAR_CHARS) : m.end() + NEAR_CHARS]
                    counts.update(set(re.findall(IDENTIFIER, near)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
            )

    found = docs.select("text").mapInArrow(run, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def identifiers(docs: DataFrame, size: int = 2048, least: int = 3) -> list[str]:
    """The ``size`` commonest identifiers near sensitive words; those of few places may be secrets."""
    rows = identifier_counts(docs).where(F.col("n") >= least).orderBy(F.desc("n"), "word").limit(size).collect()
    return [r["word"] for r in rows]


SPANS = (
    "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, n_novel bigint, base_sha256 string, spans string"
)


def find_secrets(
    docs: DataFrame, *, dictionary_words: int = 2048, min_bits: float = MIN_BITS, known: list[str] | None = None
) -> DataFrame:
    """One row per document: counts per kind, a digest of the base spans, and all spans.

    Base spans are those of ``BASE``. A candidate is a string of ``LEAST_CHARS`` characters or more,
    with further parts after dots, that begins within ``NEAR_CHARS`` characters after a sensitive word or the
    separator behind it. Beyond base spans it is ``novel`` if one of its parts has both a letter and a digit and, with the corpus' identifiers, code words and its own surroundings as a dictionary,
    zstandard still needs ``min_bits`` bits for each of its characters. Spans are in code
    points, ends exclusive. Null and empty texts have none; null ids stay; repeated rows give
    repeated results.
    """
    words = identifiers(docs, dictionary_words) if known is None else known

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(words)
        for batch, texts in _text_batches(batches):
            counts, digests, spans = [], [], []
            for text in texts:
                base = base_spans(text)
                more = novel_spans(text, novelty, base, min_bits)
                tally = Counter(k for _, k, _ in base)
                counts.append((tally[0], tally[1], tally[2], len(more)))
                digests.append(hashlib.sha256(written(base).encode()).hexdigest())
                spans.append(written(sorted(base + more)))
            columns = [pa.array([c[i] for c in counts], pa.int64()) for i in range(4)]
            columns = [batch.column("doc_id"), *columns, pa.array(digests, pa.string()), pa.array(spans, pa.string())]
            names = ["doc_id", "n_assign", "n_access", "n_hex", "n_novel", "base_sha256", "spans"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, SPANS)


def redact(docs: DataFrame, *, mark: str = "[secret]", min_bits: float = MIN_BITS, dictionary_words: int = 2048) -> DataFrame:
    """``docs`` with every span found replaced by ``mark``; overlapping spans become one.

    All rows and columns stay; only texts with a span change. ``n_chars``, where there is one,
    follows the text. Null and empty texts stay as they are, repeated rows change alike, and an
    empty table stays empty.
    """
    words = identifiers(docs, dictionary_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(words)
        at = None
        for batch in batches:
            at = batch.schema.get_field_index("text") if at is None else at
            texts = batch.column(at).to_pylist()
            for i, text in enumerate(texts):
                if text:
                    base = base_spans(text)
                    spans = sorted(base + novel_spans(text, novelty, base, min_bits))
                    if spans:
                        texts[i] = _replaced(text, spans, mark)
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return out


def _replaced(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    out, done = [], 0
    for start, _, end in spans:
        if start >= done:
            out += [text[done:start], mark]
        done = max(done, end)
    return "".join([*out, text[done:]])


ship_by_value(__name__)
