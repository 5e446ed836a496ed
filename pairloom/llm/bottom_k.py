"""Near-duplicates by word-shingle Jaccard: bottom-k sketches, inverted lists, exact verification."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.components import components
from pairloom.llm.golay_simhash import Forest
from pairloom.llm.words import utf8
from pairloom.runtime import lookup_join, materialize, measured_bytes, ship_by_value, skewed_join

SHINGLE, PERCENT = 4, 80
# Values a sketch retains, and how many of them at least are keys of inverted lists.
RETAINED, KEYS = 64, 16
# A value that more texts have as a key is common; a text with this many other values is not looked up by common ones.
COMMON_TEXTS, RARE_VALUES = 100, 40
# A pair of similarity 0.8 has an estimate below this less than once in 10**8 times.
LEAST_ESTIMATE = 0.45
# What pads short sketches.
TOP = np.iinfo(np.int64).max
# Rows of an inverted list compared in one task, and members checked against a leader in one.
BLOCK, MEMBERS = 2000, 500


def shingles(text: bytes, size: int = SHINGLE) -> set[bytes]:
    """Distinct shingles of a UTF-8 text; fewer words are one shingle, no words none."""
    words = text.lower().split()
    if len(words) < size:
        return {b" ".join(words)} if words else set()
    return set(map(b" ".join, zip(*(words[i:] for i in range(size)))))


def sketch(found: set[bytes], retained: int = RETAINED) -> np.ndarray:
    """The smallest hashes of a set in ascending order, as signed numbers."""
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found)).view(np.int64)
    return np.sort(np.partition(h, retained)[:retained] if len(h) > retained else h)


def similar(a: set[bytes], b: set[bytes], percent: int = PERCENT) -> bool:
    common = len(a & b)
    return 100 * common >= percent * (len(a) + len(b) - common)


def named(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc_id, text, tid); ``tid`` tells rows of another id or text apart."""
    whole = F.concat_ws(":", F.coalesce(F.col(key).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit("")))
    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.unhex(F.md5(whole)).alias("tid"))


def sketches(rows: DataFrame, size: int) -> DataFrame:
    """(doc_id, tid, digest, n_shingles, sketch, at); ``digest`` is of the words, null without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, counts, found = [], [], []
            for body in utf8(batch, "text"):
                parts = shingles(body, size)
                digests.append(blake2b(b" ".join(body.lower().split()), digest_size=16).digest() if parts else None)
                counts.append(len(parts))
                found.append(sketch(parts))
            columns = [pa.array(digests, pa.binary()), pa.array(counts, pa.int64()), pa.array(found, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("tid"), *columns], ["doc_id", "tid", "digest", "n_shingles", "sketch"]
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, tid binary, digest binary, n_shingles bigint, sketch array<bigint>"
    return rows.mapInArrow(run, schema).withColumn("at", F.monotonically_increasing_id())


def keys_of(texts: DataFrame, percent: int = PERCENT, common_texts: int = COMMON_TEXTS) -> DataFrame:
    """(node, keys): the values in whose inverted lists a text looks for others.

    Values are taken in one order, rare before common, then by hash. A text whose set is retained
    whole is filed under as many as it may miss and be similar, and one more; two such texts share
    a key if they are similar. Others are filed under ``KEYS`` values, and under as many common
    ones unless most of their values are rare; similar texts share none of 16 once in 10**11 times.
    """
    first = texts.select(F.explode(F.slice("sketch", 1, KEYS)).alias("value"))
    counts = first.groupBy("value").agg(F.count("*").alias("n"))
    common = materialize(counts.where(F.col("n") > common_texts).select("value"), "common")
    held = texts.select("node", F.explode("sketch").alias("value")).join(common, "value")
    held = held.groupBy("node").agg(F.sort_array(F.collect_list("value")).alias("common"))
    tiers = texts.select("node", "n_shingles", "sketch").join(held, "node", "left").withColumn(
        "common", F.coalesce("common", F.array().cast("array<bigint>"))
    ).withColumn("rare", F.array_except("sketch", "common"))
    n = F.col("n_shingles")
    whole = n <= RETAINED
    # n - ceil(n * percent / 100) may be missed.
    first = F.when(whole, n - F.floor((n * percent + 99) / 100) + 1).otherwise(KEYS).cast("int")
    also = F.when(~whole & (F.size("rare") < RARE_VALUES), KEYS).otherwise(0)
    keys = F.array_union(F.slice(F.concat("rare", "common"), F.lit(1), first), F.slice("common", F.lit(1), also))
    return tiers.select("node", keys.alias("keys"))


def estimate(a: np.ndarray, sizes: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """Similarity of the sets behind rows of ``a`` and the set behind ``b``, from the union of two sketches.

    Up to the smaller of the two largest retained values both sketches are complete, so what they
    hold there is a uniform sample of the union. Rows are padded with the largest number.
    """
    top = TOP
    limit = np.where(sizes > RETAINED, a[:, -1], top)
    limit = np.minimum(limit, b[-1] if size > RETAINED else top)
    own = (a <= limit[:, None]) & (a != top)
    both = own & (b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a)
    common = both.sum(axis=1)
    other = np.searchsorted(b, limit, "right")
    return common / np.maximum(own.sum(axis=1) + other - common, 1)


def candidates(rows: dict[str, np.ndarray], value: int) -> Iterator[tuple[int, np.ndarray]]:
    """(i, js): rows of a list that may be similar to row i and are not known to be connected with it.

    ``second`` tells two parts of a long list apart; then rows of the first meet those of the second. Of
    the lists that a pair shares only that of its smallest common key counts, so no pair is looked
    at twice.
    """
    second, roots, sizes, keys = rows["second"], rows["root"], rows["n"], rows["keys"]
    two = second.any() and not second.all()
    for i in range(len(sizes)):
        if two and second[i]:
            continue
        rest = np.flatnonzero(second) if two else np.arange(i + 1, len(sizes))
        rest = rest[roots[rest] != roots[i]]
        small, large = np.minimum(sizes[rest], sizes[i]), np.maximum(sizes[rest], sizes[i])
        rest = rest[100 * small >= PERCENT * large]
        if not len(rest):
            continue
        own = rows["sketch"][i][: min(sizes[i], RETAINED)]
        rest = rest[estimate(rows["sketch"][rest], sizes[rest], own, sizes[i]) >= LEAST_ESTIMATE]
        shared = np.isin(keys[rest], keys[i][keys[i] < value])
        rest = rest[~(shared & (keys[rest] < value)).any(axis=1)]
        if len(rest):
            yield i, rest


def _padded(lists: list[np.ndarray], width: int) -> np.ndarray:
    out = np.full((len(lists), width), TOP)
    for row, values in zip(out, lists):
        row[: len(values)] = values
    return out


def _arrays(batch: pa.RecordBatch, name: str) -> list[np.ndarray]:
    column = batch.column(name)
    flat, at = column.flatten().to_numpy(), column.offsets.to_numpy()
    return [flat[s:e] for s, e in zip(at[:-1] - at[0], at[1:] - at[0])]


def _lists_of(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[tuple, dict]]:
    """((value, x, y), columns) of each list, or pair of parts of one, in a sorted partition."""
    held: list[tuple] = []
    last = None

    def whole() -> tuple[tuple, dict]:
        columns = dict(zip([*names, "sketch", "keys"], map(list, zip(*held))))
        columns["sketch"] = _padded(columns["sketch"], RETAINED)
        columns["keys"] = _padded(columns["keys"], 2 * KEYS)
        return last, {c: v if c in ("sketch", "keys", "text") else np.array(v) for c, v in columns.items()}

    for batch in batches:
        keys = zip(*(batch.column(c).to_pylist() for c in ("value", "x", "y")))
        columns = [batch.column(c).to_pylist() for c in names]
        for key, *row in zip(keys, *columns, _arrays(batch, "sketch"), _arrays(batch, "keys")):
            if key != last:
                if len(held) > 1:
                    yield whole()
                held, last = [], key
            held.append(tuple(row))
    if len(held) > 1:
        yield whole()


def _spread(lists: DataFrame, block: int) -> DataFrame:
    """Lists longer than ``block`` cut by a hash of the node, each two parts (x, y) of them side by side."""
    counts = lists.groupBy("value").agg(F.count("*").alias("rows"))
    long = counts.where(F.col("rows") > block).withColumn("parts", F.ceil(F.col("rows") / block).cast("int"))
    long = materialize(long.select("value", "parts"), "long-lists")
    placed = skewed_join(lists, long, "value", salt_by=["node"])
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    others = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda p: F.struct(F.least(p, part).alias("x"), F.greatest(p, part).alias("y"), (p < part).alias("second")),
    )
    alone = F.array(F.struct(F.lit(0).alias("x"), F.lit(0).alias("y"), F.lit(False).alias("second")))
    spread = placed.withColumn("at", F.explode(F.when(F.col("parts").isNull(), alone).otherwise(others)))
    return spread.select("value", "at.x", "at.y", "at.second", "node")


def _sorted_lists(rows: DataFrame) -> DataFrame:
    return rows.repartition("value", "x", "y").sortWithinPartitions("value", "x", "y")


def marked(lists: DataFrame, facts: DataFrame) -> DataFrame:
    """(value, x, y, second, node): rows of lists that have a candidate there; a list gives no more rows than it has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (value, x, y), rows in _lists_of(batches, ["second", "node", "root", "n"]):
            some = np.zeros(len(rows["n"]), bool)
            for i, js in candidates(rows, value):
                some[i] = some[js] = True
            at = np.flatnonzero(some)
            n = len(at)
            columns = [pa.array([v] * n, k) for v, k in ((value, pa.int64()), (x, pa.int32()), (y, pa.int32()))]
            columns += [pa.array(rows["second"][at]), pa.array(rows["node"][at])]
            yield pa.RecordBatch.from_arrays(columns, ["value", "x", "y", "second", "node"])

    known = lists.join(facts, "node")
    return _sorted_lists(known).mapInArrow(run, "value bigint, x int, y int, second boolean, node bigint")


def connected(rows: DataFrame, size: int, percent: int = PERCENT) -> DataFrame:
    """(a, b): verified links between the roots of candidates, as many as connect what a list connects.

    Hashes of whole sets decide who is compared by shingles; each text is cut once a list.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (value, _, _), rows in _lists_of(batches, ["second", "root", "n", "text"]):
            texts = [(t or "").encode() for t in rows["text"]]
            sets: dict[int, np.ndarray] = {}
            forest, found = Forest(), []

            def hashes(i: int) -> np.ndarray:
                if i not in sets:
                    sets[i] = sketch(shingles(texts[i], size), 1 << 62)
                return sets[i]

            for i, js in candidates(rows, value):
                own = hashes(i)
                for j in js.tolist():
                    a, b = int(rows["root"][i]), int(rows["root"][j])
                    if forest.root(a) == forest.root(b):
                        continue
                    other = hashes(j)
                    common = len(np.intersect1d(own, other, assume_unique=True))
                    if 100 * common < percent * (len(own) + len(other) - common) - 100:
                        continue
                    if similar(shingles(texts[i], size), shingles(texts[j], size), percent) and forest.link(a, b):
                        found.append((a, b))
            columns = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])

    return _sorted_lists(rows).mapInArrow(run, "a bigint, b bigint").distinct()


def verified(pairs: DataFrame, rows: DataFrame, texts: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The (a, b) rows whose whole shingle sets are similar.

    Only texts of these pairs are moved. The text of ``b`` goes to ``a``, spread by a hash so that a text with very many partners is copied to several tasks; each task holds the
    shingles of one ``a``.
    """
    pairs = materialize(pairs, "pairs")
    bodies = _bodies(pairs.select(F.explode(F.array("a", "b")).alias("node")), rows, texts)
    counts = pairs.groupBy("a").agg(F.count("*").alias("rows"))
    many = counts.where(F.col("rows") > MEMBERS).select("a", F.ceil(F.col("rows") / MEMBERS).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("b"), F.coalesce("parts", F.lit(1))).cast("int").alias("part")
    placed = materialize(skewed_join(pairs, many, "a", salt_by=["b"]).select("a", "b", part), "placed")
    text = bodies.withColumnRenamed("node", "b")
    members = skewed_join(placed, text, "b", salt_by=["a"]).select("a", "part", "b", "text")
    heads = placed.select("a", "part").distinct().join(bodies.withColumnRenamed("node", "a"), "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head: set[bytes] = set()
        for batch in batches:
            rows = zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), utf8(batch, "text"))
            kept = []
            for a, b, body in rows:
                found = shingles(body, size)
                if b is None:
                    head = found
                elif similar(head, found, percent):
                    kept.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*kept) if kept else ((), ()))], ["a", "b"])

    laid = heads.select("a", "part", F.lit(None).cast("bigint").alias("b"), "text").unionByName(members)
    placed = laid.repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
    return placed.mapInArrow(run, "a bigint, b bigint")


def _estimated(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs whose union sketch and sizes let them be similar."""
    def side(name: str) -> DataFrame:
        return texts.select(F.col("node").alias(name), F.col("n_shingles").alias(f"n_{name}"), F.col("sketch").alias(f"s_{name}"))

    both = skewed_join(skewed_join(pairs, side("a"), "a", salt_by=["b"]), side("b"), "b", salt_by=["a"])

    def limit(name: str):
        return F.when(F.col(f"n_{name}") > RETAINED, F.element_at(f"s_{name}", -1)).otherwise(F.lit(int(TOP)))

    sized = both.where(100 * F.least("n_a", "n_b") >= PERCENT * F.greatest("n_a", "n_b")).withColumn("limit", F.least(limit("a"), limit("b")))
    common = F.size(F.array_intersect("s_a", "s_b"))
    below = [F.size(F.filter(f"s_{c}", lambda x: x <= F.col("limit"))) for c in "ab"]
    return sized.where(common >= LEAST_ESTIMATE * (below[0] + below[1] - common)).select("a", "b")


def _bodies(nodes: DataFrame, rows: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, text) of some nodes, from the row that stands for each; other texts are not moved while the nodes fit a broadcast."""
    needed = materialize(texts.select("node", "tid").join(nodes.distinct(), "node"), "needed")
    found = lookup_join(
        rows.select("tid", "text"), needed, ["tid"], size=measured_bytes(needed, fixed=64), salt_by=["text"], how="inner"
    )
    # Rows may repeat.
    return materialize(found.groupBy("node").agg(F.first("text").alias("text")), "bodies")


def classes(
    texts: DataFrame, rows: DataFrame, size: int = SHINGLE, common_texts: int = COMMON_TEXTS, block: int = BLOCK
) -> DataFrame:
    """(node, root) of nodes that similar texts connect, directly or through others.

    First each list's texts are compared with the text of the list that shares most of its keys
    with others, as an original does with its copies; that connects most groups with no more rows
    than the lists have. Then lists that hold texts not yet connected compare those with each
    other: every pair that shares a list is either connected, or estimated, and what may be
    similar meets by its text in that list. What that verifies connects the first classes.
    """
    keyed = materialize(keys_of(texts, common_texts=common_texts), "keys")
    lists = materialize(keyed.select("node", F.explode("keys").alias("value")), "lists")
    shared = lists.groupBy("value").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    several = materialize(skewed_join(lists, shared, "value", salt_by=["node"], how="inner").drop("n"), "shared-lists")
    weight = several.groupBy("node").agg(F.count("*").alias("weight"))
    heads = several.join(weight, "node").groupBy("value").agg(F.max_by("node", F.struct("weight", "node")).alias("head"))
    stars = skewed_join(several, heads, "value", salt_by=["node"]).where(F.col("head") != F.col("node"))
    stars = stars.select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()
    roots = components(verified(_estimated(stars, texts), rows, texts, size))

    rooted = several.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = materialize(rooted, "rooted")
    spans = rooted.groupBy("value").agg(F.min("root").alias("x"), F.max("root").alias("y")).where(F.col("x") != F.col("y"))
    opened = skewed_join(rooted, spans.select("value"), "value", salt_by=["node"], how="inner")
    opened = materialize(_spread(opened.select("value", "node"), block), "open-lists")
    facts = texts.select("node", F.col("n_shingles").alias("n"), "sketch").join(keyed, "node").join(
        rooted.select("node", "root").distinct(), "node"
    )
    facts = materialize(facts.join(opened.select("node").distinct(), "node"), "facts")
    rest = materialize(marked(opened, facts), "rest")
    if rest.isEmpty():
        return roots
    bodies = _bodies(rest.select("node"), rows, texts)
    more = connected(rest.join(facts, "node").join(bodies, "node"), size)
    joined = components(more)
    tops = joined.select(F.col("node").alias("root"), F.col("root").alias("top"))
    known = texts.select("node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    return skewed_join(known, tops, "root", salt_by=["node"]).select("node", F.coalesce("top", "root").alias("root"))


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, common_texts: int = COMMON_TEXTS,
    block: int = BLOCK,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row.

    Texts link if their sets of ``size``-word shingles, A-Z in lower case, have a Jaccard similarity
    of 0.8 or more; ``component_id`` is the smallest id reachable, and the row that bears it is
    kept. Copies are one node and meet once. Without words, or with a null text, a row is empty,
    linked with nothing and its own component. A row without an id takes part but cannot name its
    class: a class of such rows only has component_id null, and rows without an id are not kept.
    Repeated rows give repeated result rows, an empty table none; other columns are ignored.
    """
    rows = named(docs, key, text)
    found = materialize(sketches(rows, size), "sketches")
    # The first row of equal texts stands for them, and its place names the node.
    texts = found.where(F.col("digest").isNotNull()).groupBy("digest").agg(
        F.min(F.struct("at", "tid")).alias("own"), F.min("doc_id").alias("first"), F.first("n_shingles").alias("n_shingles"),
        F.first("sketch").alias("sketch"),
    )
    texts = materialize(texts.select("digest", "own.tid", F.col("own.at").alias("node"), "first", "n_shingles", "sketch"), "texts")
    roots = classes(texts, rows, size, common_texts, block)
    placed = texts.select("digest", "node", "first").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = materialize(placed, "placed")
    names = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    known = skewed_join(placed.select("digest", "root"), names, "root", salt_by=["digest"]).drop("root")
    whole = skewed_join(found.select("doc_id", "digest", "n_shingles"), known, "digest", salt_by=["doc_id"])
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return whole.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept")
    )


ship_by_value(__name__)
