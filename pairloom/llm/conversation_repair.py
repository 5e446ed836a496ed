"""Conversations brought back to alternating turns at least cost, by depth-first branch and bound."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.operators.index import with_index
from pairloom.runtime import materialize, measured_bytes, lookup_join, ship_by_value

# What may come next: anything; a user after the system turn; the assistant; a user or the end.
START, LED, ANSWER, ASK = range(4)
DONE = frozenset((START, ASK))
STATES = (START, LED, ANSWER, ASK)
KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1
NEVER = 1 << 60
SPACE = " \t\n\x0b\x0c\r"
# A conversation beyond either is repaired in segments by many tasks.
WHOLE_ROWS, WHOLE_BYTES = 50_000, 32 << 20
SEGMENT_ROWS = 500
LEGAL = frozenset(("su", "ua", "au"))

# A turn as the search sees it: kept initial (s, u, a or another), must go, costs one more if it stays.
Turn = tuple[str, bool, bool]


def _spoken(state: int) -> int:
    """The state after a user or assistant turn, whichever is due."""
    return ASK if state == ANSWER else ANSWER


def _kept(state: int, initial: str) -> int | None:
    if initial == "s":
        return LED if state == START else None
    if initial == ("a" if state == ANSWER else "u"):
        return _spoken(state)
    return None


def _bounds(turns: list[Turn], ends: frozenset[int]) -> list[tuple[int, ...]]:
    """For every suffix and state a cost that no repair of the suffix undercuts.

    The suffix is relaxed: a system turn may stand without an exchange after it, so LED counts
    as ASK.
    """
    loose = ends | ({ASK} if LED in ends else set()) | ({LED} if ASK in ends else set())
    row = [0 if s in loose else NEVER for s in STATES]
    after = tuple(min(row[s], INSERT + row[_spoken(s)]) for s in STATES)
    out = [after]
    for initial, gone, cut in reversed(turns):
        row = []
        for s in STATES:
            best = DELETE + after[s]
            if not gone:
                best = min(best, REROLE + cut + after[_spoken(s)])
                if (to := _kept(s, initial)) is not None:
                    best = min(best, cut + after[ASK if to == LED else to])
            row.append(best)
        after = tuple(min(row[s], INSERT + row[_spoken(s)]) for s in STATES)
        out.append(after)
    out.reverse()
    return out


def cheapest(turns: list[Turn], start: int = START, ends: frozenset[int] = DONE) -> tuple[int, str] | None:
    """(cost, audit) of the cheapest edits that lead from ``start`` to one of ``ends``; of equal
    costs the least audit. None if no edits do.

    Two depth-first searches over (turn, state, inserted before it) with an explicit stack. The
    first follows the smallest bound and ends at the first whole repair, the incumbent. The second
    visits audits in ASCII order, so what reaches a node later must be cheaper, and a whole repair
    must be cheaper than the incumbent, or as cheap if it is the first of this search. Both leave
    out prefixes whose cost and suffix bound exceed the incumbent. At most one turn is inserted at
    a place: two there cost more than any repair without them.
    """
    if LED in ends and start != LED and not any(i == "s" and not gone for i, gone, _ in turns):
        ends -= {LED}
    bounds, n = _bounds(turns, ends), len(turns)
    if bounds[0][start] >= NEVER:
        return None
    incumbent: tuple[int, object] | None = None
    for ordered in (False, True):
        seen: dict[tuple[int, int, bool], int] = {}
        limit = NEVER if incumbent is None else incumbent[0]
        stack = [(0, start, False, 0, None)]
        while stack:
            at, state, inserted, cost, audit = stack.pop()
            if cost + bounds[at][state] > limit:
                continue
            if seen.get((at, state, False), NEVER) <= cost or (inserted and seen.get((at, state, True), NEVER) <= cost):
                continue
            seen[at, state, inserted] = cost
            if at == n and state in ends:
                incumbent = cost, audit
                limit = cost - 1
                if not ordered:
                    break
                continue
            steps = []
            if at < n:
                initial, gone, cut = turns[at]
                steps.append((at + 1, state, False, cost + DELETE, (audit, "D")))
            if not inserted:
                steps.append((at, _spoken(state), True, cost + INSERT, (audit, "I")))
            if at < n and not gone:
                if (to := _kept(state, initial)) is not None:
                    steps.append((at + 1, to, False, cost + KEEP + cut, (audit, "K")))
                steps.append((at + 1, _spoken(state), False, cost + REROLE + cut, (audit, "R")))
            if not ordered:
                steps.sort(key=lambda s: s[3] + bounds[s[0]][s[1]])
            stack.extend(reversed(steps))
        if incumbent is None:
            return None
    letters, link = [], incumbent[1]
    while link is not None:
        link, letter = link
        letters.append(letter)
    return incumbent[0], "".join(reversed(letters))


def repaired(rows: list[tuple[str, str]], audit: str, start: int = START) -> list[str]:
    """``role:text`` of the turns that an audit leaves of (role, text) rows."""
    out, at, state = [], 0, start
    for letter in audit:
        due = "assistant" if state == ANSWER else "user"
        if letter == "I":
            out.append(f"{due}:")
        elif letter != "D":
            role, text = rows[at]
            out.append(f"{role if letter == 'K' else due}:{text}")
        at += letter != "I"
        if letter == "K" and rows[at - 1][0][:1] == "s":
            state = LED
        elif letter != "D":
            state = _spoken(state)
    return out


def _ends(text: str) -> tuple[bool, bool]:
    """Is a text blank; does it stop without a sentence end."""
    bare = text.rstrip(SPACE)
    return not bare, bare[-1:] not in (".", "!", "?")


def _judged(rows: list[tuple[str, str]], again: list[bool]) -> tuple[list[Turn], tuple[int, int, int, int]]:
    """Turns for the search, and counts of blank, duplicate, truncated and illegal."""
    turns, blanks, copies, cuts = [], 0, 0, 0
    for (role, text), copy in zip(rows, again):
        blank, cut = _ends(text)
        copy, cut = copy and not blank, cut and not blank and not copy
        blanks, copies, cuts = blanks + blank, copies + copy, cuts + cut
        turns.append((role[:1], blank or copy, cut))
    illegal = sum(a[0] + b[0] not in LEGAL for a, b in zip(turns, turns[1:]))
    return turns, (blanks, copies, cuts, illegal)


def _seen_before(rows: list[tuple[str, str]]) -> list[bool]:
    seen: set[tuple[str, str]] = set()
    out = []
    for row in rows:
        out.append(row in seen)
        seen.add(row)
    return out


def gaps(turns: list[int]) -> int:
    return max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0


def damaged(conversations: DataFrame, key: str = "conv_id") -> DataFrame:
    """(key, turn, role, text, gone) with faults put in by crc32 of ``key:turn`` modulo 20.

    0 drops the row (it stays, marked ``gone``, so that no conversation is lost), 1 empties its
    text, 2 takes ``.!?`` out of it, 3 repeats it, 4 makes its role ``user``. A null is one space
    in the hash, the role and the text; the key and the turn themselves stay null.
    """
    def name(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    act = F.crc32(F.concat(name(key), F.lit(":"), name("turn"))) % 20
    text = name("text")
    return conversations.select(
        F.col(key),
        F.col("turn").cast("bigint").alias("turn"),
        F.when(act == 4, "user").otherwise(name("role")).alias("role"),
        F.when(act.isin(0, 1), "").when(act == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (act == 0).alias("gone"),
        F.explode(F.when(act == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


RESULT = (
    "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, "
    "repaired_sha256 string"
)


def _runs(batches: Iterator[pa.RecordBatch], names: list[str], width: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows of each run of equal first ``width`` columns in a sorted partition."""
    held_key, held = None, []
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in names]
        for key, rows in groupby(zip(*columns), key=lambda r: r[:width]):
            if held and key != held_key:
                yield held_key, held
                held = []
            held_key = key
            held.extend(r[width:] for r in rows)
    if held:
        yield held_key, held


def _whole(rows: DataFrame, key: str) -> DataFrame:
    """Repairs of conversations that fit a task."""
    kind = rows.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        out = []

        def table() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

        def read(source):
            nonlocal schema
            for batch in source:
                if schema is None:
                    long, string = pa.int64(), pa.string()
                    kinds = [batch.schema.field(key).type, *[long] * 6, string, string]
                    names = [key, *(c.split()[0] for c in RESULT.split(", "))]
                    schema = pa.schema(list(zip(names, kinds)))
                yield batch

        for (name,), held in _runs(read(batches), [key, "gone", "turn", "role", "text"], 1):
            held = [r[1:] for r in held if not r[0]]
            said = [(role, text) for _, role, text in held]
            turns, counts = _judged(said, _seen_before(said))
            cost, audit = cheapest(turns)
            digest = hashlib.sha256("\n".join(repaired(said, audit)).encode()).hexdigest()
            out.append((name, gaps([t for t, _, _ in held if t is not None]), *counts, cost, audit, digest))
            if len(out) == 5000:
                yield table()
                out = []
        if out:
            yield table()

    placed = rows.repartition(key).sortWithinPartitions(key, "turn", "role", "text")
    return placed.mapInArrow(run, f"`{key}` {kind.simpleString()}, {RESULT}")


def _order(audits: list[str]) -> list[str]:
    """Short strings that compare as the audits do, whatever is appended to both."""
    places: set[int] = set()
    for i, a in enumerate(audits):
        for b in audits[:i]:
            same = len(os.path.commonprefix((a, b)))
            places.update(range(same, max(len(a), len(b))) if same == min(len(a), len(b)) else (same,))
    return ["".join(a[p] for p in sorted(places) if p < len(a)) for a in audits]


def _null_safe_join(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    """Inner join on keys that may be null."""
    for k in keys:
        right = right.withColumnRenamed(k, f"_{k}")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return left.join(right, same).drop(*(f"_{k}" for k in keys))


def _segmented(rows: DataFrame, key: str, segment_rows: int) -> DataFrame:
    """Repairs of conversations too large for a task.

    Rows are numbered by a range sort and cut into segments. Each segment is searched for every
    state it can begin and end in; choosing among these sums, segment after segment, is exact,
    since equal costs and equal turns leave no audit a prefix of another. Only one digest per
    conversation is sequential, over finished pieces of text.
    """
    kind = rows.schema[key].dataType.simpleString()
    stay = rows.where(~F.col("gone")).drop("gone").withColumn("_tie", F.monotonically_increasing_id())
    indexed = with_index(stay, key, "turn", "role", "text", "_tie").drop("_tie")
    starts = indexed.groupBy(key).agg(F.min("idx").alias("_start"))
    starts = materialize(starts.select(F.struct(key).alias("_key"), "_start"), "starts")
    named = lookup_join(
        indexed.withColumn("_key", F.struct(key)), starts, ["_key"], size=measured_bytes(starts, fixed=64), salt_by=["idx"]
    ).drop("_key")
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    firsts = indexed.groupBy(key, said).agg(F.min("idx").alias("idx")).select("idx", F.lit(False).alias("again"))
    cut = (
        named.withColumn("seg", F.floor((F.col("idx") - F.col("_start")) / segment_rows).cast("bigint"))
        .drop("_start").join(firsts, "idx", "left").withColumn("again", F.coalesce("again", F.lit(True)))
    )
    cut = materialize(cut, "turns")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None

        def read(source):
            nonlocal kind
            for batch in source:
                kind = batch.schema.field(key).type
                yield batch

        for (name, seg), held in _runs(read(batches), [key, "seg", "role", "text", "again"], 2):
            turns, counts = _judged([r[:2] for r in held], [r[2] for r in held])
            ways = []
            for a in STATES:
                for b in STATES:
                    found = cheapest(turns, a, frozenset((b,)))
                    if found:
                        ways.append({"a": a, "b": b, "cost": found[0], "audit": found[1]})
            columns = [name, seg, *counts, turns[0][0], turns[-1][0], ways]
            long, string = pa.int64(), pa.string()
            way = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("cost", long), ("audit", string)]))
            kinds = [kind, *[long] * 5, string, string, way]
            yield pa.RecordBatch.from_arrays(
                [pa.array([c], k) for c, k in zip(columns, kinds)],
                [key, "seg", "blank", "duplicate", "truncated", "illegal", "first", "last", "ways"],
            )

    pieces = cut.repartition(key, "seg").sortWithinPartitions(key, "seg", "idx").mapInArrow(
        search,
        f"`{key}` {kind}, seg bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, first string, "
        "last string, ways array<struct<a:int,b:int,cost:bigint,audit:string>>",
    )
    pieces = materialize(pieces, "segments")

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per segment: where it begins, its audit, and illegal turns at its border."""
        kind = None

        def read(source):
            nonlocal kind
            for batch in source:
                kind = batch.schema.field(key).type
                yield batch

        for (name,), held in _runs(read(batches), [key, "seg", "first", "last", "ways"], 1):
            best = {START: (0, "", None)}  # state -> cost, what orders the audit so far, (state before, audit, before)
            for _, _, _, ways in held:
                after: dict[int, tuple] = {}
                for way in ways:
                    if way["a"] in best:
                        cost, order, link = best[way["a"]]
                        option = cost + way["cost"], order + way["audit"], (way["a"], way["audit"], link)
                        if way["b"] not in after or option[:2] < after[way["b"]][:2]:
                            after[way["b"]] = option
                short = _order([o[1] for o in after.values()])
                best = {s: (cost, at, link) for (s, (cost, _, link)), at in zip(after.items(), short)}
            cost, _, link = min((best[s] for s in DONE if s in best), key=lambda o: o[:2])
            path = []
            while link is not None:
                a, last, link = link
                path.append((a, last))
            path.reverse()
            borders = [0] + [int(x[2] + y[1] not in LEGAL) for x, y in zip(held, held[1:])]
            n = len(held)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * n, kind), pa.array([h[0] for h in held], pa.int64()),
                    pa.array([p[0] for p in path], pa.int32()), pa.array([p[1] for p in path], pa.string()),
                    pa.array(borders, pa.int64()), pa.array([cost] + [0] * (n - 1), pa.int64()),
                ],
                [key, "seg", "a", "audit", "border", "cost"],
            )

    chosen = materialize(
        pieces.repartition(key).sortWithinPartitions(key, "seg").mapInArrow(
            choose, f"`{key}` {kind}, seg bigint, a int, audit string, border bigint, cost bigint"
        ),
        "repairs",
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None

        def read(source):
            nonlocal kind
            for batch in source:
                kind = batch.schema.field(key).type
                yield batch

        for (name, seg), held in _runs(read(batches), [key, "seg", "role", "text", "a", "audit"], 2):
            lines = repaired([r[:2] for r in held], held[0][3], held[0][2])
            text = "\n".join(lines) if lines else None
            yield pa.RecordBatch.from_arrays(
                [pa.array([name], kind), pa.array([seg], pa.int64()), pa.array([text], pa.string())], [key, "seg", "text"]
            )

    marks = chosen.select(key, "seg", "a", "audit")
    lines = _null_safe_join(cut, marks, key, "seg")
    texts = lines.repartition(key, "seg").sortWithinPartitions(key, "seg", "idx").mapInArrow(
        write, f"`{key}` {kind}, seg bigint, text string"
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Piece after piece; a task holds one batch of pieces."""
        name, state, some = None, None, False
        for batch in batches:
            for conv, text in zip(batch.column(key).to_pylist(), batch.column("text").to_pylist()):
                if state is None or conv != name:
                    if state is not None:
                        yield out(batch, name, state)
                    name, state, some = conv, hashlib.sha256(), False
                if text is not None:
                    state.update((("\n" if some else "") + text).encode())
                    some = True
            kept = batch
        if state is not None:
            yield out(kept, name, state)

    def out(batch, name, state):
        return pa.RecordBatch.from_arrays(
            [pa.array([name], batch.schema.field(key).type), pa.array([state.hexdigest()])], [key, "repaired_sha256"]
        )

    hashes = texts.repartition(key).sortWithinPartitions(key, "seg").mapInArrow(
        digest, f"`{key}` {kind}, repaired_sha256 string"
    )
    sums = pieces.groupBy(key).agg(*(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")))
    audits = chosen.groupBy(key).agg(
        F.sum("cost").alias("cost"), F.sum("border").alias("border"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seg", "audit"))), lambda x: x["audit"]), "").alias("audit"),
    )
    spans = cut.select(key, "turn").distinct().groupBy(key).agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps")
    )
    joined = sums
    for other in (audits, hashes, spans):
        joined = _null_safe_join(joined, other, key)
    return joined.select(
        key, "gaps", "blank", "duplicate", "truncated", (F.col("illegal") + F.col("border")).alias("illegal"), "cost", "audit",
        "repaired_sha256",
    )


def repair_conversations(
    rows: DataFrame, key: str = "conv_id", whole_rows: int = WHOLE_ROWS, whole_bytes: int = WHOLE_BYTES,
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """One row per ``key`` of (key, turn, role, text, gone) rows: faults and the cheapest repair.

    Rows stand in the order of turn (nulls first), role and text; equal rows follow each other,
    and all but the first are duplicates. A null key is one conversation, a null role or text
    counts as one space, rows marked ``gone`` only keep their conversation in the result. No rows:
    zeros, an empty audit and the digest of nothing; an empty table gives none. Columns beyond
    these five are ignored.

    Each conversation is searched where its rows meet. One with more than ``whole_rows`` rows or
    ``whole_bytes`` of text is cut into segments of ``segment_rows``, so that no key fills a task;
    both ways give the same result.
    """
    def filled(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(" ")).alias(c)

    rows = rows.select(key, "turn", filled("role"), filled("text"), "gone")
    counts = rows.groupBy(key).agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    big = (F.col("n") > whole_rows) | (F.col("bytes") > whole_bytes)
    large = counts.where(big).select(F.struct(key).alias("_key"), F.lit(True).alias("_large"))
    large = materialize(large, "large")
    if large.isEmpty():
        return _whole(rows, key)
    marked = lookup_join(
        rows.withColumn("_key", F.struct(key)), large, ["_key"], size=measured_bytes(large, fixed=64), salt_by=["turn", "text"]
    ).drop("_key")
    # Rows that are gone only name their conversation; a large one may have no others.
    apart = marked.where(F.col("_large") & ~F.col("gone")).drop("_large")
    rest = marked.where(F.col("_large").isNull() | F.col("gone")).drop("_large")
    cut = materialize(_segmented(apart, key, segment_rows), "large-repairs")
    known = cut.select(F.struct(key).alias("_key"))
    small = _whole(rest, key).withColumn("_key", F.struct(key)).join(known, "_key", "left_anti").drop("_key")
    return small.unionByName(cut)


ship_by_value(__name__)
