"""License scan by patience alignment with license templates."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.words import utf8
from pairloom.runtime import ship_by_value

# Notices and permission texts, by license.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied.")),
    ("MIT", "Released under the MIT License."),
    ("MIT", (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions")),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version.")),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.")),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("BSD", (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met")),
)
# Words that say nothing about where a notice may stand.
COMMON = frozenset(
    b"a an and any are as at be by for from in is it of on or that the this to under was were with you".split()
)
PUNCTUATION = b".,;:!?\"'()[]{}<>|*#"
# Words that an alignment may skip between two anchors beyond twice the template's own gap.
SLACK = 8


def tokens(text: bytes) -> list[bytes]:
    return [w for w in (word.strip(PUNCTUATION) for word in text.lower().split()) if w]


def longest_increasing(values: list[int]) -> list[int]:
    """Places of a longest strictly increasing subsequence."""
    tails: list[int] = []
    ends: list[int] = []
    back: list[int] = []
    for i, value in enumerate(values):
        at = bisect_left(tails, value)
        back.append(ends[at - 1] if at else -1)
        if at == len(tails):
            tails.append(value)
            ends.append(i)
        else:
            tails[at], ends[at] = value, i
    out = []
    at = ends[-1] if ends else -1
    while at >= 0:
        out.append(at)
        at = back[at]
    return out[::-1]


def align(template: list[bytes], text: list[bytes]) -> list[tuple[int, int]]:
    """Pairs of places of equal words, both increasing.

    Equal beginnings and ends are matched; then words that occur once in both are anchors, of
    which a longest increasing chain is kept, and the gaps between them are aligned likewise.
    """
    pairs: list[tuple[int, int]] = []
    # Gaps wait in a list instead of on the call stack.
    gaps = [(0, len(template), 0, len(text))]
    while gaps:
        a, b, c, d = gaps.pop()
        while a < b and c < d and template[a] == text[c]:
            pairs.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and template[b - 1] == text[d - 1]:
            b, d = b - 1, d - 1
            pairs.append((b, d))
        if a >= b or c >= d:
            continue
        once = {w for w, n in Counter(template[a:b]).items() if n == 1}
        counts = Counter(w for w in text[c:d] if w in once)
        place = {w: i for i, w in enumerate(text[c:d], start=c) if counts.get(w) == 1}
        anchors = [(i, place[template[i]]) for i in range(a, b) if template[i] in place]
        kept = [anchors[i] for i in longest_increasing([j for _, j in anchors])]
        if not kept:
            continue
        pairs += kept
        for (i, j), (k, m) in zip([(a - 1, c - 1), *kept], [*kept, (b, d)]):
            gaps.append((i + 1, k, j + 1, m))
    return sorted(pairs)


def densest(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest part of an alignment without a jump in the text far beyond the template's."""
    best: list[tuple[int, int]] = []
    part: list[tuple[int, int]] = []
    for pair in pairs:
        if part and pair[1] - part[-1][1] > 2 * (pair[0] - part[-1][0]) + SLACK:
            part = []
        part = [*part, pair]
        if len(part) > len(best):
            best = part
    return best


@dataclass
class Template:
    name: str
    words: list[bytes]
    keys: frozenset
    place: dict[bytes, int]  # of words that the template holds once

    @classmethod
    def make(cls, name: str, text: str) -> Template:
        words = tokens(text.encode())
        place = {w: i for i, w in enumerate(words) if words.count(w) == 1}
        return cls(name, words, frozenset(words) - COMMON or frozenset(words), place)


def regions(hits: list[int], keys_at: list[bytes], template: Template) -> Iterator[tuple[int, int]]:
    """Ranges of words around clusters that hold half of the template's own words at least."""
    size = len(template.words)
    start = 0
    for i in range(1, len(hits) + 1):
        if i == len(hits) or hits[i] - hits[i - 1] > size + SLACK or hits[i] - hits[start] > 4 * size + SLACK:
            if 2 * len(set(keys_at[start:i])) >= len(template.keys):
                yield max(0, hits[start] - size - SLACK), hits[i - 1] + size + SLACK
            # A cluster that is cut for its length goes on from its middle, so no copy is split.
            full = i < len(hits) and hits[i] - hits[i - 1] <= size + SLACK
            start = next((j for j in range(start + 1, i) if hits[j] - hits[start] > 2 * size), i) if full else i


def repeats(words: list[bytes], start: int, end: int, template: Template) -> Iterator[tuple[int, int]]:
    """Ranges of one copy each, for a region that may hold several.

    Words of two copies are not unique in a region and anchor nothing there. But each word that
    the template holds once says where a copy around it would start, and the words of one copy
    agree on that within the words that it has more or less.
    """
    place, size = template.place, len(template.words)
    start, end = max(0, start), min(end, len(words))
    said = sorted(i - place[words[i]] for i in range(start, end) if words[i] in place)
    drift = SLACK + size // 4
    for d in sorted(set(said)):
        agree = bisect_right(said, d + drift) - bisect_left(said, d - drift)
        if 2 * agree >= len(place):
            yield max(0, d), d + size
            yield max(0, d - SLACK), d + size + drift


def several(words: list[bytes], start: int, end: int, template: Template) -> bool:
    """Whether half of the words that the template holds once stand in a region twice or more."""
    counts = Counter(w for w in words[max(0, start) : end] if w in template.place)
    return 2 * sum(n > 1 for n in counts.values()) >= len(template.place) > 0


def apart(found: list[tuple[str, float, int, int, int]]) -> list[tuple[str, float, int, int, int]]:
    """Those that overlap none before them."""
    starts: list[int] = []
    chosen: list[tuple[str, float, int, int, int]] = []
    for one in found:
        at = bisect_left(starts, one[3])
        if (at == 0 or chosen[at - 1][4] <= one[3]) and (at == len(chosen) or one[4] <= chosen[at][3]):
            starts.insert(at, one[3])
            chosen.insert(at, one)
    return chosen


def licenses_of(words: list[bytes], templates: list[Template], least: float) -> list[tuple[str, float, int, int, int]]:
    """(license, coverage, words matched, first word, end) of the notices in a text, best first, not
    overlapping."""
    every = frozenset().union(*(t.keys for t in templates)) if templates else frozenset()
    hits = [i for i, w in enumerate(words) if w in every]
    found = []
    for template in templates if hits else ():
        own = [i for i in hits if words[i] in template.keys]
        ranges = []
        for start, end in regions(own, [words[i] for i in own], template):
            ranges.append((start, end))
            if several(words, start, end, template):
                ranges += repeats(words, start, end, template)
        copies = set()
        for start, end in dict.fromkeys(ranges):
            pairs = densest(align(template.words, words[start:end]))
            coverage = len(pairs) / len(template.words)
            if coverage >= least:
                copies.add((template.name, coverage, len(pairs), start + pairs[0][1], start + pairs[-1][1] + 1))
        # Parts of two copies may align better than either, over a longer stretch.
        found += apart(sorted(copies, key=lambda f: (f[4] - f[3] - 2 * f[2], f[3])))
    # A long template that is covered says more than a short one inside it.
    return sorted(apart(sorted(found, key=lambda f: (-f[2], -f[1], f[3], f[0]))), key=lambda f: f[3])


LICENSES = "doc_id bigint, license string, coverage double, n_matched bigint, start_word bigint, end_word bigint"


def find_licenses(docs: DataFrame, *, templates=TEMPLATES, coverage: float = 0.8) -> DataFrame:
    """One row per notice: (doc_id, license, coverage, n_matched, start_word, end_word).

    Words are compared without case of A-Z and without punctuation around them; places count
    such words. A template is found where an alignment covers ``coverage`` of its words within
    a stretch about as long as itself; each copy in a text is found. Null and empty texts have
    none; null ids stay; repeated rows are reported alike.
    """
    made = [Template.make(name, text) for name, text in templates]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), utf8(batch, "text")):
                rows += [(doc, *found) for found in licenses_of(tokens(text), made, coverage)]
            columns = list(zip(*rows)) if rows else [()] * 6
            kinds = [pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
            names = [f.split()[0] for f in LICENSES.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, LICENSES)


ship_by_value(__name__)
