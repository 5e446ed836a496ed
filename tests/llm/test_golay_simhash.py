import numpy as np
import pytest

from pairloom.llm.components import components
from pairloom.llm.golay import LENGTH, error_patterns, near_codewords, syndromes
from pairloom.llm.golay_simhash import (
    _linked, fingerprint, fingerprint_links, hex_fingerprint, keys_of, near_duplicates, one_of_each,
)
from tests.llm import brute


def test_code_is_perfect():
    table = error_patterns()
    weights = np.bitwise_count(table)
    assert (weights[:, 0] <= 3).all() and sorted(np.unique(syndromes(table[:, 0]))) == list(range(2048))
    assert ((table[:, 1:] > 0).sum(axis=1)[weights[:, 0] == 3] == 5).all()


def test_one_error_meets():
    words, table = np.random.default_rng(1).integers(0, 1 << LENGTH, 2000), error_patterns()
    near = near_codewords(words, table)
    for bit in range(LENGTH):
        assert (near_codewords(words ^ (1 << bit), table) == near[:, :1]).any(axis=1).all()


def test_all_pairs_within_three_bits_share_a_key():
    rng, table = np.random.default_rng(2), error_patterns()
    a = rng.integers(-(2**63), 2**63 - 1, 500)
    masks = [sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 4), replace=False)) for _ in a]
    b = (a.view(np.uint64) ^ np.array(masks, np.uint64)).view(np.int64)

    def keys(values, asks):
        out = [set() for _ in values]
        for key, rows, kind in keys_of(values, table):
            for k, r in zip(key.tolist(), rows.tolist()) if kind == asks else ():
                out[r].add(k)
        return out

    assert all(x & y for x, y in zip(keys(a, False), keys(b, True)))


@pytest.mark.parametrize("text", ["", "a", "a b", "A b C d", "x " * 70_000, "é à è", None])
def test_fingerprint(text):
    assert fingerprint((text or "").encode()) % 2**64 == brute.fingerprint(text)


def test_near_duplicates_match_brute_force(make_docs, corpus):
    docs = make_docs(corpus, extra=", fp int")
    got = {r[0]: (r[1], r[2]) for r in near_duplicates(docs).select("doc_id", hex_fingerprint(), "component_id").collect()}
    prints = {i: brute.fingerprint(t) for i, t in corpus}
    label = brute.classes(prints)
    assert got == {i: (f"{prints[i]:016x}", label[i]) for i in prints}
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r[0] for r in kept.collect()) == sorted(set(label.values()))


def test_null_ids_and_repeated_rows(make_docs):
    rows = [(5, "a b c d"), (5, "a b c d"), (None, "a b c d"), (None, "q r s t u"), (None, "q r s t u")]
    got = sorted(near_duplicates(make_docs(rows)).select("doc_id", "component_id").collect(), key=str)
    assert [tuple(r) for r in got] == [(5, 5), (5, 5), (None, 5), (None, None), (None, None)]
    kept = sorted((r[0] is None, r[1]) for r in one_of_each(make_docs(rows)).select("doc_id", "text").collect())
    assert kept == [(False, "a b c d"), (True, "a b c d"), (True, "q r s t u")]
    assert near_duplicates(make_docs([])).count() == 0


def test_blocks_of_large_groups_lose_no_link(spark):
    """Many fingerprints around one: with blocks of four every run is cut."""
    rng = np.random.default_rng(4)
    centre = rng.integers(-(2**63), 2**63 - 1, 4)
    prints = {int(c) for c in centre}
    for c in centre:
        for _ in range(60):
            bits = rng.choice(64, rng.integers(1, 7), replace=False)
            prints.add(int((np.int64(c).view(np.uint64) ^ np.uint64(sum(1 << int(b) for b in bits))).view(np.int64)))
    frame = spark.createDataFrame([(p,) for p in sorted(prints)], "fp bigint")
    label = brute.classes({p: p % 2**64 for p in prints})
    for block in (4, 4096):
        roots = {r[0]: r[1] for r in components(fingerprint_links(frame, block)).collect()}
        assert {p: roots.get(p, p) for p in prints} == label


def test_no_quadratic_links_in_one_run():
    import pyarrow as pa

    n = 300
    fps = np.arange(n) % 8 | np.arange(n) << 3
    near = np.unique(fps & 0b111 | (fps >> 3 << 40))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(np.zeros(2 * len(near), np.int64)), pa.array(np.r_[near, near]), pa.array([False] * len(near) + [True] * len(near))],
        ["key", "fp", "asks"],
    )
    assert sum(b.num_rows for b in _linked(iter([batch]), 4096)) < len(near)


def test_components_of_long_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(300)] + [(7000, 7000)]
    got = {r[0]: r[1] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(300)}}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
