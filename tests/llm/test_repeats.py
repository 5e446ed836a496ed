"""Phrase automata and sparse suffixes against brute force."""

import pytest

from pairloom.llm import phrase_automata, sparse_suffixes
from tests.llm import brute


def test_cut_repeats(make_docs, corpus):
    rows = [*corpus, (None, corpus[0][1]), (-4, corpus[5][1])]
    got = phrase_automata.cut_repeats(make_docs(rows, extra=", flags int")).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == brute.cut(rows)
    assert len(got) == len(rows)
    texts = {r.doc_id: r.kept for r in got}
    assert texts[-4] == " ".join(brute.words(corpus[5][1])) and texts[3000] == ""


def test_rows_of_one_id_do_not_count_against_each_other(make_docs, corpus):
    text = corpus[0][1]
    got = phrase_automata.cut_repeats(make_docs([(1, text), (1, text), (2, text)])).collect()
    assert sorted((r.doc_id, r.n_removed > 0) for r in got) == [(1, False), (1, False), (2, True)]
    assert phrase_automata.cut_repeats(make_docs([])).count() == 0


def test_hot_phrases_are_cut_into_windows(make_docs, corpus, monkeypatch):
    monkeypatch.setattr(phrase_automata, "SHARD_ROWS", 1)
    monkeypatch.setattr(phrase_automata, "COMBINE_BYTES", 1)
    rows = [r for r in corpus if r[0] != 3008]
    got = phrase_automata.cut_repeats(make_docs(rows)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == brute.cut(rows)


@pytest.mark.parametrize("shard_rows", [16_000, 1])
def test_colliding_hashes_change_nothing(make_docs, corpus, monkeypatch, shard_rows):
    real = phrase_automata.gram_hashes
    monkeypatch.setattr(phrase_automata, "gram_hashes", lambda hashes, k: real(hashes, k) % 64)
    monkeypatch.setattr(phrase_automata, "SHARD_ROWS", shard_rows)
    rows = [r for r in corpus if r[0] != 3008]
    got = phrase_automata.cut_repeats(make_docs(rows)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == brute.cut(rows)


def test_without_the_automata_nothing_goes(make_docs, corpus, monkeypatch):
    """Each text in a batch of its own, and none with a copy: all that is removed is found by automata."""
    monkeypatch.setattr(phrase_automata, "COMBINE_BYTES", 1)
    monkeypatch.setattr(phrase_automata.Shard, "occurrences", lambda self: iter(()))
    rows = [r for r in corpus if r[0] < 2000]
    got = phrase_automata.cut_repeats(make_docs(rows)).collect()
    assert sum(r.n_removed for r in got) == 0 and sum(n for _, n, _ in brute.cut(rows).values()) > 500


def test_a_third_without_ids(make_docs, corpus):
    """Texts without an id are one document, after all others, and keep their own marks."""
    rows = [(None if i % 3 == 0 else doc, text) for i, (doc, text) in enumerate(corpus) if doc != 3008]
    order = [r for r in rows if r[0] is not None]
    first = {}
    for doc, text in sorted(order):
        w = brute.words(text)
        for i in range(len(w) - 12):
            first.setdefault(tuple(w[i : i + 13]), doc)
    wanted = []
    for doc, text in rows:
        w = brute.words(text)
        gone = set()
        for i in range(len(w) - 12):
            earlier = first.get(tuple(w[i : i + 13]))
            if earlier is not None and (doc is None or earlier < doc):
                gone.update(range(i, i + 13))
        wanted.append((doc, len(w), len(gone)))
    got = phrase_automata.cut_repeats(make_docs(rows)).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed) for r in got), key=str) == sorted(wanted, key=str)


def _spans(frame):
    out = {}
    for r in frame.collect():
        out.setdefault(r.doc_id, []).append((r.start_word, r.end_word))
    return {d: sorted(s) for d, s in out.items()}


@pytest.mark.parametrize("size,anchor", [(50, 8), (20, 5)])
def test_repeated_passages(make_docs, corpus, size, anchor):
    got = sparse_suffixes.repeated_passages(make_docs(corpus, extra=", row int"), size=size, anchor=anchor)
    assert _spans(got) == brute.repeats(corpus, size)
    others = {r.doc_id: r.other_id for r in got.collect()}
    assert all(a != b for a, b in others.items())


@pytest.mark.parametrize("limit,combine", [(1, 1), (1, 6 << 20), (6000, 1)])
def test_repeated_passages_in_other_batches_and_hot_groups(make_docs, corpus, monkeypatch, limit, combine):
    monkeypatch.setattr(sparse_suffixes, "SHARD_ROWS", limit)
    monkeypatch.setattr(sparse_suffixes, "LAST_ROWS", limit)
    monkeypatch.setattr(sparse_suffixes, "COMBINE_BYTES", combine)
    rows = [r for r in corpus if r[0] != 3008]
    assert _spans(sparse_suffixes.repeated_passages(make_docs(rows))) == brute.repeats(rows, 50)


def test_null_ids_empty_tables_and_repeated_rows(make_docs, corpus):
    text = corpus[0][1] * 2
    assert sparse_suffixes.repeated_passages(make_docs([(1, text), (1, text)])).count() == 0
    assert set(_spans(sparse_suffixes.repeated_passages(make_docs([(1, text), (None, text)])))) == {1, None}
    assert sparse_suffixes.repeated_passages(make_docs([])).count() == 0
