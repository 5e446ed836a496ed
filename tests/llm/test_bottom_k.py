import random

import numpy as np
import pytest

from pairloom.llm import bottom_k
from pairloom.llm.bottom_k import RETAINED, estimate, near_duplicates, shingles, similar, sketch
from tests.llm import brute


def grown(seed=1):
    """Groups around a base: chains, near copies of every distance, a passage most texts share."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(3000)]

    def prose(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    passage, rows = prose(60), []
    for group in range(40):
        base = prose(rng.choice([3, 4, 8, 15, 30, 70, 200, 900]))
        if group % 3 == 0:
            base = base[: len(base) // 2] + passage + base[len(base) // 2 :]
        for _ in range(rng.randint(1, 9)):
            body = list(base)
            for _ in range(rng.randint(0, 1 + len(body) // 25)):
                body[rng.randrange(len(body))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                base = body  # the next is a copy of this one
            rows.append(" ".join(body))
    return [(7 * i % 1009, t) for i, t in enumerate(rows)]


def test_shingles_and_sketches():
    for text in ("", "  ", "A b", "a B c d", "a b c d e a b c d", "é É x\x0by z w"):
        found = shingles(text.encode())
        assert {tuple(s.decode().split(" ")) for s in found} == brute.shingle_set(text, 4)
        values = sketch(found)
        assert len(values) == len(found) and (values[1:] > values[:-1]).all()
    many = sketch({str(i).encode() for i in range(500)})
    assert len(many) == RETAINED and (many == sketch({str(i).encode() for i in range(500)})).all()


def test_estimates_are_close_and_exact_for_small_sets():
    rng = random.Random(2)
    for size, error in ((40, 0), (3000, 0.25)):
        a = {str(i).encode() for i in range(size)}
        b = {str(i).encode() for i in range(size // 10, size + rng.randint(0, size // 10))}
        table = np.full((1, RETAINED), np.iinfo(np.int64).max)
        values = sketch(a)
        table[0, : len(values)] = values
        got = estimate(table, np.array([len(a)]), sketch(b), len(b))[0]
        assert abs(got - len(a & b) / len(a | b)) <= error


def test_bound_is_inclusive():
    def numbers(a, b):
        return {str(i).encode() for i in range(a, b)}

    assert similar(numbers(0, 8), numbers(0, 10)) and not similar(numbers(0, 79), numbers(0, 100))


@pytest.mark.parametrize("options, members", [({}, 500), ({"common_texts": 3, "block": 4}, 2)])
def test_matches_brute_force(make_docs, corpus, options, members, monkeypatch):
    monkeypatch.setattr(bottom_k, "MEMBERS", members)
    rows = corpus + [(10_000 + i, t) for i, t in grown()]
    docs = make_docs(rows, extra=", node int, sketch int, at int, n_shingles int")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs, **options).collect()}
    wanted = brute.jaccard_classes(rows)
    assert got == {doc: (n, c, doc == c) for (doc, _), (n, c) in zip(rows, wanted)}
    assert len({c for _, c in wanted}) < len(rows) - 60


def test_null_ids_repeated_rows_and_empty_tables(make_docs):
    rows = [(5, "a b c d e"), (5, "a b c d e"), (None, "a b c d e"), (None, "q r"), (None, "q r"), (None, None), (6, ""), (7, None)]
    got = sorted((tuple(r) for r in near_duplicates(make_docs(rows)).collect()), key=str)
    assert got == sorted(
        [(5, 2, 5, True)] * 2 + [(None, 2, 5, False)] + [(None, 1, None, False)] * 2 + [(None, 0, None, False)]
        + [(6, 0, 6, True), (7, 0, 7, True)], key=str,
    )
    assert near_duplicates(make_docs(rows).limit(0)).collect() == []
