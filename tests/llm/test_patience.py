import random
from itertools import combinations

from hypothesis import given, settings
from hypothesis import strategies as st

from pairloom.llm.patience import TEMPLATES, Template, align, find_licenses, licenses_of, longest_increasing, tokens
from tests.llm import brute


@given(st.lists(st.integers(0, 9), max_size=9))
@settings(max_examples=150, deadline=None)
def test_longest_increasing(values):
    got = [values[i] for i in longest_increasing(values)]
    assert all(a < b for a, b in zip(got, got[1:]))
    best = max((n for n in range(len(values) + 1) for c in combinations(values, n) if all(a < b for a, b in zip(c, c[1:]))), default=0)
    assert len(got) == best


@given(st.lists(st.sampled_from("abcdef"), max_size=12), st.lists(st.sampled_from("abcdef"), max_size=12))
@settings(max_examples=200, deadline=None)
def test_alignments_are_common_subsequences(a, b):
    pairs = align(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))
    assert len(pairs) <= brute.common_length(a, b)
    if a == b:
        assert len(pairs) == len(a)


def test_find_licenses(make_docs):
    rng = random.Random(1)
    prose = lambda n: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n))
    rows, want = [], {}
    for i, (name, text) in enumerate(TEMPLATES):
        rows.append((i, f"{prose(60)}\n{text.upper()} {prose(50)}"))
        want[i] = [name]
    mit = TEMPLATES[3][1]
    changed = mit.replace("Permission is hereby", "Permission is").replace("free of charge", "at no cost")
    rows += [(100, changed), (101, f"{TEMPLATES[2][1]} {prose(30)} {TEMPLATES[2][1]}"), (102, prose(20_000) + " " + mit)]
    rows += [(103, mit[: len(mit) // 2]), (104, "the license of this general public work"), (105, None), (106, "")]
    rows += [(107, " ".join(f"{w} {prose(12)}" for w in TEMPLATES[4][1].split())), (None, TEMPLATES[6][1])]
    want |= {100: ["MIT"], 101: ["MIT", "MIT"], 102: ["MIT"], None: ["CC-BY-NC-4.0"]}
    got = {}
    for r in sorted(find_licenses(make_docs(rows, extra=", license int")).collect(), key=lambda r: r.start_word):
        got.setdefault(r.doc_id, []).append(r.license)
        assert 0.8 <= r.coverage <= 1 and r.start_word < r.end_word
    assert got == want
    assert find_licenses(make_docs([])).count() == 0


def test_copies_side_by_side():
    rng = random.Random(5)
    prose = lambda n: ["".join(rng.choices("abcdefgh", k=5)) for _ in range(n)]
    made = [Template.make(*t) for t in TEMPLATES]
    for name, text in TEMPLATES:
        own = tokens(text.encode())
        for copies in range(2, 6):
            for between in (0, 3, 20, len(own)):
                # One word tells the short notices of Creative Commons apart.
                for lost in (0, len(own) // 10) if len(own) > 20 else (0,):
                    words, want = [w.encode() for w in prose(40)], []
                    for _ in range(copies):
                        one = list(own)
                        for at in sorted(rng.sample(range(1, len(own) - 1), lost), reverse=True):
                            if rng.random() < 0.5:
                                one[at] = b"changed"
                            else:
                                del one[at]
                        want.append((name, len(words)))
                        words += one + [w.encode() for w in prose(between)]
                    words += [w.encode() for w in prose(40)]
                    got = [(f[0], f[3]) for f in licenses_of(words, made, 0.8)]
                    assert got == want, (name, copies, between, lost)
