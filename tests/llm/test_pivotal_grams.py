import random
from zlib import crc32

import pytest

from pairloom.llm.pivotal_grams import (
    _met, asked, filed, near_words, one_edit, pivots_of, prefix_of, runs_of, spelling_variants, typo, word_counts,
)
from tests.llm import brute

LETTERS = "abcdeàÿ"


def edited(word, rng, letters=LETTERS):
    at, kind = rng.randrange(len(word) + 1), rng.randrange(3)
    new = rng.choice(letters)
    if kind == 0:
        return word[:at] + new + word[at:]
    at = min(at, len(word) - 1)
    return word[:at] + (new if kind == 1 else "") + word[at + 1 :]


def corpus(seed=4, n=900):
    rng = random.Random(seed)
    stems = ["".join(rng.choices(LETTERS, k=rng.randint(7, 11))) for _ in range(30)] + ["aaaaaaaa", "abababab", "ÉÉÉÉÉÉÉÉ"]
    rows = []
    for i in range(n):
        said = []
        for _ in range(rng.randint(0, 30)):
            w = rng.choice(stems[: rng.randint(1, len(stems))])
            for _ in range(rng.choice([0] * 12 + [1, 1, 2])):
                w = edited(w, rng)
            said.append(w.title() if rng.random() < 0.1 else w)
        rows.append((i, rng.choice([" ", "-", ", ", "日", "×"]).join(said)))
    rows += [(2000 + i, w * n) for i, (w, n) in enumerate([("qqrrsst ", 2), ("qqrrsstt ", 30), ("qqrrssttu ", 400)] * 2)]
    return rows + [(None, "abcdeab abcdeab"), (3, None), (3, ""), (3, "abcdeab Abcdeab"), (9, "x" * 3000)]


def test_runs_are_those_of_the_pattern():
    text = "Éclair naïve×2 ÀÞ÷ß日本Łódź a_b\nB̀ ž\x7f퟿"
    assert [w.decode("latin-1") for w in runs_of(text)] == [
        "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in __import__("re").findall("[A-Za-zÀ-ÿ]+", text)
    ]


def test_typo_is_a_deletion_at_the_hash():
    for i in range(400):
        word = "ébcdefgh"
        h = crc32(f"{i}:{word}".encode())
        wanted = word if h % 31 else word[: h % 8] + word[h % 8 + 1 :]
        assert typo(word.encode("latin-1"), crc32(f"{i}:".encode())).decode("latin-1") == wanted


@pytest.mark.parametrize("seed", range(4))
def test_words_one_edit_apart_meet(seed):
    rng = random.Random(seed)
    grams = [a + b for a in LETTERS for b in LETTERS]
    rng.shuffle(grams)
    rank = {g: i for i, g in enumerate(grams)}
    for _ in range(4000):
        a = "".join(rng.choices(LETTERS[: rng.randint(1, 7)], k=rng.randint(5, 12)))
        b = edited(a, rng)
        if a == b or len(b) < 4:
            continue
        (pa, pb) = prefix_of(a, rank), prefix_of(b, rank)
        x, y = pivots_of(pa)
        assert abs(x[1] - y[1]) >= 2
        assert asked(a, [x, y]).keys() & filed(b, pb).keys() or asked(b, pivots_of(pb)).keys() & filed(a, pa).keys(), (a, b)


def test_pivots_are_the_rarest_disjoint_pair():
    rng = random.Random(2)
    for _ in range(300):
        places = rng.sample(range(12), rng.randint(3, 6))
        prefix = [(rng.randrange(20), p) for p in places]
        least = min(x[0] + y[0] for x in prefix for y in prefix if x[1] + 2 <= y[1])
        assert sum(r for r, _ in pivots_of(prefix)) == least


def test_one_edit_and_many_rows_of_a_key():
    rng = random.Random(6)
    words = sorted({"".join(rng.choices("abc", k=rng.randint(1, 5))) for _ in range(60)})
    wanted = {(a, b) for a in words for b in words if brute.one_edit(a, b)}
    assert {(a, b) for a in words for b in words if one_edit(a, b)} == wanted
    rows = [(w, w) for w in words]
    assert set(_met(rows, rows)) == wanted
    assert {pair for r in rows for pair in _met(rows[:3], [r])} == {p for p in wanted if p[1] in words[:3]}


def test_matches_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS word", "2 AS key")
    got = spelling_variants(docs).collect()
    found = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got}
    wanted = brute.variants(rows)
    assert found == wanted and len(got) == len(found)
    assert any(w[0] and w[1] != w[0] for w in wanted.values())


def test_small_tables(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert spelling_variants(none).collect() == []
    one = spark.createDataFrame([(1, "abcdefgh abcdefgh")], "doc_id bigint, text string")
    assert [tuple(r) for r in spelling_variants(one).collect()] == [("abcdefgh", None, "abcdefgh", 2, 0, None)]
    assert near_words(word_counts(one)).collect() == []
    with pytest.raises(ValueError):
        spelling_variants(one, least=3)
