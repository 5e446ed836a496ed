import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from pairloom.llm import latent_search
from pairloom.llm.latent_search import (
    Matcher, Space, Words, buckets, common_length, find_leaks, inverse_frequencies, latent_basis, make_item, passages, tokens,
    weighted, without_leaks,
)
from pairloom.runtime import arrow_batches
from tests.llm import brute


def test_basis_is_the_singular_vectors(spark):
    rng = np.random.default_rng(0)
    dense = rng.normal(size=(60, 5)) @ rng.normal(size=(5, 30)) + 0.01 * rng.normal(size=(60, 30))
    rows = [(list(range(30)), [float(x) for x in row]) for row in dense]
    frame = spark.createDataFrame(rows, "at array<int>, weight array<float>")
    basis = latent_basis(frame, 30, 5)
    best = np.linalg.svd(dense)[2][:5].T
    assert np.allclose(np.abs(np.linalg.svd(np.linalg.qr(basis)[0].T @ best)[1]), 1, atol=1e-3)
    # Passages folded in are uncorrelated and of one size in every direction.
    places = dense @ basis
    gram = places.T @ places
    assert np.allclose(gram / gram[0, 0], np.eye(5), atol=0.02)


def test_windows_are_sums_of_half_windows():
    rng = np.random.default_rng(1)
    space = Space(rng.normal(size=(latent_search.BUCKETS, 3)).astype(np.float32), np.ones(latent_search.BUCKETS, np.float32))
    sizes = np.array([0, 1, 16, 17, 32, 33, 100, 0])
    bins = rng.integers(0, latent_search.BUCKETS, sizes.sum()).astype(np.int32)
    places, owner, start = space.windows(bins, sizes)
    wanted = [(t, s) for t, n in enumerate(sizes) if n for s in latent_search.window_starts(n)]
    assert list(zip(owner.tolist(), start.tolist())) == wanted
    ends = np.cumsum(sizes)
    for place, (t, s) in zip(places, wanted):
        own = bins[ends[t] - sizes[t] : ends[t]][s : s + latent_search.WINDOW]
        assert np.allclose(place, space.half[own].astype(np.float32).sum(axis=0), atol=1e-3)


def test_the_driver_makes_a_space_without_copies_of_it():
    rng = np.random.default_rng(2)
    basis = rng.normal(size=(latent_search.BUCKETS, 32)).astype(np.float32)
    idf = rng.random(latent_search.BUCKETS).astype(np.float32)
    tracemalloc.start()
    space = Space(basis, idf)
    rows = rng.integers(0, latent_search.BUCKETS + 1, (2000, latent_search.WINDOW))
    few = space.places(rows, widen=False)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1.5 * basis.nbytes and space.wide is None
    scaled = basis * idf[:, None]
    half = np.r_[scaled / float(np.abs(scaled).max()), np.zeros((1, 32), np.float32)].astype(np.float16)
    assert np.array_equal(space.half, half) and np.array_equal(few, space.places(rows))


def test_a_step_of_the_fit_holds_one_chunk_of_texts(spark):
    """Beside the sums and the batch itself; a batch as Python bytes and tables of twice a chunk took 70 MB more."""
    rng = np.random.default_rng(3)
    some = [" ".join(map(str, rng.integers(0, 9999, 600).tolist())) for _ in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array(some * 200), pa.array(np.ones(8000))], ["text", "length"])

    class Shared:
        value = np.ones(latent_search.BUCKETS, np.float32)

    tracemalloc.start()
    n = sum(part.num_rows for part in latent_search.passage_batches(Shared)(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 8000 * 19 and peak < 48 << 20
    # Batches are small while the space is fitted, and as before afterwards.
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    with arrow_batches(spark, 100):
        sizes = spark.range(0, 1000, 1, 1).mapInArrow(lambda bs: (pa.record_batch({"n": [b.num_rows]}) for b in bs), "n long")
        assert max(r["n"] for r in sizes.collect()) == 100
    assert spark.conf.get(key) == before


def test_synonyms_meet_in_the_latent_space(spark, make_docs):
    """Passages and their paraphrases share few words; the corpus uses the words of a topic side by side."""
    rng = random.Random(5)
    topics = [[(f"a{t}x{c}", f"b{t}x{c}") for c in range(40)] for t in range(40)]

    def passage(topic, n, side=None):
        pairs = rng.sample(topics[topic], n)
        return [p[rng.randrange(2) if side is None else side] for p in pairs], pairs

    rows = [(i, " ".join(sum((passage(i % 40, 32)[0] for _ in range(4)), []))) for i in range(600)]
    items = [passage(t, 30, 0) for t in range(40)]
    docs = make_docs(rows)
    idf, total = inverse_frequencies(docs)
    shared = spark.sparkContext.broadcast(idf)
    basis = latent_basis(passages(docs, shared, 1.0), latent_search.BUCKETS, 48)
    assert basis.shape[1] == 48 and total > 2000
    matcher = Matcher(
        Space(basis, idf), [make_item(t, " ".join(words), idf, 5) for t, (words, _) in enumerate(items)], 0.45, 0.5, 0.8, 0.6, 0.8
    )
    met = 0
    for t, (words, pairs) in enumerate(items):
        # Two words in thirty are the same, the others have their synonym.
        other = [p[1] if i > 1 else p[0] for i, p in enumerate(pairs)]
        a, b = (dict(zip(*weighted(buckets(" ".join(x).encode()), idf))) for x in (words, other))
        assert sum(x * b.get(k, 0) for k, x in a.items()) < 0.2
        bins = buckets(" ".join(other).encode())
        _, found, _ = matcher.near(matcher.space.windows(bins, np.array([len(bins)]))[0])
        met += t in found.tolist()
    assert met >= 36


def test_words_are_hashed_as_they_are_cut():
    rng = random.Random(4)
    texts = ["", " ", "a", "Ab,c  d\te\x0bf\r\n", "é É x.y 'z'", "...", "aaaa aaa aa a"]
    texts += ["".join(rng.choices("ab é,\n.", k=rng.randint(0, 40))) for _ in range(200)]
    sizes, bins = Words().read([t.encode() for t in texts])
    cut = [tokens(t.encode()) for t in texts]
    assert sizes.tolist() == [len(c) for c in cut]
    flat = [w for c in cut for w in c]
    assert len({(w, b) for w, b in zip(flat, bins.tolist())}) == len(set(flat))
    assert len(set(bins.tolist())) > 0.99 * len(set(flat))


def test_common_length():
    rng = random.Random(1)
    for _ in range(50):
        a, b = ([bytes([rng.choice(b"abcde")]) for _ in range(rng.randint(1, 40))] for _ in range(2))
        item = make_item(0, b" ".join(a).decode(), np.ones(latent_search.BUCKETS, np.float32), 5)
        assert common_length(item.masks, len(a), b) == brute.common_length(a, b)


@pytest.fixture(scope="module")
def leaks():
    rng = random.Random(7)
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(3000)]
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(prose(rng.randint(15, 60)))) for i in range(120)]
    rows, planted = [], set()
    for i in range(300):
        words = prose(rng.randint(5, 400))
        if i % 3 == 0:
            item, text = items[i % len(items)]
            own = text.split()
            if i % 2:
                for at in rng.sample(range(len(own)), len(own) // 12):
                    own[at] = rng.choice(vocabulary)
            at = rng.randint(0, len(words))
            words = words[:at] + [w.upper() + "," for w in own] + words[at:]
            planted.add((i, item))
        rows.append((i, " ".join(words)))
    return rows, items, planted


def _brute(rows, items):
    """Pairs whose best window of the item's length and a half holds 0.8 of it in order."""
    found = set()
    for doc, text in rows:
        words = tokens((text or "").encode())
        for item, other in items:
            own = tokens(other.encode())
            if len(set(own) & set(words)) < 0.7 * len(set(own)):
                continue
            if brute.common_length(own, words) >= 0.8 * len(own):
                found.add((doc, item))
    return found


def test_recall_and_precision(spark, make_docs, leaks):
    rows, items, planted = leaks
    benchmark = spark.createDataFrame(items + [(500, None), (501, ""), (502, " ... "), (None, items[0][1])], "item_id int, text string")
    docs = make_docs(rows + [(900, None), (901, ""), (None, items[3][1])], extra=", item_id string")
    got = {(r.doc_id, r.item_id) for r in find_leaks(docs, benchmark).collect()}
    want = _brute(rows, items)
    assert planted <= want and len(got & want) >= 0.95 * len(want)
    assert {d for d, i in got if i is not None} - {None} <= {d for d, _ in want}
    assert (None, 3) in got
    left = without_leaks(docs, benchmark)
    assert left.columns == docs.columns
    assert {r[0] for r in left.select("doc_id").collect()} == {r[0] for r in rows} - {d for d, _ in got} | {900, 901}


def test_blocks_of_items_and_empty_tables(spark, make_docs, leaks, monkeypatch):
    rows, items, planted = leaks
    monkeypatch.setattr(latent_search, "PASS_ITEMS", 60)
    benchmark = spark.createDataFrame(items, "item_id int, text string")
    got = {(r.doc_id, r.item_id) for r in find_leaks(make_docs(rows), benchmark).collect()}
    assert len(got & planted) >= 0.95 * len(planted)
    none = benchmark.limit(0)
    assert find_leaks(make_docs(rows[:5]), none).count() == 0
    assert without_leaks(make_docs(rows[:5]), none).count() == 5
    assert find_leaks(make_docs([]), benchmark).count() == 0
    # Of a single document all terms are everywhere.
    assert [r.item_id for r in find_leaks(make_docs([(1, items[0][1])]), benchmark).collect()] == [items[0][0]]


def _zipf_prose(rng, n_words=20_000):
    words = [f"w{i}" for i in range(n_words)]
    weights = [1 / (i + 3) for i in range(n_words)]
    return lambda n: rng.choices(words, weights, k=n)


def test_items_of_any_length(spark, make_docs):
    rng = random.Random(11)
    prose = _zipf_prose(rng)
    sizes = [rng.randint(6, 10) for _ in range(60)] + [rng.randint(120, 500) for _ in range(20)] + [4000]
    items = [(i, " ".join(prose(n))) for i, n in enumerate(sizes)]
    rows = [(i, " ".join([*prose(rng.randint(30, 200)), text, *prose(150)])) for i, text in items]
    benchmark = spark.createDataFrame([*items, items[70]], "item_id int, text string")
    got = [(r.doc_id, r.item_id) for r in find_leaks(make_docs(rows), benchmark).collect()]
    assert {(i, i) for i, _ in items} <= set(got)
    # Equal rows of the benchmark are reported alike, and an item of many windows once.
    assert got.count((70, 70)) == 2 and got.count((80, 80)) == 1


def test_paraphrases_that_the_check_accepts_are_retrieved(spark, make_docs):
    rng = random.Random(13)
    prose = _zipf_prose(rng)
    items = [(i, " ".join(prose(54))) for i in range(150)]
    rows = []
    for i, text in items:
        own = text.split()
        for at in rng.sample(range(54), 20):
            own[at] = prose(1)[0]
        rows.append((i, " ".join([*prose(rng.randint(0, 100)), *own, *prose(100)])))
    docs = make_docs(rows)
    benchmark = spark.createDataFrame(items, "item_id int, text string")
    got = {(r.doc_id, r.item_id) for r in find_leaks(docs, benchmark, answered=0.0).collect()}
    # The answer's terms are left to the check alone: each text holds 34 of its item's 54 words in order.
    assert got >= {(i, i) for i, _ in items}


def test_the_space_is_fitted_on_every_passage(spark, make_docs, monkeypatch):
    rng = random.Random(17)
    # Of words of one letter a passage has few bytes.
    sizes = [rng.randint(0, 1500) for _ in range(400)]
    texts = [" ".join(rng.choices("abcdefgh", k=n)) for n in sizes]
    whole = sum(-(-n // latent_search.WINDOW) for n in sizes)
    docs = make_docs([*enumerate(texts), (900, None)])
    fitted, fit = [], latent_search.latent_basis

    def counted(rows, *rest, **options):
        fitted.append(rows.mapInArrow(options["make"], latent_search.PASSAGES).count())
        return fit(rows, *rest, **options)

    monkeypatch.setattr(latent_search, "latent_basis", counted)
    find_leaks(docs, spark.createDataFrame([(1, " ".join("abcd" * 12))], "item_id int, text string"))
    assert whole > 8192 and fitted == [whole + 2]
    idf = np.random.default_rng(3).random(latent_search.BUCKETS).astype(np.float32)
    got = passages(docs, spark.sparkContext.broadcast(idf), 0.5).collect()
    want = []
    for text in texts:
        bins = buckets(text.encode())
        for start in range(0, len(bins), latent_search.WINDOW):
            terms, x = weighted(bins[start : start + latent_search.WINDOW], idf)
            want.append((tuple(terms.tolist()), tuple(np.round(x / 2, 5).tolist())))
    assert sorted((tuple(r["at"]), tuple(np.round(np.float32(r["weight"]), 5).tolist())) for r in got) == sorted(want)
