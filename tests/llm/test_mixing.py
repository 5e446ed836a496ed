import pytest

from pairloom.llm.mixing import mix, mixed_rows, source_targets


def _targets(sizes, share=1.5, most=2.0, weights=(5, 2, 1)):
    """Shares handed out again and again until none is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, total = dict(sizes), share * sum(sizes.values())
    out = {}
    while left:
        level = total / sum(weight[s] for s in left)
        full = [s for s in left if most * left[s] <= level * weight[s]]
        if not full:
            return {**out, **{s: level * weight[s] for s in left}}
        for s in full:
            out[s] = most * left.pop(s)
            total -= out[s]
    return out


CASES = [
    {"a": 100, "b": 50, None: 70},
    {"a": 1, "b": 1000, "c": 5, "d": 300, "é": 7, "Z": 2, None: 90},
    {"a": 0, "b": 10},
    {"a": 0, None: 0},
    {"only": 9},
]


@pytest.mark.parametrize("sizes", CASES)
def test_targets(spark, sizes):
    table = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size bigint")
    got = {r.source: r.target for r in source_targets(table).collect()}
    want = _targets(sizes)
    assert got == pytest.approx(want)


def test_mix(make_docs):
    rows = [(i, "w " * (1 + i % 9), "abc"[i % 3] if i % 10 else None) for i in range(600)]
    rows += [(900, None, "a"), (901, "", "b"), (None, "x y", "c"), (None, "x y", "c"), (5, "w w w", "a")]
    docs = make_docs(rows, extra=", size int, copies int, copy int")
    got = mix(docs).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    want = _targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        source = r["_doc"]["source"]
        assert r["size"] == len((r["_doc"]["text"] or "").split())
        assert r["target"] == pytest.approx(want[source]) and r["source_size"] == sizes[source]
        assert 0 <= r["copies"] <= 2
        taken[source] += r["copies"] * r["size"]
    assert all(abs(taken[s] - want[s]) < 0.25 * want[s] for s in sizes)
    copies = mixed_rows(docs)
    assert copies.columns == [*(c for c in docs.columns if c != "copy"), "copy"]
    assert copies.count() == sum(r["copies"] for r in got)
    assert sorted(map(str, copies.collect())) == sorted(map(str, mixed_rows(docs.repartition(7)).collect()))


def test_empty_table(make_docs):
    assert mix(make_docs([])).count() == 0
