import random

import pytest

import corpus_pipeline
from pairloom.llm.latent_search import find_leaks
from pairloom.llm.secret_novelty import base_spans
from tests.llm import brute


def test_every_stage_takes_effect(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    before = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        rows = out.collect()
        after = {r.doc_id: r for r in rows}
        if name == "mixture":
            assert out.columns == [*columns, "copy"]
            words = lambda table: sum(len(brute.words(r.text)) for r in table)
            assert 1.2 * words(before.values()) < words(rows) < 1.8 * words(before.values())
            break
        assert out.columns == columns and set(after) <= set(before) and len(after) == len(rows)
        if name == "quality":
            assert not any(brute.quality(r.text)["base_failed"] for r in rows)
        elif name == "near_dedup":
            label = brute.classes({i: brute.fingerprint(r.text) for i, r in before.items()})
            assert set(after) == set(label.values())
        elif name == "decontaminate":
            benchmark = spark.read.parquet(f"{sf}/benchmark.parquet")
            held = {r.doc_id for r in find_leaks(docs, benchmark).collect()}
            items = [r.text for r in benchmark.collect()]
            assert {i for i, r in before.items() if any(t in r.text for t in items)} <= held
            assert set(after) == set(before) - held
        elif name == "secrets":
            assert set(after) == set(before)
            assert not any(base_spans(r.text) for r in rows)
            assert all(after[i].text == r.text for i, r in before.items() if not base_spans(r.text))
        docs, before = spark.createDataFrame(rows, docs.schema), after
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontaminate", "secrets", "mixture"]


def test_run(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert out.columns[-1] == "copy" and out.count() > 0


def _folder(spark, tmp_path, rows, labels, items):
    sf = str(tmp_path / "tables")
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, copy int, kept string, _doc int"
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], schema)
    docs.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{sf}/benchmark.parquet")
    return sf


def _prose(n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(n)) + "."


@pytest.mark.parametrize("empty", [False, True])
def test_stages_bear_nulls_repeats_and_clashing_columns(spark, tmp_path, empty):
    leak = _prose(30, 99)
    rows = [] if empty else [
        (1, _prose(80, 1), "en", "a", 9), (1, _prose(80, 1), "en", "a", 9), (2, _prose(80, 2), "en", None, None),
        (None, _prose(80, 3), None, "a", 9), (None, _prose(80, 3), None, "a", 9), (4, None, "en", "b", None),
        (5, "", "en", "b", 0), (6, _prose(40, 6) + " " + leak, "en", "b", 1), (7, _prose(20_000, 7), "en", "b", 1),
        (8, _prose(60, 8) + " password = hunter2hunter2 " + _prose(20, 9), "en", "a", 1),
    ]
    labels = [] if empty else [(1, 1, 0), (2, None, None), (None, 1, 1), (4, 0, 0)]
    items = [] if empty else [(0, leak), (0, leak), (1, None), (None, "")]
    sf = _folder(spark, tmp_path, rows, labels, items)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        seen = sorted((r.doc_id or 0, len(r.text or "")) for r in out.collect())
        ids = [i for i, _ in seen]
        if empty:
            assert seen == []
        elif name == "quality":
            # Texts of fewer than ten words go; every other row stays, repeated ones too.
            assert ids == [0, 0, 1, 1, 2, 6, 7, 8]
        elif name == "near_dedup":
            assert ids == [0, 1, 2, 6, 7, 8]
        elif name == "decontaminate":
            assert ids == [0, 1, 2, 7, 8]
        elif name == "secrets":
            assert ids == [0, 1, 2, 7, 8] and all("hunter2" not in r.text for r in out.collect())
        if name != "mixture":
            assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), out.schema)
