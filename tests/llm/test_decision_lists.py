import random

from pyspark.sql import functions as F

from pairloom.llm import decision_lists
from pairloom.llm.decision_lists import judge_quality, learn_rules, text_statistics
from pairloom.llm.words import wrapped
from tests.llm import brute
from tests.plans import formatted

LINES = "a b\n \na b\n\nc\na b\r\n  a b"
TEXTS = [
    None, "", " \n\t", "one", LINES, "a b c d e " * 3, "x " * 40, " ".join(map(str, range(30))), "#a *b $c% &|<>",
    "é 日本 " * 9, "a b c d e f a b c d e", "a b c d", "a b c d e", "\x0b".join("abcdefabcdef"), "w " * 3000 + "end",
]


def test_statistics(make_docs):
    rows = list(enumerate(TEXTS)) + [(None, TEXTS[5])]
    for r in text_statistics(wrapped(make_docs(rows), "doc_id", "text")).withColumn(
        "base_failed", decision_lists.base_failed()
    ).collect():
        want = brute.quality(r["text"])
        assert {k: r[k] for k in want} == want, r["text"][:50]


def _labelled(n=600):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(rng.randint(30, 80))]
        bad = i % 6 == 0
        if bad:
            words = [w + rng.choice(["###", "%%%"]) for w in words]
        rows.append((i, " ".join(words)))
        labels.append((i, 0 if bad else 1))
    return rows, labels


def test_learns_a_short_precise_list(spark, make_docs):
    rows, labels = _labelled()
    table = spark.createDataFrame(labels + [(0, 1), (None, 0), (10**6, 0), (3, None)], "doc_id bigint, quality int")
    docs = make_docs(rows + [(9000, None), (None, rows[1][1])], extra=", n_words string")
    got = judge_quality(docs, table)
    kept = {r.doc_id: r.kept for r in got.collect()}
    assert len(kept) == len(rows) + 2
    assert all(kept[i] == bool(q) for i, q in labels if i) and kept[9000] is False and kept[None]
    assert got.where("kept").select("_doc.*").columns == docs.columns
    assert not any(node in formatted(got) for node in ("EvalPython", "InArrow", "InPandas"))


def test_without_labels_only_the_base_rule_rejects(spark, make_docs):
    rows, _ = _labelled(20)
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert judge_quality(make_docs(rows), none).where(~F.col("kept")).count() == 0
    assert judge_quality(make_docs([]), none).count() == 0


def test_noise_teaches_nothing(spark, make_docs):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices("abcdefgh", k=60))) for i in range(300)]
    stats = text_statistics(wrapped(make_docs(rows), "doc_id", "text")).withColumn(
        "_bad", (F.crc32(F.col("doc_id").cast("string")) % 5 == 0).cast("int")
    )
    assert learn_rules(stats) == []
