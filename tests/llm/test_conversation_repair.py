import random

import pytest

from pairloom.llm.conversation_repair import DONE, START, cheapest, damaged, repair_conversations, repaired
from tests.llm import brute

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
TEXTS = ["Yes.", "No!", "cut off", "", " \t", "Why?", "so. ", None, "more\nlines."]
ROLES = ["system", "user", "assistant", "user", "assistant", "tool", None, "", "usher"]


def turns_of(rows):
    seen, out = set(), []
    for role, text in rows:
        w = brute.words(text)
        gone = not w or (role, text) in seen
        seen.add((role, text))
        out.append((role[:1], gone, not gone and w[-1][-1] not in ".!?"))
    return out


@pytest.mark.parametrize("seed", range(6))
def test_cheapest_and_least_audit(seed):
    rng = random.Random(seed)
    for _ in range(300):
        rows = [
            (rng.choice(ROLES[:6]), rng.choice(["Yes.", "cut", "", f"t{i}.", f"n{i}"])) for i in range(rng.randint(0, 9))
        ]
        cost, audit, lines = brute.repair(rows)
        assert cheapest(turns_of(rows)) == (cost, audit)
        assert tuple(repaired(rows, audit)) == lines


def test_long_conversations_take_linear_work():
    rng = random.Random(1)
    rows = [(rng.choice(ROLES[:6]), f"text {i}" + rng.choice([".", ""])) for i in range(5000)]
    cost, audit, _ = brute.repair(rows)
    assert cheapest(turns_of(rows)) == (cost, audit)


def test_nothing_to_repair():
    assert cheapest([]) == (0, "") and cheapest([("s", False, False)]) == (3, "D")
    assert cheapest([("a", False, False)], START, frozenset((1,))) is None
    assert cheapest([("u", False, True), ("a", False, False)], START, DONE) == (1, "KK")


def table(n=260, seed=5):
    rng = random.Random(seed)
    rows = []
    for conv in [None, *range(n)]:
        for i in range(rng.choice([0, 1, 2, 5, 8, 30]) or 1):
            rows.append((conv, rng.choice([None, i, i, i, i + 3]), rng.choice(ROLES), rng.choice([*TEXTS, f"say {i}.", f"{i}"])))
    rows += [(7, 2, "user", "Same.")] * 40
    rows += [(8, i, ROLES[i % 3], f"{i}" + "." * (i % 2)) for i in range(600)]
    return rows


@pytest.mark.parametrize("options", [{}, {"whole_rows": 6, "segment_rows": 4}, {"whole_bytes": 0, "segment_rows": 1}])
def test_matches_brute_force(spark, options):
    rows = table()
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS gone", "2 AS seg", "3 AS cost")
    got = repair_conversations(damaged(frame), **options)
    wanted = {conv: brute.repair_row(said) for conv, said in brute.damage(rows).items()}
    found = {r[0]: tuple(r[1:]) for r in got.collect()}
    assert found == wanted
    assert any(not said for said in brute.damage(rows).values())


def test_empty_table_and_other_keys(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair_conversations(damaged(none)).collect() == []
    rows = spark.createDataFrame([("x", 1, "user", "Hi."), (None, None, None, None)], "conv_id string, turn int, role string, text string")
    got = {r.conv_id: r for r in repair_conversations(damaged(rows)).collect()}
    assert set(got) == {"x", None}
