import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table from (doc_id, text[, source]) rows."""

    def make(rows, extra=""):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", None if r[1] is None else len(r[1])) for r in rows]
        full = [(*r, *[7] * extra.count(",")) for r in full]
        return spark.createDataFrame(full, SCHEMA + extra)

    return make


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text) rows with copies, near copies, shared passages, nulls, empty and long texts."""
    rng = random.Random(3)
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randint(1, 6))) for _ in range(400)] + ["é", "日本"]

    def prose(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    passage, other = prose(70), prose(20)
    rows = []
    for i in range(60):
        body = prose(rng.randint(1, 120))
        if i % 5 == 0:
            body = body[:40] + passage + body[40:]
        if i % 7 == 0:
            body = other + body
        if i % 11 == 0:
            body = body + other[:12]
        rows.append((100 + 3 * i, " ".join(body)))
    base = prose(150)
    for i in range(12):
        near = list(base)
        near[i * 11] = "changed"
        rows.append((1000 + i, " ".join(near)))
    rows += [(2000 + i, rows[0][1]) for i in range(3)]
    rows += [(3000, None), (3001, ""), (3002, " \t\n"), (3003, "one"), (3004, "one two"), (3005, "ONE two")]
    rows += [(3006, "x " * 300), (3007, "x " * 310 + "y"), (3008, " ".join(prose(6000)))]
    rows += [(3009, "a\x0bb\x0cc\rd\ne\tf"), (3010, "A B  c")]
    return rows
