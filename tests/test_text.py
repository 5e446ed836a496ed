import pandas as pd
import pytest
from pyspark.sql import functions as F

from pairloom.operators import text
from tests.plans import physical


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, "the " * (i % 9) + f"w{i % 5}\n\n  x{i}" if i % 7 else "") for i in range(60)]
    return spark.createDataFrame(rows, "id long, caption string").cache()


@pytest.fixture(scope="module")
def vocab(docs):
    return text.build_vocab(docs, "caption", 6).cache()


def brute(docs, vocab, length):
    table = {r["token"]: r["id"] for r in vocab.collect()}
    out = {}
    for r in docs.collect():
        ids = [table.get(t, 0) for t in r["caption"].replace("\n", " ").split(" ") if t][:length]
        out[r["id"]] = ids + [0] * (length - len(ids))
    return out


def test_vocab_order(docs, vocab):
    rows = vocab.orderBy("id").collect()
    assert [r["id"] for r in rows] == list(range(1, 7))
    assert rows[0]["token"] == "the"
    assert [(-r["n"], r["token"]) for r in rows] == sorted((-r["n"], r["token"]) for r in rows)


def test_large_vocab_is_numbered_the_same(docs, vocab, monkeypatch):
    monkeypatch.setattr(text.index, "SINGLE_SORT_ROWS", 0)
    large = text.build_vocab(docs, "caption", 6)
    assert sorted(large.collect()) == sorted(vocab.collect())
    assert large.dtypes == vocab.dtypes


@pytest.mark.parametrize("limit", [1 << 20, 0])
@pytest.mark.parametrize("encode", [text.encode_fixed_length, text.encode_in_place])
def test_encoding(docs, vocab, limit, encode):
    got = encode(docs, vocab, 5, broadcast_bytes=limit)
    assert {r["id"]: r["ids"] for r in got.collect()} == brute(docs, vocab, 5)


def test_golden_padding(spark):
    docs = spark.createDataFrame([(0, "a b c")], "id long, caption string")
    vocab = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "token string, id int")
    assert text.encode_fixed_length(docs, vocab, 5).first()["ids"] == [1, 2, 3, 0, 0]


@pytest.mark.parametrize("partitions", [1, 4, 7])
def test_encoding_does_not_depend_on_partitions(docs, vocab, partitions):
    got = text.encode_fixed_length(docs.repartition(partitions), vocab, 5)
    assert {r["id"]: r["ids"] for r in got.collect()} == brute(docs, vocab, 5)


@pytest.fixture(scope="module")
def vectors(spark):
    ids = spark.createDataFrame([(1, [0, 1, 2, 5]), (2, [0, 0, 0, 0])], "id long, ids array<int>")
    table = spark.createDataFrame([(i, [float(i), -1.0]) for i in range(4)], "token_id int, vec array<float>")
    return ids, table


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_lookup_wraps_ids(vectors, limit):
    rows = text.lookup_embeddings(*vectors, broadcast_bytes=limit).where("id = 1").orderBy("pos").collect()
    assert [r["vec"][0] for r in rows] == [0.0, 1.0, 2.0, 1.0]


def test_mean_pool(vectors):
    long = text.lookup_embeddings(*vectors)
    plain = {r["id"]: r["pooled"] for r in text.mean_pool(long, dim=2).collect()}
    assert plain == {1: [1.0, -1.0], 2: [0.0, -1.0]}
    masked = {r["id"]: r["pooled"] for r in text.mean_pool(long, dim=2, mask_padding=True).collect()}
    assert masked[1] == pytest.approx([4 / 3, -1.0]) and masked[2] == [0.0, 0.0]


@pytest.mark.parametrize("partitions", [1, 4])
def test_encoder_sees_fixed_batches(spark, partitions):
    def load():
        return lambda batch: pd.DataFrame({"id": batch["id"], "n": len(batch)})

    out = text.encode_batches(spark.range(0, 1000, 1, partitions), load, "id long, n long", 64).collect()
    assert sorted(r["id"] for r in out) == list(range(1000))
    short = [r for r in out if r["n"] != 64]
    assert len(short) == sum((1000 // partitions) % 64 for _ in range(partitions))


def test_encoder_is_loaded_once_per_worker(spark, tmp_path):
    log = str(tmp_path / "loads")

    def load():
        import os

        with open(log, "a") as f:
            f.write(f"{os.getpid()}\n")
        return lambda batch: batch

    text.encode_batches(spark.range(0, 100, 1, 20), load, "id long", 8, name=log).count()
    text.encode_batches(spark.range(0, 100, 1, 20), load, "id long", 8, name=log).collect()
    pids = open(log).read().split()
    assert len(pids) == len(set(pids))


def test_fill_condition(spark):
    df, cond = spark.range(3), spark.createDataFrame([(1, [2.0, 3.0])], "id long, vec array<double>")
    zero = {r["id"]: r["cond"] for r in text.fill_condition(df, cond, "zero", width=2).collect()}
    assert zero == {0: [0.0, 0.0], 1: [2.0, 3.0], 2: [0.0, 0.0]}
    empty = spark.createDataFrame([([7.0, 8.0],)], "vec array<double>")
    filled = {r["id"]: r["cond"] for r in text.fill_condition(df, cond, "empty_prompt", empty=empty).collect()}
    assert filled == {0: [7.0, 8.0], 1: [2.0, 3.0], 2: [7.0, 8.0]}
    with pytest.raises(ValueError):
        text.fill_condition(df, cond, "other")


def test_expand(spark):
    rows = text.expand_prompts(spark.range(2), 3).collect()
    assert [(r["id"], r["copy"]) for r in rows] == [(i, c) for i in range(2) for c in range(3)]


def test_fill_condition_splits_a_hot_key(spark):
    df = spark.range(900).select(F.when(F.col("id") < 600, 7).otherwise(F.col("id")).alias("id"), F.col("id").alias("copy"))
    cond = spark.range(0, 900, 2).select("id", F.array(F.col("id").cast("double")).alias("vec"))
    cond = cond.unionAll(spark.createDataFrame([(7, [7.0])], "id long, vec array<double>"))
    runs = [
        sorted(map(tuple, text.fill_condition(df, cond, "zero", width=1, hot_rows=h).select("id", "copy", F.col("cond")[0]).collect()))
        for h in (100, 10_000)
    ]
    assert runs[0] == runs[1] and len(runs[0]) == 900
    assert all(v == (i if i == 7 or i % 2 == 0 else 0.0) for i, _, v in runs[0])


@pytest.mark.parametrize("n", [1, 2, 5, 128])
def test_first_tokens_are_the_first_of_all(spark, docs, n):
    odd = spark.createDataFrame([(-1, " \n a  b\n\nc "), (-2, "\n"), (-3, None), (-4, "x"), (-5, " a b c d e f g")], docs.schema)
    both = docs.unionAll(odd)
    rows = both.select(text.first_tokens("caption", n).alias("a"), F.slice(text.tokens("caption"), 1, n).alias("b"))
    assert all(r["a"] == r["b"] for r in rows.collect())


def test_encoding_is_the_same_on_both_sides_of_the_limit(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "b c"), (None, "a"), (2, None)], "id int, caption string")
    vocab = spark.createDataFrame([("a", 1), ("b", 2)], "token string, id int")
    both = [
        sorted(map(str, text.encode_in_place(df, vocab, 3, broadcast_bytes=limit).collect())) for limit in (0, 1 << 20)
    ]
    assert both[0] == both[1] and len(both[0]) == 4


def test_pooling_is_the_same_on_both_sides_of_the_limit(spark):
    df = spark.createDataFrame([(1, [1, 2, 0, 0]), (2, [0, 0]), (3, [5, 1, 1])], "id int, ids array<int>")
    table = spark.createDataFrame([(i, [float(i), 1.0]) for i in (2, 0, 1)], "token_id int, vec array<double>")
    for mask, want in ((False, {1: [0.75, 1.0], 2: [0.0, 1.0], 3: [4 / 3, 1.0]}), (True, {1: [1.5, 1.0], 2: [0.0, 0.0], 3: [4 / 3, 1.0]})):
        for limit in (0, 1 << 20):
            got = text.pool_embeddings(df, table, dim=2, mask_padding=mask, broadcast_bytes=limit).collect()
            assert {r["id"]: r["pooled"] for r in got} == {k: pytest.approx(v) for k, v in want.items()}


def test_of_a_large_table_only_named_vectors_travel(spark):
    df = spark.createDataFrame([(1, [1, 2, 0, 1001]), (2, []), (3, [5, 1, 1])], "id int, ids array<int>")
    table = spark.range(1000).selectExpr("id token_id", "array(id * 1D, 1D) vec")
    limit = 1000  # of 48,000 bytes
    found = text.lookup_embeddings(df, table, broadcast_bytes=limit)
    assert "BroadcastHashJoin" in physical(found) and "SortMergeJoin" not in physical(found)
    got = sorted((r["id"], r["pos"], r["vec"][0]) for r in found.collect())
    assert got == [(1, 0, 1.0), (1, 1, 2.0), (1, 2, 0.0), (1, 3, 1.0), (3, 0, 5.0), (3, 1, 1.0), (3, 2, 1.0)]
    for mask in (False, True):
        pooled = text.pool_embeddings(df, table, dim=2, mask_padding=mask, broadcast_bytes=limit)
        assert "Exchange" not in physical(pooled)
        got = {r["id"]: r["pooled"] for r in pooled.collect()}
        assert got == {1: pytest.approx([4 / 3 if mask else 1.0, 1.0]), 2: [0.0, 0.0], 3: pytest.approx([7 / 3, 1.0])}


@pytest.mark.parametrize("mask", [False, True])
def test_blocks_of_rows_pool_as_positions_do(spark, monkeypatch, mask):
    monkeypatch.setattr(text, "BLOCK_ROWS", 3)
    monkeypatch.setattr(text, "BLOCK_IDS", 12)
    monkeypatch.setattr(text, "BLOCK_VECTORS", 2)
    rows = [(i % 17 if i else None, [(i * j) % 9 for j in range(i % 23)] if i % 5 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, ids array<int>")
    table = spark.range(7).selectExpr("id token_id", "array(CAST(id * id AS FLOAT), 1F) vec")
    pooled = text.pool_embeddings(df, table, dim=2, mask_padding=mask, broadcast_bytes=0)
    # Vectors move by block, and never with a position of their own.
    assert "posexplode" not in physical(pooled)
    wanted = text.mean_pool(text.lookup_embeddings(df, table), dim=2, mask_padding=mask)
    a, b = ({r["id"]: pytest.approx(r["pooled"]) for r in t.collect()} for t in (pooled, wanted))
    assert a.keys() == b.keys() and all(a[k] == b[k].expected for k in a)


def test_whole_texts_are_joined_by_the_distinct_tokens_of_blocks(spark, monkeypatch):
    coded = text.kernels.coded_blocks
    monkeypatch.setattr(text.kernels, "coded_blocks", lambda cut: coded(cut, 40))
    rows = [(i % 50 if i % 9 else None, " ".join(f"w{i * j % 13}" for j in range(i % 60)) if i % 4 else None) for i in range(200)]
    rows += [(7, "\n "), (8, ""), (9, "x " * 300)]
    df = spark.createDataFrame(rows, "id int, caption string")
    vocab = spark.createDataFrame([(f"w{i}", i + 1) for i in range(9)] + [("x", None), (None, 5)], "token string, id int")
    moved = text.encode_whole(df, vocab, broadcast_bytes=0)
    # A token moves without the row or position it stands at.
    assert "_pos" not in physical(moved) and "_row" not in physical(moved)
    table = {f"w{i}": i + 1 for i in range(9)}
    wanted = [(i, t, [table.get(w, 0) for w in (t or "").split()]) for i, t in rows]
    assert sorted(map(repr, map(tuple, moved.collect()))) == sorted(map(repr, wanted))
    # All ids of a repeated token count, in order.
    twice = text.encode_whole(df, vocab.unionAll(spark.createDataFrame([("w1", 1)], vocab.schema)), broadcast_bytes=0)
    wanted = [(i, t, [k for w in (t or "").split() for k in ((1, 2) if w == "w1" else (table.get(w, 0),))]) for i, t in rows]
    assert sorted(map(repr, map(tuple, twice.collect()))) == sorted(map(repr, wanted))
