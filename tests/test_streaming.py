from pathlib import Path

from pyspark.sql import functions as F

from pairloom.operators.metrics import loss_by_bin
from pairloom.plans.preparation import prepare
from pairloom.schemas import RAW_SAMPLE
from pairloom.streaming.monitor import loss_monitor, start_monitor
from pairloom.streaming.prepare import prepare_stream
from registry import fixtures, queries
from tests.plans import physical


def raw(spark, start, n):
    rows = [
        (i, f"u{i}", '{"caption": "a b w%d"}' % (i % 3) if i % 5 else '{"caption"', [float(i), 1.0])
        for i in range(start, start + n)
    ]
    return spark.createDataFrame(rows, RAW_SAMPLE)


def test_each_file_lands_once_also_after_a_restart(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    vocab = spark.createDataFrame([("a", 1), ("b", 2), ("w1", 3)], "token string, id int")
    args = dict(shift=0.5, scale=2.0, length=4)
    both = None
    for turn in range(2):
        batch = raw(spark, 50 * turn, 50)
        both = batch if both is None else both.unionAll(batch)
        batch.coalesce(1).write.mode("append").parquet(source)
        prepare_stream(spark, source, out, state, vocab, **args).awaitTermination()
        whole = prepare(both, vocab, **args)
        landed = spark.read.parquet(out)
        assert sorted(landed.select(whole.columns).collect(), key=str) == sorted(whole.collect(), key=str)
        assert landed.select("batch").distinct().count() == turn + 1
        assert landed.where("verdict = 'bad_json'").count() == 10 * (turn + 1)


def test_repeated_batch_overwrites(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    vocab = spark.createDataFrame([("a", 1)], "token string, id int")
    raw(spark, 0, 20).coalesce(1).write.parquet(source)
    for attempt in range(2):
        prepare_stream(
            spark, source, out, str(tmp_path / f"state{attempt}"), vocab, shift=0.0, scale=1.0, length=4
        ).awaitTermination()
    landed = spark.read.parquet(out)
    assert landed.count() == 20 and landed.where("verdict = 'ok'").count() == 16


def test_preparation_shuffles_nothing(spark, tmp_path):
    vocab = spark.createDataFrame([("a", 1)], "token string, id int")
    plan = physical(prepare(raw(spark, 0, 5), vocab, shift=0.0, scale=1.0, length=4))
    assert "Exchange" not in plan and "Join" not in plan


def test_monitor_equals_batch_on_closed_windows(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    seconds = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 30)
    steps = spark.range(1000).select(seconds.alias("ts"), ((F.col("id") * 7 % 100) / 100).alias("t"), F.col("id").cast("double").alias("loss"))
    steps.coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(steps.schema).parquet(source)
    start_monitor(loss_monitor(stream), out, str(tmp_path / "state"), once=True).awaitTermination()
    closed = spark.read.parquet(out)
    windows = [r[0] for r in closed.select("window_start").distinct().orderBy("window_start").collect()]
    assert 6 <= len(windows) <= 9
    for start in windows:
        inside = steps.where((F.col("ts") >= F.lit(start)) & (F.col("ts") < F.lit(start) + F.expr("INTERVAL 1 HOUR")))
        batch = {r["bin"]: (r["loss"], r["n"]) for r in loss_by_bin(inside).collect() if r["n"]}
        seen = {r["bin"]: (r["loss"], r["n"]) for r in closed.where(F.col("window_start") == F.lit(start)).collect()}
        assert seen.keys() == batch.keys()
        assert all(abs(seen[k][0] - batch[k][0]) < 1e-9 and seen[k][1] == batch[k][1] for k in batch)


def test_files_of_a_stream_grow_with_its_rows(spark, sf, monkeypatch):
    monkeypatch.setattr(fixtures, "FILE_ROWS", 20)
    rows = spark.range(100)
    folder, files = fixtures.chunked(rows, "chunked", [F.col("id") < 60, F.col("id") >= 60])
    assert files == 5 and len(list(Path(folder).glob("*.parquet"))) == 2 * files
    assert sorted(r["id"] for r in spark.read.parquet(folder).collect()) == list(range(100))
    seen, whole = [], queries.prepare_stream

    def watched(spark, source, *rest, max_files, **options):
        seen.append((len(list(Path(source).glob("*.parquet"))), max_files))
        report = options.pop("report")

        def counted(batch, counts):
            seen.append(batch)
            report(batch, counts)

        return whole(spark, source, *rest, max_files=max_files, report=counted, **options)

    monkeypatch.setattr(queries, "prepare_stream", watched)
    got = queries.prepare_stream_observed(spark, sf).collect()
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    per = -(-n // 3 // 20)
    assert seen[0] == (3 * seen[0][1], seen[0][1]) and seen[0][1] >= per > 1 and seen[1:] == [0, 1, 2]
    assert sorted(map(tuple, got)) == sorted(map(tuple, queries.prepare_observed(spark, sf).collect()))
