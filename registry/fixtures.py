"""Inputs for the operators, derived from the given tables.

``registry.oracles`` rebuilds each of them in SQL.
"""

from __future__ import annotations

import io
import json
import tarfile

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.functions.rand import uniform
from pairloom.operators.samples import with_sample_key
from pairloom.runtime import materialize, ship_by_value
from pairloom.sources.manifest import project_manifest
from pairloom.sources.shards import with_shards

SHARD_ROWS = 50
VOCAB_SIZE = 1000
LENGTH = 128
SHIFT, SCALE = 0.1159, 0.3611
STEPS = 50
# Rows of a file that a stream finds, about.
FILE_ROWS = 50_000
# Sampling runs of a task, at most about.
RUNS_PER_TASK = 4000


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def h(key: str, tag: str) -> Column:
    return uniform(0, tag, key)


def pages(spark, sf) -> DataFrame:
    p = table(spark, sf, "pages")
    return p.select(
        F.col("page_id").alias("id"),
        F.col("url").alias("href"),
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
        F.regexp_extract("url", "^https?://([^/]+)", 1).alias("source"),
    )


def manifest(spark, sf) -> DataFrame:
    return project_manifest(pages(spark, sf), "href", "title")


def assets(spark, sf) -> DataFrame:
    ext = F.when(h("page_id", "ext") < 0.4, ".jpg").when(h("page_id", "ext") < 0.7, ".JPG").otherwise(".png")
    return table(spark, sf, "pages").select(
        F.col("page_id").alias("id"), F.concat(F.lit("img/"), F.col("page_id").cast("string"), ext).alias("path")
    )


def payloads(spark, sf) -> DataFrame:
    return (
        table(spark, sf, "pages")
        .where(h("page_id", "p") < 0.8)
        .select(
            F.col("page_id").alias("id"),
            F.encode("html", "UTF-8").alias("data"),
            (h("page_id", "e") * 10.0).alias("elapsed_s"),
        )
    )


def image_sizes(spark, sf) -> DataFrame:
    def side(tag):
        return (F.floor(h("page_id", tag) * 960.0) + 64).cast("int")

    fmt = F.when(h("page_id", "fmt") < 0.7, "jpg").otherwise("png")
    return table(spark, sf, "pages").select(
        F.col("page_id").alias("id"), side("w").alias("w"), side("h").alias("h"), fmt.alias("format")
    )


def latents(spark, sf) -> DataFrame:
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("x"))


def pixels(spark, sf) -> DataFrame:
    px = F.transform("x", lambda v: F.floor(v.cast("double") * 127.0 + 128.0).cast("int"))
    return latents(spark, sf).select("id", px.alias("px"))


def members(spark, sf) -> DataFrame:
    """Metadata JSON, some of it malformed or without its field, with a suffix each."""
    u = h("event_id", "bad")
    text = (
        F.when(u < 0.02, F.regexp_replace("props", ":", ""))
        .when(u < 0.04, F.regexp_replace("props", "k", "x"))
        .otherwise(F.col("props"))
    )
    s = h("event_id", "suffix")
    ext = F.when(s < 0.3, "caption.txt").when(s < 0.6, "vae_latent.pth").otherwise("json")
    return table(spark, sf, "events").select(
        F.col("event_id").alias("id"), text.alias("json"), ext.alias("ext"),
        F.encode(text, "UTF-8").alias("data"),
    )


def captions(spark, sf) -> DataFrame:
    return table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("caption"))


def samples(spark, sf) -> DataFrame:
    """Every document with a latent; there are fewer latents, so they repeat."""
    x = latents(spark, sf)
    x = x.select(F.col("id").alias("_at"), "x")
    at = F.col("id") % x.count()
    return captions(spark, sf).withColumn("_at", at).join(x, "_at").drop("_at")


def sharded_samples(spark, sf) -> DataFrame:
    return with_shards(samples(spark, sf), SHARD_ROWS, ["id"])


def keyed_parts(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Latent, embedding and caption tables that share a key."""
    x = latents(spark, sf).withColumnRenamed("x", "latent")
    keyed = with_sample_key(x.withColumn("idx", F.col("id")))
    embeds = keyed.select("key", F.transform("latent", lambda v: v * F.lit(2).cast("float")).alias("prompt_embeds"))
    texts = with_sample_key(captions(spark, sf).withColumn("idx", F.col("id"))).select("key", "caption")
    return keyed.select("key", "id", "latent"), embeds, texts


def vocab(spark, sf) -> DataFrame:
    from pairloom.operators.text import build_vocab

    return materialize(build_vocab(captions(spark, sf), "caption", VOCAB_SIZE), "vocab")


def trajectories(spark, sf) -> DataFrame:
    """Latents by key, as a sampler writes its runs: what is read of a key lies in one task.

    Tasks grow with the rows, so that a task sorts about 100 MB of steps. Velocities and starts
    placed like this meet without moving; the operators ask for no such placement.
    """
    x = latents(spark, sf)
    tasks = max(spark.sparkContext.defaultParallelism, -(-x.count() // RUNS_PER_TASK))
    return x.repartition(tasks, "id")


def velocities(spark, sf) -> DataFrame:
    """(key, step, v) for steps 1..50 of every latent."""
    steps = trajectories(spark, sf).select("id", "x", F.explode(F.sequence(F.lit(1), F.lit(STEPS))).alias("step"))
    v = F.transform("x", lambda a: a.cast("double") * F.cos(F.col("step").cast("double")))
    return steps.select(F.col("id").alias("key"), "step", v.alias("v"))


def start_noise(spark, sf) -> DataFrame:
    return trajectories(spark, sf).select(F.col("id").alias("key"), F.col("x").alias("z"))


def step_log(spark, sf) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("event_id").alias("step"),
        F.floor(F.col("event_id") / 1000).cast("bigint").alias("epoch"),
        h("event_id", "t").alias("t"),
        F.col("value").alias("loss"),
    )


RUNS, LOG_EVERY = 3, 100
EVAL_EVERY, EVAL_ROWS = 50, 10


def run_log(spark, sf) -> DataFrame:
    """Steps of three runs that log at once: (run, step, epoch, t, loss, ts)."""
    step = F.floor(F.col("event_id") / RUNS).cast("bigint")
    return table(spark, sf, "events").select(
        (F.col("event_id") % RUNS).alias("run"), step.alias("step"), F.floor(step / 500).cast("bigint").alias("epoch"),
        h("event_id", "t").alias("t"), F.col("value").alias("loss"), F.col("ts").cast("timestamp").alias("ts"),
    )


def evaluations(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Every fortieth row of a run is followed by ten of an evaluation, in batches of two: (samples, steps)."""
    rows = run_log(spark, sf)
    turn, place = F.floor(F.col("step") / EVAL_EVERY), F.col("step") % EVAL_EVERY
    first = EVAL_EVERY - EVAL_ROWS
    tests = rows.where(place >= first).select(
        "run", turn.alias("turn"), ((place - first) / 2).cast("bigint").alias("batch_id"), "t", "loss", "ts"
    )
    begun = tests.groupBy("run", "turn").agg(F.min("ts").alias("ts"))
    samples = tests.drop("ts").join(begun, ["run", "turn"]).drop("turn")
    steps = rows.where(place < first).select("run", (turn * first + place).alias("step"), "epoch", "ts")
    return samples, steps


def file_count(rows: int) -> int:
    return max(1, -(-rows // FILE_ROWS))


def chunked(df: DataFrame, label: str, parts: list[Column]) -> tuple[str, int]:
    """A folder with files per condition, each after the one before, as a stream finds them; and the files of a part.

    That many files per trigger make a micro-batch of each part, whatever the rows.
    """
    from pairloom.runtime import work_dir

    folder = work_dir(df.sparkSession, label)
    files = file_count(df.count())
    for part in parts:
        df.where(part).repartition(files).write.mode("append").parquet(folder)
    return folder, files


def raw_samples(spark, sf) -> DataFrame:
    u = h("id", "broken")
    good = F.to_json(F.struct("caption"))
    text = F.when(u < 0.05, F.lit('{"caption" }')).when(u < 0.1, F.lit('{"title": 1}')).otherwise(good)
    url = F.concat(F.lit("img/"), F.col("id").cast("string"))
    # Most documents have no latent and are set aside for that.
    every = captions(spark, sf).join(latents(spark, sf), "id", "left")
    return every.select("id", url.alias("url"), text.alias("json"), F.col("x").alias("latent"))


def write_tars(df: DataFrame, folder: str) -> int:
    """Write (shard, key, jpg, caption) rows as ``folder/<shard>.tar``; returns the rows.

    Only the fixture needs tar files written; the library's own sink is partitioned parquet.
    """

    def run(group: pd.DataFrame) -> pd.DataFrame:
        from pyarrow import fs

        system, inside = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        system.create_dir(inside, recursive=True)
        group = group.sort_values("key")
        shard = group["shard"].iloc[0]
        with system.open_output_stream(f"{inside}/{shard}.tar") as sink:
            with tarfile.open(fileobj=sink, mode="w|") as tar:
                for row in group.itertuples(index=False):
                    note = json.dumps({"caption": row.caption}).encode()
                    for ext, data in (("jpg", row.jpg), ("json", note)):
                        info = tarfile.TarInfo(f"{row.key}.{ext}")
                        info.size = len(data)
                        tar.addfile(info, io.BytesIO(data))
        return pd.DataFrame({"n": [len(group)]})

    return df.groupBy("shard").applyInPandas(run, "n long").agg(F.sum("n")).first()[0]


ship_by_value(__name__)
