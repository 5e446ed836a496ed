"""One query per operator. Arrays leave as rows or as digests over all their elements."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.functions import arrays
from pairloom.functions.rand import uniform
from pairloom.operators import buffer, epochs, flow, images, index, metrics, samples, text
from pairloom.operators import latents as lat
from pairloom.plans.epoch import attach_rows, plan_epoch
from pairloom.plans.ingest import ingest
from pairloom.plans.loss_profile import loss_profile
from pairloom.plans.preparation import prepare, write_prepared
from pairloom.plans.samples import build_samples, read_pairs
from pairloom.plans.sampling import decoded_steps, to_pixels
from pairloom.plans.training import evaluate, step_losses, training_rows
from pairloom.runtime import materialize, ship_by_value, work_dir
from pairloom.schemas import MANIFEST
from pairloom.sources import manifest as man
from pairloom.sources import rolling, shards, tar, tar_ranges
from pairloom.streaming.monitor import loss_monitor, start_monitor
from pairloom.streaming.payloads import attach_arrivals
from pairloom.streaming.prepare import prepare_stream
from pairloom.streaming.state import batch_stream, land, log_window_stream, stateful_session
from registry import fixtures as fx

SEED = 12


def r(c: Column | str, digits: int = 6) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


def total(x: Column | str) -> Column:
    """Sum of all elements."""
    return r(F.aggregate(arrays.doubles(x), F.lit(0.0), lambda acc, v: acc + v))


def dot(x: Column | str) -> Column:
    """Sum of elements weighted by 1, 2, 3, ...: moves if any element or its place does."""
    weighted = F.transform(arrays.doubles(x), lambda v, i: v * (i + 1))
    return r(F.aggregate(weighted, F.lit(0.0), lambda acc, v: acc + v))


def long(df: DataFrame, *keys: str, x: str, digits: int = 6) -> DataFrame:
    rows = lat.to_long(df.withColumn(x, arrays.doubles(x)), *keys, x=x)
    return rows.withColumn("value", r("value", digits))


# Sources and sinks


def load_metadata_shards(spark, sf):
    source = fx.manifest(spark, sf)
    path = work_dir(spark, "metadata")
    shards.write_sample_shards(source, path, fx.SHARD_ROWS, order_by=["id"])
    n = -(-source.count() // fx.SHARD_ROWS)
    return man.load_metadata_shards(spark, path, n, "shard={i}", MANIFEST)


def _ingested(spark, sf):
    source, out = work_dir(spark, "metadata"), work_dir(spark, "ingest")
    pages = fx.pages(spark, sf)
    shards.write_sample_shards(pages, source, fx.SHARD_ROWS, order_by=["id"])
    landed = fx.payloads(spark, sf).join(fx.image_sizes(spark, sf), "id")
    n = -(-pages.count() // fx.SHARD_ROWS)
    done = ingest(
        spark, source, n, landed, out, pattern="shard={i}", url_col="href", caption_col="title", maxcount=fx.SHARD_ROWS
    )
    return done


def ingest_raw_shards(spark, sf):
    raw = spark.read.parquet(_ingested(spark, sf).raw)
    per_shard = raw.groupBy("shard").agg(F.count("*").alias("_n"))
    full = per_shard.agg(F.max("_n").alias("most"), F.count("*").alias("shards"))
    most, n = full.first()
    return raw.select(
        "id", "url", F.md5("data").alias("data_md5"), "out_w", "out_h", "resized", "reencode",
        F.lit(most).cast("bigint").alias("most"), F.lit(n).cast("bigint").alias("shards"),
    )


def ingest_retry(spark, sf):
    done = _ingested(spark, sf)
    return spark.read.parquet(done.retry).select("id", "url", "caption", "source", "status").withColumn(
        "n_manifest", F.lit(done.rows).cast("bigint")
    )


def write_manifest(spark, sf):
    path = work_dir(spark, "manifest")
    n = man.write_manifest(fx.manifest(spark, sf), path)
    return spark.read.parquet(path).withColumn("n_written", F.lit(n).cast("bigint"))


def project_manifest(spark, sf):
    return man.project_manifest(fx.pages(spark, sf), "href", "title")


def attach_payloads(spark, sf):
    joined = man.attach_payloads(fx.manifest(spark, sf), fx.payloads(spark, sf))
    return joined.select(
        "id", "url", "status", F.octet_length("data").cast("bigint").alias("n_bytes"),
        F.md5("data").alias("data_md5"),
    )


def retry_list(spark, sf):
    return man.retry_list(fx.manifest(spark, sf), fx.payloads(spark, sf)).select("id", "url")


def _tars(spark, sf) -> str:
    p = fx.table(spark, sf, "pages")
    rows = p.select(
        F.lpad(F.floor(F.col("page_id") / fx.SHARD_ROWS).cast("string"), 5, "0").alias("shard"),
        F.lpad(F.col("page_id").cast("string"), 9, "0").alias("key"),
        F.encode("html", "UTF-8").alias("jpg"),
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("caption"),
    )
    folder = work_dir(spark, "tars")
    fx.write_tars(rows, folder)
    return f"{folder}/*.tar"


def import_tar_shards(spark, sf):
    read = tar.import_tar_shards(spark, _tars(spark, sf))
    texts = samples.extract_caption(read.withColumn("note", F.decode("json", "UTF-8")), "note")
    return texts.select(
        "shard", "key", "caption", F.octet_length("jpg").cast("bigint").alias("jpg_bytes"),
        F.md5("jpg").alias("jpg_md5"), F.col("png").isNotNull().alias("has_png"),
    )


def read_tar_members(spark, sf):
    """Ranges much smaller than the files, so that members and samples cross them."""
    members = tar_ranges.read_tar_members(spark, _tars(spark, sf), range_bytes=8192)
    texts = samples.extract_caption(tar_ranges.tar_samples(members).withColumn("note", F.decode("json", "UTF-8")), "note")
    return texts.select(
        "shard", "key", "caption", F.octet_length("jpg").cast("bigint").alias("jpg_bytes"),
        F.md5("jpg").alias("jpg_md5"), F.col("png").isNotNull().alias("has_png"),
    )


def read_tar_range(spark, sf):
    folder = _tars(spark, sf).removesuffix("/*.tar")
    last = fx.table(spark, sf, "pages").agg(F.max("page_id")).first()[0] // fx.SHARD_ROWS
    members = tar_ranges.read_tar_members(spark, f"{folder}/{{00000..{last:05d}}}.tar").where("shard > '00000'")
    image = F.when(F.col("ext") == "jpg", F.md5("data"))
    return members.select("shard", "key", "ext", image.alias("data_md5"))


def decode_members(spark, sf):
    return tar.decode_members(fx.members(spark, sf)).select("id", "kind", "text")


def write_sample_shards(spark, sf):
    path = work_dir(spark, "shards")
    shards.write_sample_shards(fx.samples(spark, sf), path, fx.SHARD_ROWS, order_by=["id"])
    read = spark.read.parquet(path)
    return read.select("id", "shard", shards.shard_name().alias("name"), total("x").alias("x_sum"))


def write_arrival_shards(spark, sf):
    path = work_dir(spark, "arrival")
    shards.write_sample_shards(fx.table(spark, sf, "documents"), path, fx.SHARD_ROWS)
    return spark.read.parquet(path).select(F.col("doc_id").alias("id"), "shard")


def read_shard_range(spark, sf):
    path = work_dir(spark, "range")
    shards.write_sample_shards(fx.samples(spark, sf), path, fx.SHARD_ROWS, order_by=["id"])
    return shards.read_shard_range(spark, path, "{000001..000003}").select("id", "shard")


def count_assets(spark, sf):
    return man.count_assets(fx.assets(spark, sf))


# Projections, filters, predicates


def pick_first(spark, sf):
    p = fx.table(spark, sf, "pages").select(
        F.col("page_id").alias("id"),
        F.when(fx.h("page_id", "jpg") < 0.5, F.col("html")).alias("jpg"),
        F.when(fx.h("page_id", "png") < 0.5, F.col("url")).alias("png"),
    )
    return samples.pick_first(p, ["jpg", "png"], "image").select("id", F.md5("image").alias("image_md5"))


def extract_caption(spark, sf):
    return samples.extract_caption(fx.members(spark, sf), field="k").select("id", "caption")


def _split(spark, sf):
    read = samples.extract_caption(fx.members(spark, sf), field="k")
    rules = {"bad_json": samples.is_json("json"), "no_caption": F.col("caption").isNotNull()}
    return samples.split_valid(read, rules)


def split_valid(spark, sf):
    good, rejected = _split(spark, sf)
    return good.select("id", F.lit("ok").alias("verdict")).unionAll(
        rejected.select("id", F.col("reason").alias("verdict"))
    )


def reject_counts(spark, sf):
    return samples.reject_counts(_split(spark, sf)[1])


def with_index(spark, sf):
    return index.with_index(fx.captions(spark, sf).select("id", "caption"), "caption", "id").select("id", "idx")


def with_sample_key(spark, sf):
    numbered = index.with_index(fx.samples(spark, sf).select("id"), "id")
    return samples.with_sample_key(numbered).select("id", "idx", "key")


def assemble_samples(spark, sf):
    joined = samples.assemble_samples(*fx.keyed_parts(spark, sf))
    return joined.select(
        "key", "id", dot("latent").alias("latent_dot"), dot("prompt_embeds").alias("prompt_dot"),
        F.md5("caption").alias("caption_md5"),
    )


def to_training_pair(spark, sf):
    pair = samples.to_training_pair(samples.assemble_samples(*fx.keyed_parts(spark, sf)))
    return pair.select("key", dot("latent").alias("latent_dot"), dot("prompt_embeds").alias("prompt_dot"))


def round_bf16(spark, sf):
    return long(fx.latents(spark, sf).withColumn("x", arrays.round_bf16("x")), "id", x="x", digits=9)


def split_by_shard(spark, sf):
    sharded = fx.sharded_samples(spark, sf).select("id", "shard")
    last = sharded.agg(F.max("shard")).first()[0]
    train, test = samples.split_by_shard(sharded, (0, last - 1), (last, last))
    return train.withColumn("part", F.lit("train")).unionAll(test.withColumn("part", F.lit("test")))


# Images


def plan_ingest_resize(spark, sf):
    return images.plan_ingest_resize(fx.image_sizes(spark, sf), format_col="format")


def plan_center_crop(spark, sf):
    return images.plan_center_crop(fx.image_sizes(spark, sf)).drop("format")


def normalize_pixels(spark, sf):
    return long(fx.pixels(spark, sf).withColumn("px", arrays.normalize_pixels("px")), "id", x="px")


def denormalize_pixels(spark, sf):
    px = fx.pixels(spark, sf).withColumn("px", arrays.normalize_pixels("px"))
    back = px.withColumn("px", arrays.denormalize_pixels("px"))
    return lat.to_long(back, "id", x="px")


# Text


def build_vocab(spark, sf):
    return text.build_vocab(fx.captions(spark, sf), "caption", fx.VOCAB_SIZE)


def _encoded(spark, sf):
    return text.encode_fixed_length(fx.captions(spark, sf), fx.vocab(spark, sf), fx.LENGTH)


def encode_fixed_length(spark, sf):
    return lat.to_long(_encoded(spark, sf), "id", x="ids", value="token_id")


def encode_in_place(spark, sf):
    ids = text.encode_in_place(fx.captions(spark, sf), fx.vocab(spark, sf), fx.LENGTH)
    return lat.to_long(ids, "id", x="ids", value="token_id")


def expand_prompts(spark, sf):
    return text.expand_prompts(fx.captions(spark, sf), 3).select("id", "copy", F.md5("caption").alias("caption_md5"))


def encode_whole(spark, sf):
    return lat.to_long(_whole_ids(spark, sf), "id", x="ids", value="token_id")


def encode_whole_joined(spark, sf):
    ids = text.encode_whole(fx.captions(spark, sf), fx.vocab(spark, sf), broadcast_bytes=0)
    return lat.to_long(ids, "id", x="ids", value="token_id")


def _whole_ids(spark, sf):
    return text.encode_whole(fx.captions(spark, sf), fx.vocab(spark, sf)).select("id", "ids")


def _vectors(spark, sf):
    lookup = fx.latents(spark, sf).select(F.col("id").alias("token_id"), F.col("x").alias("vec"))
    return text.lookup_embeddings(_whole_ids(spark, sf), lookup)


def _pooled(spark, sf, **options):
    table = fx.latents(spark, sf).select(F.col("id").alias("token_id"), F.col("x").alias("vec"))
    return long(text.pool_embeddings(_whole_ids(spark, sf), table, dim=64, **options), "id", x="pooled")


def lookup_embeddings_salted(spark, sf):
    table = fx.latents(spark, sf).select(F.col("id").alias("token_id"), F.col("x").alias("vec"))
    found = text.lookup_embeddings(_whole_ids(spark, sf), table, broadcast_bytes=0)
    return found.select("id", "pos", "token_id", dot("vec").alias("vec_dot"))


def encode_in_place_joined(spark, sf):
    ids = text.encode_in_place(fx.captions(spark, sf), fx.vocab(spark, sf), fx.LENGTH, broadcast_bytes=0)
    return lat.to_long(ids, "id", x="ids", value="token_id")


def lookup_embeddings(spark, sf):
    return _vectors(spark, sf).select("id", "pos", "token_id", dot("vec").alias("vec_dot"))


def mean_pool(spark, sf):
    return _pooled(spark, sf)


def mean_pool_joined(spark, sf):
    return _pooled(spark, sf, broadcast_bytes=0)


def mean_pool_masked(spark, sf):
    return _pooled(spark, sf, mask_padding=True)


def encode_batches(spark, sf):
    def load():
        def encode(batch: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"id": batch["id"], "latent": [2.0 * x for x in batch["x"]]})

        return encode

    encoded = text.encode_batches(fx.latents(spark, sf), load, "id long, latent array<float>")
    return long(encoded, "id", x="latent")


def fill_condition(spark, sf):
    docs = fx.captions(spark, sf).select("id")
    cond = fx.latents(spark, sf).withColumnRenamed("x", "vec")
    filled = text.fill_condition(docs, cond, "zero", width=64)
    return filled.select("id", "is_conditional", total("cond").alias("cond_sum"), dot("cond").alias("cond_dot"))


def fill_condition_hot(spark, sf):
    docs = fx.captions(spark, sf).select("id")
    cond = fx.latents(spark, sf).withColumnRenamed("x", "vec")
    filled = text.fill_condition(docs, cond, "zero", width=64, hot_rows=0)
    return filled.select("id", "is_conditional", total("cond").alias("cond_sum"), dot("cond").alias("cond_dot"))


def fill_condition_empty_prompt(spark, sf):
    docs = fx.captions(spark, sf).select("id")
    cond = fx.latents(spark, sf).withColumnRenamed("x", "vec")
    # The mean of all vectors stands in for the encoding of "".
    empty = text.mean_pool(cond.select(F.lit(0).alias("id"), "vec"), dim=64).select(F.col("pooled").alias("vec"))
    filled = text.fill_condition(docs, cond, "empty_prompt", empty=empty)
    return filled.select("id", "is_conditional", total("cond").alias("cond_sum"), dot("cond").alias("cond_dot"))


# Latents


def sample_latent(spark, sf):
    return long(lat.sample_latent(fx.latents(spark, sf), "x", 0.1, SEED), "id", x="latent")


def normalize_latent(spark, sf):
    y = arrays.normalize_latent("x", fx.SHIFT, fx.SCALE)
    return long(fx.latents(spark, sf).withColumn("x", y), "id", x="x")


def normalize_latent_wide(spark, sf):
    y = arrays.normalize_latent("x", fx.SHIFT, fx.SCALE, wide=True)
    return long(fx.latents(spark, sf).withColumn("x", y), "id", x="x")


def denormalize_latent(spark, sf):
    y = arrays.denormalize_latent("x", fx.SHIFT, fx.SCALE)
    return long(fx.latents(spark, sf).withColumn("x", y), "id", x="x")


def _patches(spark, sf, wide=True):
    return lat.patchify(fx.latents(spark, sf), 4, 4, 4, 2, wide=wide)


def patchify(spark, sf):
    return long(_patches(spark, sf), "id", "patch", x="token")


def patchify_in_jvm(spark, sf):
    return long(_patches(spark, sf, wide=False), "id", "patch", x="token")


def unpatchify(spark, sf):
    return long(lat.unpatchify(_patches(spark, sf), 4, 4, 4, 2), "id", x="x")


def unpatchify_in_jvm(spark, sf):
    return long(lat.unpatchify(_patches(spark, sf), 4, 4, 4, 2, wide=False), "id", x="x")


def timestep_features(spark, sf):
    timed = flow.sample_timesteps(fx.latents(spark, sf).select("id"), seed=SEED)
    return long(timed.withColumn("f", arrays.timestep_features("t", 65)), "id", x="f")


# Epochs, batches, training rows


def _numbered(spark, sf):
    return index.with_index(fx.captions(spark, sf).select("id"), "id")


def resample_shards(spark, sf):
    sharded = fx.sharded_samples(spark, sf).select("id", "shard")
    n = sharded.select("shard").distinct().count()
    return epochs.resample_shards(sharded, n, SEED, 3).select("draw", "shard", "id")


def assign_shards(spark, sf):
    listed = fx.sharded_samples(spark, sf).select("shard").distinct()
    return epochs.assign_shards(listed, 3, 2)


def place_shards(spark, sf):
    rows = fx.sharded_samples(spark, sf).select("id", "shard")
    placed = epochs.place_shards(rows, 3, 2)
    return placed.withColumn("task", F.spark_partition_id())


def bounded_shuffle(spark, sf):
    return epochs.bounded_shuffle(_numbered(spark, sf), 32, SEED, 1).select("id", "idx", "pos")


def full_shuffle(spark, sf):
    return epochs.bounded_shuffle(fx.captions(spark, sf).select("id"), None, SEED, 1).select("id", "pos")


def with_batches(spark, sf):
    grouped = epochs.batched(epochs.with_batches(_numbered(spark, sf), 64), "id")
    return epochs.unbatched(grouped)


def batched(spark, sf):
    grouped = epochs.batched(epochs.with_batches(_numbered(spark, sf), 64), "id")
    ids = F.transform("rows", lambda row: row["id"])
    return grouped.select(
        "batch_id", F.size("rows").alias("n"), dot(ids.cast("array<double>")).alias("ids_dot")
    )


def epoch_limit(spark, sf):
    return epochs.epoch_limit(epochs.with_batches(_numbered(spark, sf), 64), 700, 64).select("id", "batch_id", "pos")


def caption_dropout(spark, sf):
    x = fx.latents(spark, sf).withColumnRenamed("x", "prompt_embeds")
    parts = [
        epochs.caption_dropout(x, 0.1, mode, SEED).withColumn("mode", F.lit(mode))
        for mode in ("reference", "drop")
    ]
    return parts[0].unionAll(parts[1]).select("id", "mode", "kept", dot("prompt_embeds").alias("prompt_dot"))


def sample_timesteps(spark, sf):
    rows = epochs.with_batches(_numbered(spark, sf), 64)
    drawn = [
        flow.sample_timesteps(rows, mode, SEED, 64).select("id", F.lit(mode).alias("mode"), r("t").alias("t"))
        for mode in ("logit_normal", "stratified", "uniform")
    ]
    return drawn[0].unionAll(drawn[1]).unionAll(drawn[2])


def _flow_rows(spark, sf, wide=None):
    x = fx.latents(spark, sf).withColumn("x", arrays.normalize_latent("x", fx.SHIFT, fx.SCALE))
    return flow.make_flow_rows(flow.sample_timesteps(x, seed=SEED), SEED, wide=wide)


def make_flow_rows(spark, sf, wide=None):
    rows = _flow_rows(spark, sf, wide).select("id", F.posexplode(F.arrays_zip("eps", "z_t", "v")).alias("pos", "e"))
    return rows.select("id", "pos", r("e.eps").alias("eps"), r("e.z_t").alias("z_t"), r("e.v").alias("v"))


def make_flow_rows_wide(spark, sf):
    return make_flow_rows(spark, sf, wide=True)


def _losses(spark, sf, wide=False):
    rows = _flow_rows(spark, sf).withColumn("batch_id", F.floor(F.col("id") / 64).cast("bigint"))
    guesses = fx.latents(spark, sf).select("id", F.transform("x", lambda a: a.cast("double") * 0.5).alias("v_hat"))
    return flow.flow_loss(rows, guesses, wide=wide)


def flow_loss(spark, sf, wide=False):
    return _losses(spark, sf, wide).select("id", r("t").alias("t"), r("loss").alias("loss"))


def flow_loss_wide(spark, sf):
    return flow_loss(spark, sf, wide=True)


def batch_loss(spark, sf):
    return flow.batch_loss(_losses(spark, sf)).withColumn("loss", r("loss"))


def _guided(spark, sf, wide=False):
    cond = fx.velocities(spark, sf)
    # Some steps have no unconditional velocity and keep the conditional one.
    some = cond.where(uniform(0, "uncond", "key", "step") < 0.7)
    return flow.guide(cond, some.withColumn("v", F.transform("v", lambda a: a * 0.5)), 4.0, wide=wide)


def guide(spark, sf, wide=False):
    return _guided(spark, sf, wide).select("key", "step", total("v").alias("v_sum"), dot("v").alias("v_dot"))


def guide_wide(spark, sf):
    return guide(spark, sf, wide=True)


def replay_states_wide(spark, sf):
    return replay_states(spark, sf, wide=True)


def replay_predictions_wide(spark, sf):
    return replay_predictions(spark, sf, wide=True)


def replay_states(spark, sf, wide=None):
    states = flow.replay_states(fx.start_noise(spark, sf), fx.velocities(spark, sf), fx.STEPS, dim=64, wide=wide)
    return states.select("key", "step", total("z").alias("z_sum"), dot("z").alias("z_dot"))


def replay_predictions(spark, sf, wide=None):
    seen = flow.replay_predictions(fx.start_noise(spark, sf), fx.velocities(spark, sf), fx.STEPS, dim=64, wide=wide)
    return seen.select("key", "step", total("z").alias("z_sum"), dot("z").alias("z_dot"))


def _epoch_items(rows) -> int:
    """Half as many again as there are, and not a multiple of the batch."""
    return rows.count() * 3 // 2 + 7


def plan_epoch_query(spark, sf):
    sharded = fx.sharded_samples(spark, sf)
    return plan_epoch(sharded, epoch=3, seed=SEED, b=16, max_items=_epoch_items(sharded), resampled=True, buf=100)


def plan_epoch_one_pass(spark, sf):
    sharded = fx.sharded_samples(spark, sf)
    return plan_epoch(sharded, epoch=3, seed=SEED, b=16, max_items=sharded.count() - 5, buf=100)


# Metrics


def loss_by_bin(spark, sf):
    return metrics.loss_by_bin(fx.step_log(spark, sf)).withColumn("loss", r("loss"))


def train_log(spark, sf):
    log = metrics.train_log(fx.step_log(spark, sf), 100, 64, max_steps=100_000)
    return log.withColumn("loss", r("loss")).withColumn("lr", r("lr", 10))


def with_learning_rate(spark, sf):
    steps = fx.step_log(spark, sf).select("step")
    return metrics.with_learning_rate(steps, 1e-4, 10_000).withColumn("lr", r("lr", 10))


def eval_summary(spark, sf):
    log = fx.step_log(spark, sf).withColumn("batch_id", F.floor(F.col("step") / 64).cast("bigint"))
    return metrics.eval_summary(flow.batch_loss(log), 21).withColumn("loss", r("loss"))


def with_run_events(spark, sf):
    return metrics.with_run_events(fx.step_log(spark, sf).select("step"), 100, 2_500, 2_500)


def log_windows(spark, sf):
    return metrics.log_windows(fx.run_log(spark, sf), fx.LOG_EVERY).withColumn("loss", r("loss"))


def eval_records(spark, sf):
    samples_, steps = fx.evaluations(spark, sf)
    found = metrics.eval_records(samples_, steps, b=64, batches=4)
    bins = [r(f"bin_{i}").alias(f"bin_{i}") for i in range(10)]
    return found.select("run", "step", "epoch", "datapoints", r("loss").alias("loss"), *bins)


def loader_order(spark, sf):
    rows = fx.sharded_samples(spark, sf).select(F.col("shard").alias("draw"), "id")
    seen = buffer.loader_order(rows, 2, 3, 16, SEED, 3, worker_buffer=100, node_buffer=128, initial=20)
    return seen.select("node", "worker", "batch_id", "pos", "id")


def roll_shards(spark, sf):
    rows = index.with_index(fx.captions(spark, sf), "id").select("id", "idx", F.octet_length("caption").alias("bytes"))
    return rolling.roll_shards(rows, 40, 60_000, block_rows=100).select("id", "shard")


# Streams


def log_windows_stream(spark, sf):
    rows = fx.run_log(spark, sf)
    # The second half arrives in two parts that are not in order.
    half = rows.agg(F.max("step")).first()[0] // 2
    late, odd = F.col("step") > half, F.col("step") % 2 == 1
    folder, files = fx.chunked(rows, "run-log", [~late, late & odd, late & ~odd])
    session = stateful_session(spark)
    stream = session.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(folder)
    out, checkpoint = work_dir(spark, "log-windows"), work_dir(spark, "log-windows-state")
    land(log_window_stream(stream, fx.LOG_EVERY, delay="3650 days"), out, checkpoint).awaitTermination()
    return spark.read.parquet(out).withColumn("loss", r("loss"))


def batch_stream_query(spark, sf):
    sharded = fx.sharded_samples(spark, sf)
    items = _epoch_items(sharded)
    drawn = [
        epochs.fill_epoch(sharded, items, SEED, e).select(
            (F.col("draw") % 3).alias("worker"), F.lit(e).alias("epoch"), "idx", "id"
        )
        for e in (3, 4)
    ]
    rows = materialize(drawn[0].unionAll(drawn[1]), "drawn")
    half = F.col("idx") < items // 2
    folder, files = fx.chunked(rows, "loader", [(F.col("epoch") == e) & part for e in (3, 4) for part in (half, ~half)])
    session = stateful_session(spark)
    stream = session.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(folder)
    out, checkpoint = work_dir(spark, "batches"), work_dir(spark, "batches-state")
    land(batch_stream(stream, 16), out, checkpoint).awaitTermination()
    return spark.read.parquet(out)


def attach_arrivals_query(spark, sf):
    start = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id"))
    asked = fx.manifest(spark, sf).select("id", "url", start.alias("requested_at"))
    landed_at = F.timestamp_micros(F.unix_micros(start) + (F.col("elapsed_s") * 1e6).cast("bigint"))
    landed = fx.payloads(spark, sf).select("id", "data", landed_at.alias("landed_at"))
    # A last row on both sides, a year later, lets the streams pass every deadline.
    end = F.timestamp_seconds(F.lit(1_800_000_000))
    closing = spark.range(1).select(F.lit(-1).cast("bigint").alias("id"))
    asked = asked.unionByName(closing.select("id", F.lit("").alias("url"), end.alias("requested_at")))
    landed = landed.unionByName(closing.select("id", F.lit(None).cast("binary").alias("data"), end.alias("landed_at")))
    half = asked.agg(F.max("id")).first()[0] // 2
    parts = [(F.col("id") >= 0) & (F.col("id") <= half), F.col("id") > half, F.col("id") < 0]

    def stream(df, label):
        folder, files = fx.chunked(df, label, parts)
        return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(folder)

    joined = attach_arrivals(stream(asked, "asked"), stream(landed, "landed"))
    out, checkpoint = work_dir(spark, "arrivals"), work_dir(spark, "arrivals-state")
    land(joined, out, checkpoint).awaitTermination()
    found = spark.read.parquet(out).where("id >= 0")
    return found.select(
        "id", "url", "status", F.octet_length("data").cast("bigint").alias("n_bytes"), F.md5("data").alias("data_md5")
    )


def prepare_observed(spark, sf):
    done = prepare(fx.raw_samples(spark, sf), fx.vocab(spark, sf), shift=fx.SHIFT, scale=fx.SCALE)
    counts = write_prepared(done, work_dir(spark, "observed"))
    return spark.createDataFrame(sorted(counts.items()), "verdict string, n bigint")


def prepare_stream_observed(spark, sf):
    rows = []
    source, out, checkpoint = (work_dir(spark, f"stream-{part}") for part in ("in", "out", "state"))
    # Three micro-batches, of as many files as the rows ask for.
    files = fx.file_count(-(-fx.table(spark, sf, "documents").count() // 3))
    fx.raw_samples(spark, sf).repartition(3 * files).write.parquet(source)
    prepare_stream(
        spark, source, out, checkpoint, fx.vocab(spark, sf), shift=fx.SHIFT, scale=fx.SCALE, max_files=files,
        report=lambda batch, counts: rows.extend(counts.items()),
    ).awaitTermination()
    return spark.createDataFrame(rows, "verdict string, n bigint").groupBy("verdict").agg(F.sum("n").alias("n"))


def _prepared(df):
    return df.select(
        "id", "url", F.md5("caption").alias("caption_md5"), F.size("ids").alias("n_ids"),
        dot(F.col("ids").cast("array<double>")).alias("ids_dot"), dot("latent").alias("latent_dot"),
    )


def prepare_batch(spark, sf):
    done = prepare(fx.raw_samples(spark, sf), fx.vocab(spark, sf), shift=fx.SHIFT, scale=fx.SCALE)
    return _prepared(done.where("verdict = 'ok'"))


def _stream(spark, sf):
    source, out, checkpoint = (work_dir(spark, f"stream-{part}") for part in ("in", "out", "state"))
    fx.raw_samples(spark, sf).write.parquet(source)
    prepare_stream(
        spark, source, out, checkpoint, fx.vocab(spark, sf), shift=fx.SHIFT, scale=fx.SCALE
    ).awaitTermination()
    return out


def prepare_stream_query(spark, sf):
    return _prepared(spark.read.parquet(_stream(spark, sf)).where("verdict = 'ok'"))


def prepare_stream_rejected(spark, sf):
    rejected = spark.read.parquet(_stream(spark, sf)).where("verdict <> 'ok'")
    return rejected.select("id", "url", F.col("verdict").alias("reason"))


def loss_monitor_query(spark, sf):
    events = fx.table(spark, sf, "events")
    # A pattern matches the table whether it is one file or a folder of files.
    files = spark.readStream.schema(events.schema).parquet(f"{sf.rstrip('/')}/events.parquet*")
    stream = files.select(
        F.col("ts").cast("timestamp").alias("ts"), fx.h("event_id", "t").alias("t"),
        F.col("value").alias("loss"),
    )
    out, checkpoint = work_dir(spark, "monitor"), work_dir(spark, "monitor-state")
    start_monitor(loss_monitor(stream), out, checkpoint, once=True).awaitTermination()
    closed = spark.read.parquet(out)
    return closed.select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"),
        "bin", r("loss").alias("loss"), "n",
    )


# Whole jobs


def build_samples_query(spark, sf):
    def load():
        def encode(batch: pd.DataFrame) -> pd.DataFrame:
            sizes = [[len(i) / 1000, len(c.encode()) / 10] for i, c in zip(batch["image"], batch["caption"])]
            return pd.DataFrame({
                "source_shard": batch["source_shard"], "source_key": batch["source_key"],
                "caption": batch["caption"], "latent_mean": sizes,
                "latent_std": [[0.5, 0.25]] * len(batch), "prompt_embeds": [s[::-1] for s in sizes],
            })

        return encode

    pairs, _ = read_pairs(spark, _tars(spark, sf))
    out = work_dir(spark, "samples")
    build_samples(pairs, out, load, seed=SEED, maxcount=fx.SHARD_ROWS, source="md5")
    return spark.read.parquet(out).select(
        "key", "shard", "source_shard", "source_key", "caption",
        *[r(F.col("latent")[i].cast("double"), 9).alias(f"latent_{i}") for i in range(2)],
        *[r(F.col("prompt_embeds")[i].cast("double"), 9).alias(f"prompt_{i}") for i in range(2)],
    )


def _training_samples(spark, sf):
    twice = F.transform("x", lambda v: v * F.lit(2).cast("float"))
    return fx.sharded_samples(spark, sf).select(
        "id", "shard", F.col("x").alias("latent"), twice.alias("prompt_embeds")
    )


def train_epoch(spark, sf):
    pool = _training_samples(spark, sf)
    plan = plan_epoch(pool, epoch=3, seed=SEED, b=16, max_items=_epoch_items(pool), resampled=True, buf=100)
    rows = training_rows(
        attach_rows(plan, pool), shift=fx.SHIFT, scale=fx.SCALE, seed=SEED, epoch=3, dropout="reference"
    )
    losses = step_losses(rows, None, first_step=1000, epoch=3)
    kept = rows.groupBy((F.col("batch_id") + 1000).alias("step")).agg(F.count_if("kept").alias("kept"))
    return losses.join(kept, "step").withColumn("loss", r("loss"))


def _evaluated(spark, sf):
    pool = _training_samples(spark, sf).drop("shard")
    return evaluate(pool, shift=fx.SHIFT, scale=fx.SCALE, seed=SEED, b=16)


def evaluate_summary(spark, sf):
    return _evaluated(spark, sf)[0].withColumn("loss", r("loss"))


def evaluate_bins(spark, sf):
    return _evaluated(spark, sf)[1].withColumn("loss", r("loss"))


def decode_steps(spark, sf):
    cond = fx.velocities(spark, sf)
    uncond = cond.withColumn("v", F.transform("v", lambda a: a * 0.5))
    steps = decoded_steps(
        fx.start_noise(spark, sf), cond, uncond, n=fx.STEPS, dim=64, shift=fx.SHIFT, scale=fx.SCALE
    )
    pixels = to_pixels(steps, "latent")
    return pixels.select("key", "step", dot("latent").alias("latent_dot"), dot("pixels").alias("pixel_dot"))


# Flagship


def loss_profile_query(spark, sf):
    return loss_profile(fx.latents(spark, sf), shift=fx.SHIFT, scale=fx.SCALE, seed=SEED).withColumn(
        "loss", r("loss")
    )


_PLAIN = (
    load_metadata_shards, write_manifest, project_manifest, attach_payloads, retry_list,
    import_tar_shards, decode_members, write_sample_shards, write_arrival_shards, read_shard_range,
    count_assets, pick_first, extract_caption, split_valid, reject_counts, with_index,
    with_sample_key, assemble_samples, to_training_pair, round_bf16, split_by_shard,
    plan_ingest_resize, plan_center_crop, normalize_pixels, denormalize_pixels, build_vocab,
    encode_fixed_length, encode_in_place, expand_prompts, lookup_embeddings, mean_pool,
    mean_pool_masked, encode_batches, fill_condition, fill_condition_empty_prompt, sample_latent,
    normalize_latent, normalize_latent_wide, denormalize_latent, patchify,
    patchify_in_jvm, unpatchify, unpatchify_in_jvm, timestep_features, resample_shards, assign_shards, place_shards, bounded_shuffle, full_shuffle,
    plan_epoch_one_pass, encode_whole, encode_whole_joined, log_windows, eval_records, loader_order, roll_shards,
    log_windows_stream, ingest_raw_shards, ingest_retry, prepare_observed, prepare_stream_observed, read_tar_members, read_tar_range,
    with_batches, batched, epoch_limit, caption_dropout, sample_timesteps, make_flow_rows,
    flow_loss, batch_loss, guide, replay_states, replay_predictions, loss_by_bin, train_log,
    with_learning_rate, eval_summary, with_run_events, prepare_batch, prepare_stream_rejected,
    train_epoch, evaluate_summary, evaluate_bins, decode_steps,
    lookup_embeddings_salted, encode_in_place_joined, mean_pool_joined, fill_condition_hot,
    make_flow_rows_wide, flow_loss_wide, guide_wide, replay_states_wide, replay_predictions_wide,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "loss_profile": loss_profile_query,
    "plan_epoch": plan_epoch_query,
    "build_samples": build_samples_query,
    "prepare_stream": prepare_stream_query,
    "loss_monitor": loss_monitor_query,
    "batch_stream": batch_stream_query,
    "attach_arrivals": attach_arrivals_query,
    **{f.__name__: f for f in _PLAIN},
}

ship_by_value(__name__)
