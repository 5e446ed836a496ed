"""Losses of training epochs and evaluations, given a table of predicted velocities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.functions.arrays import normalize_latent
from pairloom.operators.epochs import caption_dropout, epoch_limit, with_batches
from pairloom.operators.flow import batch_loss, flow_loss, make_flow_rows, sample_timesteps
from pairloom.operators.index import with_index
from pairloom.operators.metrics import eval_summary, loss_by_bin
from pairloom.runtime import materialize


def training_rows(
    placed: DataFrame, *, shift: float, scale: float, seed: int, epoch: int, dropout: str, p: float = 0.1,
    mode: str = "logit_normal", source: str = "md5",
) -> DataFrame:
    """Model inputs and targets of samples that have a ``batch_id`` and ``pos``.

    Draws belong to the place in the epoch, ``slot``, not to the sample: one that comes up
    twice gets two timesteps and two noises.
    """
    slots = placed.withColumn("slot", F.concat_ws("-", "batch_id", "pos"))
    dropped = caption_dropout(slots, p, dropout, seed, key="slot", epoch=epoch)
    x = normalize_latent("latent", shift, scale, wide=source == "philox")
    timed = sample_timesteps(dropped.withColumn("x", x), mode, seed, key="slot", epoch=epoch)
    return make_flow_rows(timed, seed, key="slot", epoch=epoch, source=source).drop("latent")


def step_losses(
    rows: DataFrame, predictions: DataFrame | None, *, first_step: int, epoch: int, wide: bool = False
) -> DataFrame:
    """(step, epoch, loss, n) per batch, steps counted on from ``first_step``."""
    losses = flow_loss(rows, predictions, key="slot", wide=wide)
    per_batch = batch_loss(losses)
    return per_batch.select(
        (F.col("batch_id") + first_step).alias("step"), F.lit(epoch).alias("epoch"), "loss", "n"
    )


def evaluate(
    samples: DataFrame, predictions: DataFrame | None = None, *, shift: float, scale: float,
    seed: int, b: int = 64, max_items: int | None = None, batches: int | None = None,
    key: str = "id", wide: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(summary, loss by timestep bin) of held-out samples in key order.

    All samples count unless ``max_items`` or ``batches`` limits them. Only keys are sorted;
    latents are joined to their places afterwards. The losses, one narrow row per sample, are
    stored once and both reports read them.
    """
    order = with_batches(with_index(samples.select(key), key), b)
    if max_items is not None:
        order = epoch_limit(order, max_items, b)
    if batches is not None:
        order = order.where(F.col("batch_id") < batches)
    rows = training_rows(
        order.drop("idx").join(samples, key), shift=shift, scale=scale, seed=seed, epoch=0,
        dropout="reference", source="philox" if wide else "md5",
    )
    losses = flow_loss(rows, predictions, key="slot", wide=wide).select("slot", "batch_id", "t", "loss")
    losses = materialize(losses, "losses")
    return eval_summary(batch_loss(losses)), loss_by_bin(losses)
