"""Flow-matching loss per timestep bin, from latents to the ten-row report."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pairloom.functions.arrays import normalize_latent
from pairloom.operators.flow import flow_loss, make_flow_rows, sample_timesteps
from pairloom.operators.metrics import loss_by_bin


def loss_profile(
    latents: DataFrame, predictions: DataFrame | None = None, *, shift: float, scale: float,
    seed: int = 12, key: str = "id", x: str = "x", mode: str = "logit_normal", source: str = "md5",
) -> DataFrame:
    """(bin, loss, n). Without predictions the model is taken to predict velocity zero.

    One pass over the latents; only one partial row per bin and task is shuffled.
    """
    wide = source == "philox"
    ready = latents.withColumn(x, normalize_latent(x, shift, scale, wide))
    timed = sample_timesteps(ready, mode, seed, key=key)
    rows = make_flow_rows(timed, seed, key=key, x=x, source=source)
    losses = flow_loss(rows, predictions, key=key, wide=wide)
    return loss_by_bin(losses)
