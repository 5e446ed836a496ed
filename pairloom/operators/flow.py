"""Flow matching: timesteps, training rows, loss, guidance and trajectory replay."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairloom.functions import kernels
from pairloom.functions.arrays import doubles, mean_squared_error, zeros
from pairloom.functions.rand import inverse_normal, normal, sigmoid, uniform
from pairloom.operators.latents import noise
from pairloom.runtime import ship_by_value
from pairloom.schemas import checked_width

# Up to this width trajectories run as one window sum per dimension.
PLAIN_WIDTH = 128


def sample_timesteps(
    df: DataFrame, mode: str = "logit_normal", seed: int = 12, b: int | None = None, *,
    key: str = "id", epoch: int = 0, out: str = "t",
) -> DataFrame:
    """Draw t in (0, 1) per sample.

    ``stratified`` puts one draw in each of the batch's strata; it needs ``batch_id`` and
    ``pos``. With ``b`` given, batches are those of ``with_batches`` and only the last can be
    short, so its size follows from the row count. Without, batches are counted in a window,
    which moves every row.
    """
    if mode == "logit_normal":
        return df.withColumn(out, sigmoid(normal(seed, "t", epoch, key)))
    u = uniform(seed, "t", epoch, key)
    if mode == "uniform":
        return df.withColumn(out, u)
    if mode != "stratified":
        raise ValueError(f"unknown mode {mode!r}")
    if b is None:
        size = F.count("*").over(Window.partitionBy("batch_id"))
    else:
        total = df.agg(F.count("*")).scalar()
        size = F.least(F.lit(b), total - F.col("batch_id") * b)
    sized = df.withColumn("_size", size.cast("double"))
    z = F.col("pos") / F.col("_size") + u / F.col("_size")
    return sized.withColumn(out, sigmoid(inverse_normal(z))).drop("_size")


def make_flow_rows(
    df: DataFrame, seed: int = 12, *, key: str = "id", epoch: int = 0, x: str = "x", t: str = "t",
    source: str = "md5", wide: bool | None = None,
) -> DataFrame:
    """Add noise ``eps``, the interpolated ``z_t`` and the target velocity ``v``.

    ``wide`` interpolates in Arrow batches, which pays for wide latents; by default it is on
    with ``source="philox"``.
    """
    wide = source == "philox" if wide is None else wide
    drawn = df.withColumn("eps", noise(F.size(x), source, seed, "eps", epoch, key))
    if wide:
        both = drawn.withColumn("_flow", kernels.interpolate(x, t, "eps"))
        return both.select("*", "_flow.z_t", "_flow.v").drop("_flow")
    data, time = doubles(x), F.col(t)
    return drawn.select(
        "*",
        F.zip_with(data, "eps", lambda a, e: (1.0 - time) * a + time * e).alias("z_t"),
        F.zip_with(data, "eps", lambda a, e: e - a).alias("v"),
    )


def flow_loss(
    rows: DataFrame, predictions: DataFrame | None = None, *, key: str = "id", v: str = "v",
    predicted: str = "v_hat", wide: bool = False,
) -> DataFrame:
    """``loss`` per sample: mean of ``(v - v_hat)^2``. No predictions means velocity zero.

    Given predictions, a sample without one, or with one of another width, fails the job: left
    out it would change the mean. Only the loss leaves the projection; the arrays are read but
    not passed on.
    """
    if predictions is None:
        paired, guess = rows, zeros(F.size(v))
    else:
        paired = rows.join(predictions.select(key, F.col(predicted).alias("_hat")), key, "left")
        name = F.concat(F.lit("sample "), F.coalesce(F.col(key).cast("string"), F.lit("NULL")))
        guess = (
            F.when(F.size("_hat") == F.size(v), F.col("_hat"))
            .when(F.col("_hat").isNull(), F.raise_error(F.concat(name, F.lit(": no prediction"))))
            .otherwise(F.raise_error(F.concat(name, F.lit(": prediction of another width"))))
        )
    kept = [c for c in rows.columns if c not in (v, "eps", "z_t", "x")]
    return paired.select(*kept, mean_squared_error(v, guess, wide).alias("loss"))


def batch_loss(losses: DataFrame, batch: str = "batch_id") -> DataFrame:
    return losses.groupBy(batch).agg(F.avg("loss").alias("loss"), F.count("*").alias("n"))


def guide(
    cond: DataFrame, uncond: DataFrame | None = None, cfg: float = 2.0, *,
    on: tuple[str, ...] = ("key", "step"), v: str = "v", wide: bool = False,
) -> DataFrame:
    """``v_u + cfg (v_c - v_u)``; rows without an unconditional velocity keep ``v_c``.

    Velocities of different widths fail the job. They are widened to double after the join, so
    the exchange carries them as they are stored, and nothing is exchanged between tables placed by
    the same part of ``on``. The sides are about equal, so none is broadcast, whatever its estimate.
    """
    if uncond is None:
        return cond.select(*on, doubles(v).alias(v))
    # Tables placed by a part of the keys, as by trajectory, are placed well enough.
    cond.sparkSession.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    joined = cond.join(uncond.select(*on, F.col(v).alias("_u")).hint("merge"), list(on), "left")
    if wide:
        return joined.select(*on, kernels.blend(doubles(v), doubles("_u"), cfg).alias(v))
    mixed = F.zip_with(doubles(v), doubles("_u"), lambda c, u: u + F.lit(float(cfg)) * (c - u))
    return joined.select(
        *on,
        F.when(F.col("_u").isNull(), doubles(v))
        .when(F.size(v) == F.size("_u"), mixed)
        .otherwise(F.raise_error("rows differ in length"))
        .alias(v),
    )


def _moves(noise_rows: DataFrame, velocity: DataFrame, n: int, key: str) -> DataFrame:
    """(key, step, c): the start as step 0, then ``-v/n`` per step.

    A state is the running sum of these, so start and velocities need no join.
    """
    start = noise_rows.select(key, F.lit(0).alias("step"), doubles("z").alias("c"))
    moves = velocity.select(
        key, F.col("step").cast("int"), F.transform(doubles("v"), lambda v: -v / n).alias("c")
    )
    return start.unionByName(moves)


def _replay(noise_rows, velocity, n, key, dim, predictions, wide) -> DataFrame:
    if n < 1:
        raise ValueError("n must be at least 1")
    rows = checked_width(_moves(noise_rows, velocity, n, key), "c", dim)
    kind = {f.name: f.dataType.simpleString() for f in rows.schema}[key]
    if dim <= PLAIN_WIDTH if wide is None else not wide:
        order = Window.partitionBy(key).orderBy("step")
        last = -1 if predictions else Window.currentRow
        so_far = order.rowsBetween(Window.unboundedPreceding, last)
        left = (F.lit(n + 1) - F.col("step")).cast("double")

        # Without its start a trajectory has no states.
        begun = F.first("step").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) == 0
        no_start = F.raise_error(F.concat(F.col(key).cast("string"), F.lit(": trajectory without a start")))

        def element(c: str):
            running = F.sum(c).over(so_far)
            if predictions:
                return F.when(F.col("step") == 0, F.col(c)).otherwise(running + left * F.col(c))
            return running

        # Scalars replace the array before the shuffle, which would else carry both.
        names = [f"_{i}" for i in range(dim)]
        apart = rows.select(key, "step", *[F.col("c")[i].alias(c) for i, c in enumerate(names)])
        states = F.array(*[element(c) for c in names])
        return apart.select(key, "step", F.when(begun, states).otherwise(no_start).alias("z"))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("step")
        if frame["step"].iloc[0] != 0:
            raise ValueError(f"{frame[key].iloc[0]}: trajectory without a start")
        c = np.stack(frame["c"].to_numpy())
        states = np.cumsum(c, axis=0)
        if predictions:
            steps = frame["step"].to_numpy()[1:, None]
            states = np.concatenate([c[:1], states[:-1] + (n + 1 - steps) * c[1:]])
        return pd.DataFrame({key: frame[key], "step": frame["step"], "z": list(states)})

    return rows.groupBy(key).applyInPandas(run, f"{key} {kind}, step int, z array<double>")


def replay_states(
    noise_rows: DataFrame, velocity: DataFrame, n: int = 50, *, dim: int, key: str = "key",
    wide: bool | None = None,
) -> DataFrame:
    """Euler states of each trajectory: (key, step 0..n, z), step 0 being the start.

    ``noise_rows`` is (key, z), ``velocity`` (key, step, v) with steps 1..n in the order they
    are taken, at times (n + 1 - step) / n. A group is one trajectory of n + 1 rows. Arrays
    must be ``dim`` wide and every trajectory must have its start; else the job fails. ``wide``
    sums whole arrays in groups instead of one window per dimension; by default the width decides.
    """
    return _replay(noise_rows, velocity, n, key, dim, predictions=False, wide=wide)


def replay_predictions(
    noise_rows: DataFrame, velocity: DataFrame, n: int = 50, *, dim: int, key: str = "key",
    wide: bool | None = None,
) -> DataFrame:
    """The start, then per step the clean sample its velocity points at.

    With i = n + 1 - step left to go, that is the state before the step minus ``i v / n``.
    """
    return _replay(noise_rows, velocity, n, key, dim, predictions=True, wide=wide)


ship_by_value(__name__)
