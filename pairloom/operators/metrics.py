"""Training and evaluation metrics over step and loss tables."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.operators.asof import as_of
from pairloom.runtime import as_column


def timestep_bin(t: Column | str, bins: int = 10) -> Column:
    """Bin of a timestep; what lies outside [0, 1) counts in the first or last, NULL in none."""
    time = F.col(t) if isinstance(t, str) else t
    place = F.greatest(F.least(F.floor(time * bins), F.lit(bins - 1)), F.lit(0))
    return F.when(time.isNotNull(), place).cast("int")


def loss_by_bin(
    df: DataFrame, bins: int = 10, *, t: str = "t", loss: str = "loss", by: tuple[str, ...] = ()
) -> DataFrame:
    """(by..., bin, loss, n) for every bin of every group; an empty one has loss 0.0 and count 0.

    ``by`` are group keys such as a run or a log window. A row without a timestep fails the
    job. Sums are kept per bin beside each other, so each group is one row until the end.
    """
    place = F.coalesce(timestep_bin(t, bins), F.raise_error("a row has no timestep").cast("int"))
    sums = df.select(*by, place.alias("_bin"), F.col(loss).alias("_loss")).groupBy(*by).agg(
        *[F.sum(F.when(F.col("_bin") == b, F.col("_loss"))).alias(f"_s{b}") for b in range(bins)],
        *[F.count(F.when(F.col("_bin") == b, 1)).alias(f"_n{b}") for b in range(bins)],
    )
    each = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(b).alias("bin"),
                    (F.coalesce(f"_s{b}", F.lit(0.0)) / F.greatest(f"_n{b}", F.lit(1))).alias("loss"),
                    F.col(f"_n{b}").alias("n"),
                )
                for b in range(bins)
            ]
        )
    )
    return sums.select(*by, each.alias("_each")).select(*by, "_each.*")


def learning_rate(step: Column, base_lr: float, max_steps: int) -> Column:
    """Linear warm-up over a twentieth of the run, then half a cosine down to 0."""
    warm = max_steps // 20
    s = step.cast("double")
    progress = (s - warm) / max(1, max_steps - warm)
    cosine = F.greatest(F.lit(0.0), F.lit(0.5) * (F.lit(1.0) + F.cos(F.lit(math.pi) * progress)))
    return F.when(s < warm, s / max(1, warm)).otherwise(cosine) * F.lit(base_lr)


def with_learning_rate(
    steps: DataFrame, base_lr: float, max_steps: int, *, step: str = "step", out: str = "lr"
) -> DataFrame:
    return steps.withColumn(out, learning_rate(F.col(step), base_lr, max_steps))


def with_run_events(
    steps: DataFrame, log: int = 100, ckpt: int = 10_000, evaluate: int = 2_500, *, step: str = "step"
) -> DataFrame:
    """Flag what happens at each step, numbered before it is counted.

    Logging looks at the number before the increment, checkpoints and evaluation at the one
    after; a final checkpoint closes the run.
    """
    g = F.col(step)
    done = g + 1
    return steps.select(
        "*",
        (g % log == 0).alias("is_log"),
        (done % ckpt == 0).alias("is_checkpoint"),
        # Written so that an evaluation every step stays "remainder 1", i.e. never.
        (done % evaluate == 1).alias("is_eval"),
        (g == steps.agg(F.max(step)).scalar()).alias("is_final"),
    )


def train_log(
    steps: DataFrame, log_every: int = 100, b: int = 64, *, base_lr: float = 1e-4,
    max_steps: int = 200_000, step: str = "step",
) -> DataFrame:
    """(step, epoch, loss, datapoints, lr) at logged steps.

    Data points count the steps before this one; the rate is already the next step's.
    """
    g = F.col(step)
    logged = steps.where(g % log_every == 0)
    return logged.select(
        step, "epoch", "loss", (g * b).alias("datapoints"),
        learning_rate(g + 1, base_lr, max_steps).alias("lr"),
    )


def eval_summary(batch_losses: DataFrame, n: int | None = None, *, batch: str = "batch_id") -> DataFrame:
    """Unweighted mean loss of all batches, or of the first ``n``."""
    used = batch_losses if n is None else batch_losses.where(F.col(batch) < n)
    return used.agg(
        F.avg("loss").alias("loss"), F.count("*").alias("batches")
    )


def log_window(step: Column | str, every: int) -> Column:
    """The window that a step is logged with: the log at a multiple of ``every`` closes the steps up to it."""
    return F.floor((as_column(step) + (every - 1)) / every).cast("bigint")


def log_windows(
    df: DataFrame, every: int, bins: int = 10, *, by: tuple[str, ...] = ("run",), step: str = "step", t: str = "t",
    loss: str = "loss", whole: bool = False,
) -> DataFrame:
    """(by..., window, bin, loss, n): loss per timestep bin since the log before, of one row per step.

    ``whole`` leaves out windows whose steps are not all there, such as the last of a run.
    """
    placed = df.withColumn("window", log_window(step, every))
    means = loss_by_bin(placed, bins, t=t, loss=loss, by=(*by, "window"))
    if not whole:
        return means
    steps = F.when(F.col("window") == 0, 1).otherwise(every)
    full = placed.groupBy(*by, "window").agg(F.count("*").alias("_steps")).where(F.col("_steps") == steps)
    return means.join(full.drop("_steps"), [*by, "window"])


def eval_records(
    evaluations: DataFrame, steps: DataFrame, *, b: int = 64, batches: int = 21, bins: int = 10,
    by: tuple[str, ...] = ("run",), at: str = "ts", width: float = 3600.0,
) -> DataFrame:
    """(by..., ts, step, epoch, datapoints, loss, bin_0, ...): one record per evaluation.

    ``evaluations`` has a row per sample (by..., ts, batch_id, t, loss), ``ts`` being that of the
    evaluation; ``steps`` has (by..., ts, step, epoch). A record carries the count of steps done
    by then, from the last step before it, the unweighted mean of the first ``batches`` batches,
    and the mean loss of their samples per timestep bin.
    """
    place = F.coalesce(timestep_bin("t", bins), F.raise_error("a row has no timestep").cast("int"))
    rows = evaluations.where(F.col("batch_id") < batches).withColumn("_bin", place)
    per_batch = rows.groupBy(*by, at, "batch_id").agg(
        F.avg("loss").alias("_mean"),
        *[F.sum(F.when(F.col("_bin") == i, F.col("loss"))).alias(f"_s{i}") for i in range(bins)],
        *[F.count_if(F.col("_bin") == i).alias(f"_n{i}") for i in range(bins)],
    )
    records = per_batch.groupBy(*by, at).agg(
        F.avg("_mean").alias("loss"),
        *[
            (F.coalesce(F.sum(f"_s{i}"), F.lit(0.0)) / F.greatest(F.sum(f"_n{i}"), F.lit(1))).alias(f"bin_{i}")
            for i in range(bins)
        ],
    )
    found = as_of(records, steps.select(*by, at, "step", "epoch"), list(by), at=at, width=width, columns=["step", "epoch"])
    done = F.coalesce(F.col("step") + 1, F.lit(0))
    return found.select(
        *by, at, done.alias("step"), "epoch", (done * b).alias("datapoints"), "loss", *[f"bin_{i}" for i in range(bins)]
    )
