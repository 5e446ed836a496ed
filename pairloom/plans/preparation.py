"""From raw rows to sample rows: the batch job, which the streaming job runs per batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from pairloom.functions.arrays import normalize_latent
from pairloom.operators.samples import extract_caption, is_json, with_reject_reason
from pairloom.operators.text import SharedVocab, encode_in_place

OK = "ok"
VERDICTS = (OK, "bad_json", "no_caption", "no_latent")


def prepare(
    raw: DataFrame, vocab: DataFrame | SharedVocab, *, shift: float, scale: float, length: int = 128,
    wide: bool = False,
) -> DataFrame:
    """(id, url, caption, ids, latent, verdict) of rows shaped like ``schemas.RAW_SAMPLE``.

    ``verdict`` is ``ok``, or names why a row is set aside: malformed JSON, no caption or no
    latent; such a row has neither ids nor latent. Written partitioned by ``verdict``, good
    and rejected rows leave in one pass over the input, and with a vocabulary that can be
    broadcast no row is shuffled.
    """
    rules = {
        "bad_json": is_json("json"),
        "no_caption": F.col("caption").isNotNull(),
        "no_latent": F.col("latent").isNotNull(),
    }
    tagged = with_reject_reason(extract_caption(raw), rules)
    encoded = encode_in_place(tagged, vocab, length)
    fine = F.col("reason").isNull()
    latent = normalize_latent("latent", shift, scale, wide)
    return encoded.select(
        "id", "url", "caption",
        F.when(fine, F.col("ids")).alias("ids"),
        F.when(fine, latent).alias("latent"),
        F.coalesce("reason", F.lit(OK)).alias("verdict"),
    )


def write_prepared(prepared: DataFrame, path: str) -> dict[str, int]:
    """Replace the table at ``path``, partitioned by verdict, and count its rows per verdict on the way.

    The counts come from the write itself; the input is read once.
    """
    seen = Observation("verdicts")
    counts = [F.count_if(F.col("verdict") == v).alias(v) for v in VERDICTS]
    prepared.observe(seen, *counts).write.mode("overwrite").partitionBy("verdict").parquet(path)
    return {v: n for v, n in seen.get.items() if n}
