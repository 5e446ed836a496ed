"""Payloads as they arrive, each with a deadline."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_arrivals(
    requests: DataFrame, payloads: DataFrame, timeout_s: int = 8, delay: str = "1 minute", *, key: str = "id"
) -> DataFrame:
    """Requests with their ``data`` and a ``status``: ok, missing (it came empty) or timeout.

    ``requests`` is a stream with ``requested_at``, ``payloads`` one of (key, data, landed_at). What
    lands within ``timeout_s`` is joined at once; a request without it leaves as ``timeout`` when
    both streams have passed its deadline, and its bytes are never kept. The state holds what is
    younger than the deadline. A payload lands once per key.
    """
    asked = requests.withWatermark("requested_at", delay)
    landed = payloads.select(
        F.col(key).alias("_key"), "data", "landed_at", F.lit(True).alias("_landed")
    ).withWatermark("landed_at", delay)
    in_time = F.expr(
        f"`{key}` = _key AND landed_at >= requested_at AND landed_at <= requested_at + INTERVAL {int(timeout_s)} SECONDS"
    )
    joined = asked.join(landed, in_time, "leftOuter")
    status = F.when(F.col("_landed").isNull(), "timeout").when(F.col("data").isNull(), "missing").otherwise("ok")
    return joined.select(*requests.columns, "data", status.alias("status"))
