"""As-of joins: each event with the last fact before it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def as_of(
    events: DataFrame, facts: DataFrame, by: list[str], *, at: str = "ts", width: float, columns: list[str],
) -> DataFrame:
    """``events`` with ``columns`` of the last fact of the same ``by`` at or before ``at``; null if there is none.

    Of facts at one time the largest by ``columns`` counts. Both tables are laid out by (``by``,
    span of ``width``): one exchange, and a key with very many rows spreads over its spans. What
    an event does not find in its span comes from the last fact of each span before, one narrow
    row per span.
    """
    def span(df: DataFrame) -> DataFrame:
        return df.withColumn("_span", F.floor(F.col(at).cast("double") / width))

    fact = F.struct(*columns)
    left = span(events).select(*by, at, "_span", F.struct(*events.columns).alias("_event"))
    right = span(facts).select(*by, at, "_span", fact.alias("_fact"))
    both = left.unionByName(right, allowMissingColumns=True)
    before = (
        Window.partitionBy(*by, "_span")
        .orderBy(at, F.col("_event").isNotNull(), "_fact")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    near = both.withColumn("_near", F.last("_fact", ignorenulls=True).over(before)).where(F.col("_event").isNotNull())

    last = right.groupBy(*by, "_span").agg(F.max(F.struct(F.col(at), "_fact")).alias("_last"))
    asked = left.select(*by, "_span").distinct()
    spans = last.unionByName(asked, allowMissingColumns=True).groupBy(*by, "_span").agg(F.max("_last").alias("_last"))
    earlier = Window.partitionBy(*by).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    carried = spans.withColumn("_before", F.last("_last", ignorenulls=True).over(earlier)).select(*by, "_span", "_before")
    joined = near.join(carried, [*by, "_span"], "left")
    found = F.coalesce("_near", F.col("_before._fact"))
    return joined.select(
        *[F.col(f"_event.{c}").alias(c) for c in events.columns], *[found[c].alias(c) for c in columns]
    )
