"""Mixing sources to target weights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.functions.rand import uniform
from pairloom.llm.words import count_words, wrapped
from pairloom.operators.index import with_index
from pairloom.runtime import lookup_join, materialize, measured_bytes

WEIGHTS = (5, 2, 1)


def source_targets(
    sized: DataFrame, *, share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS
) -> DataFrame:
    """(source, source_size, target) for a (source, size) table.

    Sources in code point order, null last, weigh ``weights`` in turn and share ``share``
    times all sizes. No target exceeds ``most`` times its source's size; what is over goes to
    the others by weight until none is above.
    """
    sums = sized.groupBy("source").agg(F.coalesce(F.sum("size"), F.lit(0)).alias("source_size"))
    keyed = sums.withColumn("_null", F.col("source").isNull())
    ranked = with_index(keyed, "_null", "source", out="_rank")
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int")
    )
    table = materialize(
        ranked.select("source", "source_size", weight.alias("_w"), (F.col("source_size") * F.lit(most)).alias("_cap")),
        "sources",
    )
    total = table.agg(F.sum("source_size")).first()[0] or 0
    # The level only rises, and a source once at its limit stays there, so this ends.
    level, before = 0.0, None
    while level != before:
        before = level
        full = F.col("_cap") <= F.lit(level) * F.col("_w")
        capped, open_weight = table.agg(
            F.coalesce(F.sum(F.when(full, F.col("_cap"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("_w"))), F.lit(0.0)),
        ).first()
        level = (share * total - capped) / open_weight if open_weight else level
    target = F.least("_cap", F.lit(level) * F.col("_w"))
    return table.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame, *, share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS, seed: int = 0
) -> DataFrame:
    """(doc_id, size, source_size, target, rate, copies) of every document, and its row as ``_doc``.

    A document's size is its number of words. The rate of its source is target over size; the
    document is taken floor(rate) times, and once more if its own draw, a function of
    ``doc_id``, falls below the fraction. Reruns agree, and repeated rows draw alike. Null
    sources form one source, null ids share one draw, a null or empty text has size 0, a
    source without words gets rate 0, and an empty table gives no rows.
    """
    sized = wrapped(docs, "doc_id", "source", count_words("text").alias("size"))
    targets = source_targets(
        sized.select("source", "size"), share=share, most=most, weights=weights
    )
    key = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    lookup = materialize(targets.withColumn("_key", key).drop("source"), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    draw = uniform(seed, "mix", F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    joined = lookup_join(
        sized.withColumn("_key", key), lookup, ["_key"],
        size=measured_bytes(lookup, "_key", fixed=48), salt_by=["doc_id"],
    ).drop("_key")
    whole = F.floor("rate")
    more = (draw < F.col("rate") - whole).cast("bigint")
    return joined.withColumn("rate", rate).withColumn("copies", whole + more)


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """Every copy as a row of its own: the columns of ``docs`` and ``copy``, counted from 1.

    A column of that name in ``docs`` gives way.
    """
    taken = mix(docs, **options).where(F.col("copies") > 0)
    each = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("copy")
    own = [F.col("_doc")[c].alias(c) for c in docs.columns if c != "copy"]
    return taken.select(*own, each)
