"""Sample records: members, captions, keys, assembly and splits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.runtime import as_column
from pairloom.schemas import require_columns


def pick_first(df: DataFrame, alternatives: list[str], out: str) -> DataFrame:
    """The first of several member columns that is present."""
    return df.withColumn(out, F.coalesce(*[F.col(c) for c in alternatives]))


def extract_caption(df: DataFrame, json_col: str = "json", field: str = "caption", out: str = "caption") -> DataFrame:
    """Read one field of the JSON member; NULL when absent or malformed."""
    return df.withColumn(out, F.get_json_object(json_col, f"$.{field}"))


def is_json(c: Column | str) -> Column:
    """True for exactly one well-formed JSON value.

    Spark's parsers stop after the first value and ignore what follows. Inside brackets a
    tail is an error, or a second element; inside braces a stray bracket is an error too. An
    object that repeats a key counts as malformed.
    """
    text = as_column(c)
    alone = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    parsed = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    return F.coalesce(alone & parsed.isNotNull(), F.lit(False))


def with_reject_reason(df: DataFrame, rules: dict[str, Column], out: str = "reason") -> DataFrame:
    """Name the first rule a row breaks, else NULL. A rule maps a reason to "row is fine"."""
    reason = F.lit(None).cast("string")
    for name, fine in reversed(list(rules.items())):
        reason = F.when(~F.coalesce(fine, F.lit(False)), F.lit(name)).otherwise(reason)
    return df.withColumn(out, reason)


def split_valid(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with ``reason``); together they are all rows.

    Both are filters over the input, nothing is cached: writing the tagged frame once,
    partitioned by reason, avoids the second read where that matters.
    """
    tagged = with_reject_reason(df, rules)
    return tagged.where("reason IS NULL").drop("reason"), tagged.where("reason IS NOT NULL")


def reject_counts(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("reason").agg(F.count("*").alias("n"))


def with_sample_key(df: DataFrame, batch_size: int = 64, index: str = "idx", out: str = "key") -> DataFrame:
    """Key ``{batch:06d}_{position}``; the index and every other column stay."""
    require_columns(df, index)
    i = F.col(index)
    batch = F.floor(i / F.lit(batch_size)).cast("bigint")
    return df.withColumn(out, F.format_string("%06d_%d", batch, i % batch_size))


def assemble_samples(latents: DataFrame, embeds: DataFrame, captions: DataFrame, key: str = "key") -> DataFrame:
    """Pair the parts of a sample by key.

    All three are joined on the same key, so each side moves once; tables bucketed by it do
    not move at all.
    """
    return reduce(lambda left, right: left.join(right, key), [embeds, captions], latents)


def to_training_pair(df: DataFrame, key: str = "key") -> DataFrame:
    return df.select(key, "latent", "prompt_embeds")


def split_by_shard(
    df: DataFrame, train: tuple[int, int], test: tuple[int, int], shard: str = "shard"
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by inclusive shard range, pruned at the scan."""
    if max(train[0], test[0]) <= min(train[1], test[1]):
        raise ValueError(f"train {train} and test {test} overlap")
    return tuple(df.where(F.col(shard).between(*bounds)) for bounds in (train, test))
