"""Schemas of the tables the library reads and writes."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("caption", T.StringType()),
        T.StructField("source", T.StringType()),
    ]
)

# What the incremental preparation job picks up: metadata JSON plus an encoded latent.
RAW_SAMPLE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("json", T.StringType()),
        T.StructField("latent", T.ArrayType(T.FloatType())),
    ]
)


def require_columns(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")


def checked_width(df: DataFrame, column: str, n: int) -> DataFrame:
    """Fail the job on the first row whose array is not exactly ``n`` long."""
    ok = F.size(column) == n
    message = F.concat(F.lit(f"{column}: expected {n} values, got "), F.size(column).cast("string"))
    return df.withColumn(column, F.when(ok, F.col(column)).otherwise(F.raise_error(message)))
