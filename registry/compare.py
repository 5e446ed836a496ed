"""Run queries and their SQL side by side: ``python -m registry.compare [sf_dir] [names...]``."""

from __future__ import annotations

import sys
import time

import duckdb
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
    "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz",
}


def session(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("pairloom")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run_sql(sql: str, sf: str) -> tuple[dict[str, str], pa.Table]:
    with duckdb.connect() as con:
        for name in TABLES:
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
        kinds = {c[0]: TYPES.get(c[1], c[1]) for c in con.execute(f"DESCRIBE {sql}").fetchall()}
        return kinds, con.execute(sql).to_arrow_table()


def difference(result: DataFrame, sql: str, sf: str) -> str | None:
    """What differs first: schema, row count or values; None if nothing does."""
    kinds, wanted = run_sql(sql, sf)
    got_kinds = dict(result.dtypes)
    if got_kinds != kinds:
        return f"schema {sorted(got_kinds.items())} != {sorted(kinds.items())}"
    got = result.toArrow()
    if got.num_rows != wanted.num_rows:
        return f"{got.num_rows} rows != {wanted.num_rows}"
    names = sorted(kinds)
    left, right = (sorted(map(repr, zip(*(t[n].to_pylist() for n in names)))) for t in (got, wanted))
    for a, b in zip(left, right):
        if a != b:
            return f"{names}: {a} != {b}"
    return None


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from registry.oracles import ORACLES
    from registry.queries import QUERIES

    spark, failed = session(), 0
    for name in sys.argv[2:] or list(QUERIES):
        begin = time.time()
        try:
            found = difference(QUERIES[name](spark, sf), ORACLES[name], sf)
        except Exception as error:  # one failing query should not hide the others
            found = f"{type(error).__name__}: {str(error)[:600]}"
        failed += found is not None
        print(f"{'FAIL' if found else 'ok':4} {name} {time.time() - begin:.1f}s {(found or '')[:900]}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
