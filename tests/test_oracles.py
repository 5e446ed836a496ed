"""Every registered query against its SQL."""

import pytest

from registry.compare import difference
from registry.oracles import ORACLES
from registry.queries import QUERIES


# A shuffle buffer draws from a generator that SQL does not have; tests/test_buffer.py follows it row by row.
WITHOUT_SQL = {"loader_order"}


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) | WITHOUT_SQL and not WITHOUT_SQL & set(ORACLES)


def test_loader_sees_every_row_once(spark, sf):
    rows = QUERIES["loader_order"](spark, sf).collect()
    assert sorted(r["id"] for r in rows) == sorted(r[0] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id").collect())


@pytest.mark.parametrize("name", list(ORACLES))
def test_matches_sql(spark, sf, name):
    assert difference(QUERIES[name](spark, sf), ORACLES[name], sf) is None


def test_entry(spark):
    from __spark_entry__ import entry

    rows = entry(spark).collect()
    assert [row["bin"] for row in sorted(rows)] == list(range(10))
