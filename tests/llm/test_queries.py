"""Registered queries: against their SQL, or that they cover their table."""

import importlib

import pytest

from pairloom.llm.oracles import ORACLES
from pairloom.llm.queries import QUERIES
from registry.compare import difference


def test_entry_has_them_all():
    entry = importlib.import_module("__spark_entry__")
    names = set(entry.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf, name):
    assert difference(QUERIES[name](spark, sf), ORACLES[name], sf) is None


@pytest.mark.parametrize("name", ["op2_golay_simhash", "op3_phrase_automata", "op5_secret_novelty", "op6_decision_list"])
def test_one_row_per_document(spark, sf, name):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = QUERIES[name](spark, sf).select("doc_id")
    assert sorted(r[0] for r in got.collect()) == sorted(r[0] for r in docs.select("doc_id").collect())
