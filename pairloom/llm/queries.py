"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm import (
    bottom_k, conversation_repair, decision_lists, factorization, golay_simhash, latent_search, mixing, patience, phrase_automata,
    pivotal_grams, secret_novelty, sparse_suffixes, url_reputation,
)


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def op1_url_reputation(spark: SparkSession, sf: str) -> DataFrame:
    pages = _table(spark, sf, "pages")
    judged = url_reputation.judge_urls(
        pages, url_reputation.symbol_outcome(), public_suffixes=url_reputation.PUBLIC_SUFFIXES
    )
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op2_golay_simhash(spark: SparkSession, sf: str) -> DataFrame:
    found = golay_simhash.near_duplicates(_table(spark, sf, "documents"))
    return found.select("doc_id", golay_simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def op3_phrase_automata(spark: SparkSession, sf: str) -> DataFrame:
    return phrase_automata.cut_repeats(_table(spark, sf, "documents"), texts=False).drop("kept")


def op4_sparse_suffixes(spark: SparkSession, sf: str) -> DataFrame:
    return sparse_suffixes.repeated_passages(_table(spark, sf, "documents"))


def op5_secret_novelty(spark: SparkSession, sf: str) -> DataFrame:
    return secret_novelty.find_secrets(_table(spark, sf, "documents"))


def op6_decision_list(spark: SparkSession, sf: str) -> DataFrame:
    judged = decision_lists.judge_quality(_table(spark, sf, "documents"), _table(spark, sf, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "rejected_by",
    )


def op7_patience_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return patience.find_licenses(_table(spark, sf, "documents"))


def op8_latent_search(spark: SparkSession, sf: str) -> DataFrame:
    return latent_search.find_leaks(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


def op9_mixture(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf, "documents"))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken)


def op10_factorization_machine(spark: SparkSession, sf: str) -> DataFrame:
    return factorization.score_toxicity(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def op11_bottom_k(spark: SparkSession, sf: str) -> DataFrame:
    return bottom_k.near_duplicates(_table(spark, sf, "documents"))


def op12_pivotal_grams(spark: SparkSession, sf: str) -> DataFrame:
    return pivotal_grams.spelling_variants(_table(spark, sf, "documents"))


def op13_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    return conversation_repair.repair_conversations(conversation_repair.damaged(_table(spark, sf, "conversations")))


QUERIES = {
    "op1_url_reputation": op1_url_reputation,
    "op2_golay_simhash": op2_golay_simhash,
    "op3_phrase_automata": op3_phrase_automata,
    "op4_sparse_suffixes": op4_sparse_suffixes,
    "op5_secret_novelty": op5_secret_novelty,
    "op6_decision_list": op6_decision_list,
    "op7_patience_alignment": op7_patience_alignment,
    "op8_latent_search": op8_latent_search,
    "op9_mixture": op9_mixture,
    "op10_factorization_machine": op10_factorization_machine,
    "op11_bottom_k": op11_bottom_k,
    "op12_pivotal_grams": op12_pivotal_grams,
    "op13_conversation_repair": op13_conversation_repair,
}
