"""Registered queries of this subpackage: each applies one operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from palimpsest.llm import audio, bpe, divergence, hard_negatives, lattice_lm, mixing, ngram_join, packing, pii, pu_quality, quality_rules, sharding, toxicity
from palimpsest.llm.common import read_table


def _documents(operator: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: operator(read_table(spark, sf_dir, "documents"))


def _labelled(operator: Callable[[DataFrame, DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: operator(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": _documents(packing.pack),
    "op2_toxicity": _labelled(toxicity.score),
    "op3_bpe_tree": _documents(bpe.encode_decode),
    "op4_feistel_shards": _documents(sharding.shard),
    "op5_weak_pii": _documents(pii.find),
    "op6_telephony": _documents(audio.telephony),
    "op7_ngram_jaccard": _documents(ngram_join.near_duplicates),
    "op8_pu_quality": _labelled(pu_quality.score),
    "op9_quality_rules": _documents(quality_rules.report),
    "op10_lattice_lm": _documents(lattice_lm.score),
    "op11_source_mix": _documents(mixing.report),
    "op12_hard_negatives": lambda spark, sf_dir: hard_negatives.mine(read_table(spark, sf_dir, "embeddings")),
    "op13_source_divergence": _documents(divergence.audit),
}

ORACLE_SQL: dict[str, str] = {
    "op7_ngram_jaccard": ngram_join.SQL,
    "op9_quality_rules": quality_rules.SQL,
    "op11_source_mix": mixing.SQL,
    "op12_hard_negatives": hard_negatives.SQL,
    "op13_source_divergence": divergence.SQL,
}
