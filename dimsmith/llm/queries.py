"""The registered query of each training-data operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (aho_viterbi, conversation_repair, cross_alignment, elias_fano_lm, license_templates, odd_sketch_neardup,
               pii_disclosure, quality_cascade, ring_sharding, simhash_neardup, suffix_decontamination, token_store, toxicity_grammar)
from .common import documents, tune


def op1_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_templates.report(documents(spark, sf_dir))


def op2_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_grammar.report(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.report(documents(spark, sf_dir))


def op4_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_neardup.neardups(documents(spark, sf_dir))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_cascade.quality(documents(spark, sf_dir))


def op6_elias_fano_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return elias_fano_lm.score(documents(spark, sf_dir))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aho_viterbi.report(documents(spark, sf_dir))


def op8_pii_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_disclosure.report(documents(spark, sf_dir))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_decontamination.report(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ring_sharding.shard(documents(spark, sf_dir), shards=16)


def op11_cross_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_alignment.report(documents(spark, sf_dir))


def op12_odd_sketch_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return odd_sketch_neardup.neardups(documents(spark, sf_dir))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.report(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_license_templates, op2_toxicity_grammar, op3_token_store, op4_simhash_neardup, op5_quality_rules,
             op6_elias_fano_lm, op7_sentencepiece, op8_pii_disclosure, op9_decontamination, op10_sharding,
             op11_cross_alignment, op12_odd_sketch_neardup, op13_conversation_repair)

    def tuned(query):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            tune(spark)
            return query(spark, sf_dir)
        return run
    return {q.__name__: tuned(q) for q in found}


def oracle_sql() -> dict[str, str]:
    from .oracle import SQL
    return dict(SQL)
