"""Registered queries of the operators: each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sampletide.llm import discriminant, embed, licenses, merkle, minhash, mixing, packing, pii, quality, repair, substring, tokens, toxicity
from sampletide.llm.common import table, written
from sampletide.session import scratch


def op1_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"), written)


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"), written)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), written)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), written)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), written)


def op6_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    out = scratch(spark, "llm-token-ids")
    manifest = tokens.write(table(spark, sf_dir, "documents"), out, public_tokenizers.path("word_bpe_49k.json"), written)
    return tokens.read(manifest)


def op7_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.passages(table(spark, sf_dir, "documents"), written)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op9_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed.near_duplicates(table(spark, sf_dir, "embeddings"), written)


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), written, size=4)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.audited(table(spark, sf_dir, "conversations"), written)


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discriminant.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), written)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(table(spark, sf_dir, "documents"), written)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (op1_pii_spans, op2_source_mix, op3_best_fit_packing, op4_toxicity, op5_quality_rules, op6_token_ids,
             op7_repeated_passages, op8_license_scan, op9_near_vectors, op10_near_duplicates, op11_conversation_repair, op12_quality_classifier, op13_merkle_manifest)
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    return {"op2_source_mix": mixing.TAKEN_SQL, "op7_repeated_passages": substring.PASSAGES_SQL,
            "op11_conversation_repair": repair.AUDITED_SQL, "op13_merkle_manifest": merkle.VERIFIED_SQL}
