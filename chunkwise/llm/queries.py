"""Registered queries of the operators: each reads whole tables and whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chunkwise.llm import (decontamination, jaccard_join, language_id, lm_scoring,
                           merkle_manifest, pii, quality_classifier, quality_rules, secret_scan,
                           sentencepiece_codec, source_divergence, substring_dedup, toxicity)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan_secrets(table(spark, sf_dir, "documents")))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.digest(quality_rules.cascade(table(spark, sf_dir, "documents")))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(table(spark, sf_dir, "documents"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.digest(table(spark, sf_dir, "documents"), sentencepiece_codec.load())


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.classify(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.classify(table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return merkle_manifest.digest(merkle_manifest.manifest(docs, tampered=merkle_manifest.tamper_mark(docs["doc_id"])))


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.extract(table(spark, sf_dir, "documents")))


QUERIES = {f.__name__: f for f in (op1_secret_scans, op2_substring_dedup, op3_toxicity, op4_quality_rules,
                                     op5_quality_classifier, op6_ngram_jaccard_join, op7_sentencepiece,
                                     op8_benchmark_decontamination, op9_lm_scoring,
                                     op10_language_id, op11_source_divergence, op12_merkle_manifest, op13_pii)}
