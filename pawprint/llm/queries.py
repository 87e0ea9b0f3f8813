"""The registered queries of the operators and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pawprint.llm import (decontam, jaccard_join, line_rules, packing, pfor, secret_scan,
                          spimi, suffix_dedup, toxicity, warc, weak_quality, whitening,
                          wrappers)
from pawprint.llm.common import load
from pawprint.session import scratch_path


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(load(spark, sf_dir, "documents"))


def op2_weak_label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_quality.classify(load(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(load(spark, sf_dir, "documents"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(load(spark, sf_dir, "documents"),
                                  load(spark, sf_dir, "benchmark"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, load(spark, sf_dir, "labels")))


def op6_line_frequency_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.quality(load(spark, sf_dir, "documents"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link_components(load(spark, sf_dir, "documents"))


def op8_html_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(load(spark, sf_dir, "pages"))


def op9_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-ids")
    pfor.write_ids(load(spark, sf_dir, "documents"), path)
    return pfor.read_documents(spark, path)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(load(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spimi.divergence(load(spark, sf_dir, "documents"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(load(spark, sf_dir, "embeddings"))


def op13_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write(load(spark, sf_dir, "pages"), path)
    return warc.read(spark, path).drop("chunks")


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_weak_label_quality": op2_weak_label_quality,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_toxicity": op5_toxicity,
    "op6_line_frequency_rules": op6_line_frequency_rules,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_html_wrappers": op8_html_wrappers,
    "op9_token_ids": op9_token_ids,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_source_divergence": op11_source_divergence,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_warc_chunks": op13_warc_chunks,
}

ORACLE: dict[str, str] = {
    "op4_benchmark_decontamination": decontam.ORACLE,
    "op6_line_frequency_rules": line_rules.ORACLE,
    "op7_jaccard_join": jaccard_join.ORACLE,
    "op11_source_divergence": spimi.ORACLE,
    "op13_warc_chunks": warc.ORACLE,
}
