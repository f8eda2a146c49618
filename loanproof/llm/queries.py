"""The registered queries of this subpackage: each operator on its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loanproof.llm import bpe, licenses, lm, minhash, packing, phrases, quality, rules, runs, secrets, simhash, topk, toxicity
from loanproof.llm.common import table


def tokenizer_path(name: str) -> str:
    """A file of the public tokenizers; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digest(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op2_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.corpus_scores(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_scan(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_digest(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_bpe, op2_lm, op3_licenses, op4_simhash, op5_packing, op6_secrets, op7_quality, op8_toxicity, op9_rules, op10_topk, op11_phrases, op12_minhash, op13_runs)}


def oracle_sql() -> dict[str, str]:
    return {"op10_topk": topk.ORACLE, "op11_phrases": phrases.ORACLE}
