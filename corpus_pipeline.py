"""From raw documents to packed training sequences: five stages, each written as Parquet and read again.

1. quality: documents that the factorisation machine predicts as label 0 go.
2. toxicity: documents that the Kneser-Ney models predict as toxic go.
3. near_duplicates: one document of each SimHash component stays, that of the smallest id.
4. secrets: every secret span is replaced by a mark.
5. packing: the texts are packed into sequences of 1024 tokens; this stage returns pieces.

All stages but the last return the columns of documents. Null and empty texts pass the filters by
their scores; an empty table gives an empty table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loanproof.llm import packing, quality, secrets, simhash, toxicity
from loanproof.llm.common import table
from loanproof.llm.queries import tokenizer_path
from loanproof.session import shared_dir

#: No SQL expresses the trained stages; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_civil(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("secrets", secret_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over all documents, through the session's shared folder."""
    folder = f"{shared_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
