"""Cleaning of ``documents`` for training, stage by stage.

Each stage is a function of (spark, docs, sf_dir) that returns a DataFrame. It
is written as Parquet and read again before the next one, so a stage works on
what its predecessor kept. All but the last return the columns of ``documents``,
other columns included.

Defined results: an empty table stays empty; null texts fail the quality rules;
rows that share an id go together in the stages that drop rows, but that of
equal rows one stays after the second stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vesselmart.llm import bpe, decontaminate, parityjoin, pii, quality
from vesselmart.llm.common import materialised, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the outlier distance reject."""
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of least id, of each group of near copies."""
    return parityjoin.representatives(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind and ``n_chars`` set anew."""
    masked = pii.mask(docs)
    if "n_chars" not in docs.columns:
        return masked
    kind = docs.schema["n_chars"].dataType
    return masked.withColumn("n_chars", F.length("text").cast(kind)).select(docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document, and whether they decode to its text."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    made = bpe.with_ids(docs.select("doc_id", "lang", "source", "text"), path)
    return made.select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "decodes"
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("BPE encoding and decoding", token_ids),
]

#: SQL can express neither the covariance estimate nor the merges; the stages are
#: tested against brute force instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialised(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
