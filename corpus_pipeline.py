"""Corpus pipeline: quality rules, near-duplicates, decontamination, secrets, packing.

Each stage takes (spark, docs, sf_dir) and works on all documents that the
stage before kept. ``run`` writes what a stage returns as Parquet to the
cluster's shared folder and reads it again as the next one's documents, so a
lost executor never reaches back beyond the stage at work.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from panelforge.llm import decontaminate, packing, quality, secretscan, simhash
from panelforge.llm.common import intermediate, shared_folder
from panelforge.sources.tables import read_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or the likelihood ratio reject go."""
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the document with the least doc_id stays."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets in them are replaced."""
    return secretscan.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]

#: XXH64 fingerprints, hashed n-grams and tokenizer ids are beyond SQL; the
#: rows are tested against a plain Python version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the last stage returns. A stage's own tables are removed from the
    shared folder when its result is written, the results of the stages before
    the last at the end."""
    docs, result = read_table(spark, sf_dir, "documents"), shared_folder(spark, STAGES[-1][0])
    with intermediate(spark):
        for name, stage in STAGES:
            path = result if name == STAGES[-1][0] else shared_folder(spark, name)
            with intermediate(spark):
                kept = stage(spark, docs, sf_dir)
                kept.write.parquet(path)
            docs = spark.read.schema(kept.schema).parquet(path)
    return docs
