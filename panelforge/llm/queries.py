"""The queries over the driver tables, with SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table
from . import (
    decontaminate, divergence, fim, langid, licenses, packing, quality, rangejoin, secretscan, simhash, tokencount, urlfilter, warc,
)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.report(read_table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(read_table(spark, sf_dir, "documents"))


def captures(pages: DataFrame) -> DataFrame:
    """The pages table has no fetch time; each page gets a day of 2024 by its id."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("page_id") * 37, F.lit(365)).cast("int"))
    return pages.select("page_id", "url", day.alias("day"))


def list_events(pages: DataFrame) -> DataFrame:
    """Two dated lists over the hosts and domains that occur in the pages. The
    digest of a name decides whether it is listed, when, and how."""
    named = (
        pages.select(F.explode(urlfilter.domains_of(urlfilter.host_of(F.col("url")))).alias("pattern"))
        .filter("pattern <> ''").distinct()
    )
    digit = lambda k: F.conv(F.substring("h", k, 2), 16, 10).cast("int")
    rows = named.withColumn("h", F.md5("pattern")).select(
        "pattern", digit(1).alias("a"), digit(3).alias("b"), digit(5).alias("c"), digit(7).alias("d")
    )
    verdict = F.when(F.col("d") % 4 == 0, F.lit("allow")).otherwise(F.lit("block"))
    start = F.lit("2024-01-01").cast("date")
    event = lambda name, after, on: F.when(
        on, F.struct(F.lit(name).alias("event"), F.date_add(start, after.cast("int")).alias("day"))
    )
    # listed from day b, some taken off c days later, some of them put on again
    log = F.array(
        event("add", F.col("b"), F.col("a") < 128),
        event("remove", F.col("b") + F.col("c"), (F.col("a") < 128) & (F.col("c") % 3 < 2)),
        event("add", F.col("b") + F.col("c") + 30, (F.col("a") < 128) & (F.col("c") % 3 == 1)),
    )
    return rows.select(
        F.when(F.col("d") % 2 == 0, F.lit("hosts")).otherwise(F.lit("abuse")).alias("list"),
        "pattern", verdict.alias("verdict"), F.explode(F.array_compact(log)).alias("e"),
    ).select("list", "pattern", "verdict", "e.event", "e.day")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return urlfilter.evaluate(captures(pages), list_events(pages)).select(
        "page_id", "host", "day", "verdict", "rule", "rule_list", "rule_from"
    )


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.report(read_table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(
        read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return quality.judge(docs.select("doc_id", "text"), labels).select("doc_id", "verdict.*")


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.report(read_table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read_table(spark, sf_dir, "pages"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.report(read_table(spark, sf_dir, "documents"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.report(read_table(spark, sf_dir, "documents"))


def op13_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rangejoin.near_duplicates(read_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_language_id, op2_packing, op3_decontamination, op4_simhash, op5_url_filter,
        op6_secrets, op7_token_counts, op8_quality, op9_licenses, op10_warc,
        op11_fill_in_middle, op12_source_divergence, op13_embedding_dedup,
    )
}
