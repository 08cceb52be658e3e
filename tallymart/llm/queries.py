"""Registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm import filter_audit, hard_negatives, langid, line_crf, mixing, quality_rules, secret_scan, sharding, topk_search, warc
from tallymart.llm.ngram_join import ngram_join
from tallymart.llm.packing import pack
from tallymart.llm.pii import find_pii
from tallymart.llm.tables import documents, ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn):
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


@query
def op1_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir)).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query
def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)


SQL["op2_exact_topk"] = topk_search.SQL


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = langid.identify(documents(spark, sf_dir).select("doc_id", "text", "lang"))
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "rejected")


@query
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(spark.read.parquet(f"{sf_dir}/pages.parquet"))


SQL["op4_warc"] = warc.SQL


@query
def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(documents(spark, sf_dir)).drop("digest", "first")


@query
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(documents(spark, sf_dir)).drop("found")


@query
def op7_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = mixing.labelled_domains(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rates = mixing.mix_rates(documents(spark, sf_dir), labels, mixing.TARGETS)
    shares = [F.col("posterior")[i].alias(f"p_{d}") for i, d in enumerate(sorted(mixing.TARGETS))]
    return rates.select("doc_id", "tokens", *shares, "rate")


@query
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(documents(spark, sf_dir))
    return found.select("doc_id", "start", "end", F.sha2("candidate", 256).alias("candidate_sha256"), "score", "kept")


@query
def op10_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_crf.quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(documents(spark, sf_dir))


SQL["op6_quality_rules"] = quality_rules.SQL


@query
def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(documents(spark, sf_dir))


@query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


SQL["op12_filter_audit"] = filter_audit.SQL


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


SQL["op13_hard_negatives"] = hard_negatives.SQL
