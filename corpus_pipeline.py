"""The corpus pipeline: language, near duplicates, personal data, mixture, packed sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm import langid, mixing, ngram_join, packing, pii
from tallymart.llm.tables import Scratch, documents, release, ship


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model does not reject; it learns from the labelled ones among them."""
    ship(spark)
    return langid.identify(docs).filter("not rejected").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of the Jaccard join over five words, linked from a similarity of 0.8."""
    ship(spark)
    return ngram_join.keep_first(docs, k=5, num=80, den=100)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked."""
    ship(spark)
    return pii.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by the rates that bring the domains near their target shares."""
    ship(spark)
    labels = mixing.labelled_domains(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return mixing.draw_by_rate(docs, labels, mixing.TARGETS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences."""
    ship(spark)
    return packing.pack(docs).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixture", mixture),
    ("packed", packed),
]

#: Trained models and graph components are not expressible in SQL; tests/llm holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    scratch = Scratch(spark, "corpus-pipeline")
    docs, before = documents(spark, sf_dir), None
    for name, stage in STAGES:
        docs = scratch.put(name, stage(spark, docs, sf_dir))
        if before:
            scratch.drop(before)
        before = name
        release(spark)
    return docs
