"""The corpus pipeline: language identification, near duplicates, benchmark passages, secrets, source mix.

Each stage takes the documents that its predecessor kept and returns documents; the last one returns the mix: one
row per copy taken, with its shard and its place in the shard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spendgrain.llm import decontaminate, language, mixing, order_minhash, secret_scan
from spendgrain.llm.common import cut
from spendgrain.llm.queries import labelled_findings
from spendgrain.sources.testdata import table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no language go: those without a letter, or without text."""
    found = language.predict(docs.withColumnRenamed("lang", "pipeline_lang"), language.learn(docs))
    return found.where("lang_pred <> 'und'").withColumnRenamed("pipeline_lang", "lang").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates, the document with the smallest id stays."""
    return order_minhash.keep_first(docs)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item within the edit budget go."""
    return decontaminate.find(docs, table(spark, sf_dir, "benchmark")).where("n_items = 0").select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets in their texts are masked."""
    return secret_scan.redact(docs, labelled_findings(docs, table(spark, sf_dir, "labels")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The copies that the mix takes, with shard and place."""
    return mixing.draw(mixing.mix(docs))


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("benchmark_passages", drop_benchmark_passages),
    ("secrets", mask_secrets),
    ("source_mix", mix_sources),
]

#: Language models, sketches and forests can't be expressed in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another; what one keeps is written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
