"""The corpus pipeline: quality rules, near duplicates, surrogates for personal data, source mix, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and read again as the
next stage's ``docs``. All but the last return the columns of ``documents``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.mixing import apply_mix, plan_mix
from sluice.llm.ngram_join import one_per_component
from sluice.llm.packing import pack_documents
from sluice.llm.pii_surrogates import surrogate_pii
from sluice.llm.quality_rules import keep_quality
from sluice.llm.shared import workdir, written
from sluice.llm.suite import MIX, mix_weights, source_domain


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or lie outside their language and source go.

    Null and empty texts fail the base rules; equal texts of one language and source are judged alike, so repeated rows stay or go together.
    """
    return keep_quality(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by 80 % of their five-word shingles one stays.

    That is the one with the least id; texts without words are linked with nothing and stay.
    """
    return one_per_component(docs, k=5, pct=80)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets are replaced by surrogates; ``n_chars`` follows the new text.

    All rows stay; null texts stay null with their ``n_chars``, and equal texts get equal results.
    """
    out = surrogate_pii(docs, count_col=None)
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are drawn to the target weights; what a source lacks is repeated up to the allowed epochs.

    A null language or source is a node of its own. Rows that repeat an id are drawn together. Columns of any name stay as they are.
    """
    named = docs.select("doc_id", "text", source_domain().alias("domain"), "lang", "source", F.struct("*").alias("row"))
    _, cuts = plan_mix(named, mix_weights(docs), **MIX)
    return apply_mix(named, cuts, MIX["seed"]).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of 4096: a row per piece of a document with its place; null and empty texts are the end token alone."""
    return pack_documents(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("pii", pii), ("mix", mix), ("pack", pack)]

#: Robust estimates, surrogates and token ids have no SQL form; the tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    base = workdir(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), base, name)
    return STAGES[-1][1](spark, docs, sf_dir)
