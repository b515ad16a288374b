"""A corpus pipeline of five stages over ``documents``; each calls one operator of tessera.llm.

Every stage takes (spark, docs, sf_dir) and returns what it keeps, with all columns it was given. Null
texts pass every filter as empty ones; the near-duplicate stage decides by row, so neither a null nor a repeated
id makes a row go that is no copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontam, jaccard, mixing, secrets, toxicity
from tessera.llm.common import discard, materialise, small_batches, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half."""
    small_batches(spark)
    model = toxicity.train(spark, sf_dir, docs)
    return docs.where(toxicity.scorer(spark, model)(F.col("text").cast("string")) < 0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one of the smallest id."""
    small_batches(spark)
    return jaccard.representatives(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    small_batches(spark)
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by their kind; n_chars follows the text."""
    small_batches(spark)
    out = secrets.redacted(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return out


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their place in the mixture: rank, block, slot, in_mix."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
]

#: Toxicity scores, near-duplicate components and edit distances have no SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        last, docs = docs, materialise(stage(spark, docs, sf_dir))
        discard(last)  # nothing reads it any more; the input itself is no scratch table
    return STAGES[-1][1](spark, docs, sf_dir)
