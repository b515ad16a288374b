"""The registered corpus queries and, where SQL can say the same, their SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Query name, module. A module has query(spark, sf_dir), and ORACLE_SQL where there is one.
MODULES = {
    "op1_pii_surrogates": "pii",
    "op2_pfair_mixing": "mixing",
    "op3_secret_scan": "secrets",
    "op4_suffix_tree": "suffixtree",
    "op5_ngram_jaccard": "jaccard",
    "op6_substring_dedup": "substring",
    "op7_toxicity": "toxicity",
    "op8_html_extraction": "html",
    "op9_decontamination": "decontam",
    "op10_embedding_dedup": "embeddings",
}


def _module(name: str):
    return importlib.import_module(f"{__package__}.{MODULES[name]}")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _module(name).query for name in MODULES} | {"pipeline": pipeline}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name in MODULES if (sql := getattr(_module(name), "ORACLE_SQL", None))}
