"""The corpus pipeline: five stages, each a training-data operator on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mooclens.llm.common import stored, table
from mooclens.llm.decontaminate import drop_contaminated
from mooclens.llm.packing import pack
from mooclens.llm.queries import tokenizer_path
from mooclens.llm.secret_scan import redact_secrets
from mooclens.llm.simhash import drop_near_duplicates
from mooclens.llm.toxicity import drop_toxic


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that score 0.5 or more; the model learns from the labelled rows of the input."""
    return drop_toxic(spark, docs, table(spark, sf_dir, "labels"), docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each SimHash component."""
    return drop_near_duplicates(spark, docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents contaminated with benchmark windows."""
    return drop_contaminated(spark, docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps every document and masks the secrets in its text."""
    return redact_secrets(docs, length_col="n_chars")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all that is left into token sequences."""
    return pack(spark, docs, tokenizer_path())


STAGES = [("toxicity", toxicity_stage), ("simhash_near_dedup", near_dedup_stage), ("benchmark_decontamination", decontamination_stage),
          ("secret_scans", secret_stage), ("best_fit_packing", packing_stage)]

#: No stage's learnt scores, graph components or tokens are SQL; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
