"""Registered queries of the training-data operators, and SQL for those that SQL can express.

Each query applies one operator, with production parameters, to its whole table.
"""

from __future__ import annotations

import os

from .common import table
from .decontaminate import contamination_digest
from .html_text import text_digest
from .licenses import license_digest
from .merkle import ORACLE as MERKLE_SQL
from .merkle import manifest_digest
from .packing import pack
from .periodic import runs_digest
from .pii import pii_digest
from .quality import quality_digest
from .revisits import ORACLE as REVISITS_SQL
from .revisits import revisit_digest
from .secret_scan import secret_digest
from .simhash import simhash_digest
from .suffix_dedup import suffix_digest
from .toxicity import toxicity_digest


def tokenizer_path() -> str:
    """The public word tokenizer; ``WORD_TOKENIZER`` names another file."""
    if path := os.environ.get("WORD_TOKENIZER"):
        return path
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op1_toxicity(spark, sf_dir):
    return toxicity_digest(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_pii(spark, sf_dir):
    return pii_digest(spark, table(spark, sf_dir, "documents"))


def op3_license_scans(spark, sf_dir):
    return license_digest(table(spark, sf_dir, "documents"))


def op4_suffix_array_dedup(spark, sf_dir):
    return suffix_digest(spark, table(spark, sf_dir, "documents"))


def op5_warc_revisits(spark, sf_dir):
    return revisit_digest(table(spark, sf_dir, "pages"))


def op6_simhash_near_dedup(spark, sf_dir):
    return simhash_digest(spark, table(spark, sf_dir, "documents"))


def op7_best_fit_packing(spark, sf_dir):
    return pack(spark, table(spark, sf_dir, "documents"), tokenizer_path())


def op8_quality_rules(spark, sf_dir):
    return quality_digest(spark, table(spark, sf_dir, "documents"))


def op9_benchmark_decontamination(spark, sf_dir):
    return contamination_digest(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_secret_scans(spark, sf_dir):
    return secret_digest(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark, sf_dir):
    return manifest_digest(spark, table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark, sf_dir):
    return runs_digest(table(spark, sf_dir, "documents"))


def op13_html_extraction(spark, sf_dir):
    return text_digest(table(spark, sf_dir, "pages"))


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_pii, op3_license_scans, op4_suffix_array_dedup, op5_warc_revisits, op6_simhash_near_dedup,
                                    op7_best_fit_packing, op8_quality_rules, op9_benchmark_decontamination, op10_secret_scans, op11_merkle_manifest, op12_periodic_runs,
                                    op13_html_extraction)}
ORACLES: dict[str, str] = {"op5_warc_revisits": REVISITS_SQL, "op11_merkle_manifest": MERKLE_SQL}
