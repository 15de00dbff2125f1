"""The corpus pipeline: quality rules, near-duplicates, repeated paragraphs, benchmark leaks, token ids."""

from __future__ import annotations

from pricetide.llm import bpe, decontamination, paragraph_dedup, quality_rules, simhash
from pricetide.llm.common import new_folder, read_table

STAGES = [
    ("quality rules", quality_rules.stage),
    ("simhash near-dedup", simhash.stage),
    ("substring dedup", paragraph_dedup.stage),
    ("benchmark decontamination", decontamination.stage),
    ("byte-level bpe", bpe.stage),
]
ORACLE_SQL = None


def run(spark, sf_dir: str):
    """Every stage on all that its predecessor kept; each result is written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = new_folder(spark, "pipeline")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
