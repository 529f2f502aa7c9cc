"""From raw documents to packed training sequences: five stages, each on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daybook.llm import decontaminate, line_rules, packing, secrets, simhash
from daybook.llm.common import stored, table
from daybook.session import drop_shared_folders, shared_folders


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; lines that too many documents of a source share are removed from the others.

    A null text has no words and goes; null ids and sources, ties, repeats, very long texts, an empty table and columns of any
    name are as in ``line_rules.clean``.
    """
    return line_rules.clean(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays.

    Null texts are alike, as empty ones are; null ids, ties, repeats, very long texts, an empty table and columns of any name
    are as in ``simhash.drop_near_duplicates``.
    """
    return simhash.drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item go.

    Null and empty texts leak nothing and stay; null ids, repeats, very long texts, empty tables and columns of any name are as
    in ``decontaminate.clean``.
    """
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; every document stays.

    A null text stays null; null ids, ties, repeats, very long texts, an empty table and columns of any name are as in
    ``secrets.redact``.
    """
    return secrets.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces with their ids, and each one's place in a sequence.

    A null text is an empty document; null ids, ties, repeats, very long texts, an empty table and other columns are as in
    ``packing.pack``.
    """
    return packing.pack(docs, keep_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]

#: SQL cannot express fingerprints, latent retrieval or tokens; ``tests/llm/test_pipeline.py`` holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in a row. A stage's input, and what it wrote on the way, are dropped once its output is written."""
    docs, done = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        before = shared_folders()
        docs = stored(stage(spark, docs, sf_dir), name)
        *on_the_way, output = [folder for folder in shared_folders() if folder not in before]
        drop_shared_folders(spark, [*on_the_way, *done])
        done = [output]
    return STAGES[-1][1](spark, docs, sf_dir)
