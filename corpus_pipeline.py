"""The corpus pipeline: five stages over ``documents``, each calling one operator.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as
Parquet into the shared folder of ``spark.checkpoint.dir`` and rereads it for the next, so
that a lost executor costs its tasks and not the stages before. All stages but the last
return the columns of ``documents``.

Defined results: see the operators. A row that repeats another's id and text is one row after
``near_duplicates``; documents that lose all their words to ``line_dedup`` go, those that had
none before were rejected as too short; an empty table passes through empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from maskwright.llm import decontaminate, jaccard_join, line_dedup, mixing
from maskwright.llm import quality_rules as rules
from maskwright.llm.common import table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the current policy of the quality ledger."""
    return rules.passing(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without cross-site boilerplate; ``n_chars`` follows the text."""
    return line_dedup.cleaned(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar ones."""
    return jaccard_join.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it, with ``copy`` from 0."""
    return mixing.mixed(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
]

#: Components and hashed draws over the results of other stages are not for SQL; the stages
#: are tested one by one and together against brute force (tests/llm).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
