"""The corpus pipeline: quality rules, toxicity, near duplicates, secret
scans and packing, each a stage over what its predecessor kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from memberscope.llm import jaccard_join, line_quality, packing, secret_scan, toxicity
from memberscope.llm.common import read, scratch_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without frequent lines (limits
    that do not rise with the host)."""
    return line_quality.clean_documents(docs, long_docs=line_quality.LONG_DOCS)


def nontoxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic."""
    return toxicity.clean_documents(docs, read(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component: five-word shingles,
    similarity 0.8 or more."""
    return jaccard_join.one_per_component(docs, size=5, percent=80)


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced."""
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Layout of the remaining documents in sequences of 1024 ids."""
    return packing.pack(docs)


STAGES = [("quality rules", quality), ("toxicity", nontoxic), ("near duplicates", distinct),
          ("secret scans", redacted), ("packing", pack)]

#: The toxicity stage trains a model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is a written table
    in the shared checkpoint folder."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch_table(spark, stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
