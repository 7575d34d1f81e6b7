"""From raw documents to packed batches: five stages, each one of the operators.

Each stage takes (spark, docs, sf_dir) and returns a table; all but the last
return the columns of documents, as they came.  Rows without doc_id pass the
language and quality stages like others, cannot be linked, and stay; extra columns
are carried along.  Empty tables give empty results in every stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from claimstrata.llm.bottom_sketches import NearDuplicates, keep_one_of_each
from claimstrata.llm.language_ppm import keep_identified
from claimstrata.llm.length_buckets import pack
from claimstrata.llm.shared import stored, table
from claimstrata.llm.target_ratio import QualityLimits, keep_good, trusted_rows
from claimstrata.llm.temperature_mix import mixed_documents

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with an identified language; the others go."""
    return keep_identified(docs)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the ratio to trusted texts."""
    return keep_good(docs, trusted_rows(table(spark, sf_dir, "labels"), QualityLimits()))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, Jaccard 0.8."""
    return keep_one_of_each(docs, NearDuplicates(width=5))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Batches of pieces of similar length."""
    return pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language ID", language_id),
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_dedup),
    ("mixing sources to target weights", source_mix),
    ("packing", packing),
]

# Learned models, hashes and iterations have no SQL counterpart.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is stored and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
