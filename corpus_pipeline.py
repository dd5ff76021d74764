"""From raw documents to training sequences: five stages over the table ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes it as Parquet into the shared folder and the next stage reads that; tables
that a stage makes for itself are removed with it.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from zonekit.llm.common import documents, staged_alone
from zonekit.llm.exact_dedup import drop_copies
from zonekit.llm.jaccard_join import one_per_class
from zonekit.llm.mixing import mixed
from zonekit.llm.packing import pack
from zonekit.llm.quality import clean_lines_then_reject


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop bad lines, then the documents that fail (operator 10)."""
    return clean_lines_then_reject(docs, length="n_chars")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the least id stays (operator 4)."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by a similarity of 0.8 or more the one with the least id stays (operator 5)."""
    return one_per_class(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them (operator 7)."""
    return mixed(docs, length="n_chars")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences with their token ids (operator 9)."""
    return pack(docs, with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", near_dedup),
    ("mixing sources to target weights", mix_sources),
    ("packing", packing),
]

# The later stages need a hash order and a tokenizer: SQL cannot express them.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, starting from ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = staged_alone(spark, lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
