"""A corpus pipeline: stages applied one after the other to the table of documents.

Every stage works on all its predecessor kept, and all but the last return the columns of
documents. ``run`` stores what a stage keeps in the shared folder before the next one begins.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from openloop.functions.durable import staged  # noqa: E402
from openloop.llm.decontam import keep_clean  # noqa: E402
from openloop.llm.exact import keep_first  # noqa: E402
from openloop.llm.mixing import mix_sources  # noqa: E402
from openloop.llm.quality_net import keep_good  # noqa: E402
from openloop.llm.similar import keep_one_of_similar  # noqa: E402
from openloop.llm.texts import table  # noqa: E402


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is below 0.7 go; learned from the labels of ``docs``."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays, the one with the smallest id."""
    return keep_first(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (Jaccard similarity of five-word shingles 0.8 or
    more) stays, the one with the smallest id."""
    return keep_one_of_similar(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a stretch of a benchmark item go."""
    return keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes; see mix_sources."""
    return mix_sources(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", exact_duplicates),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_free),
    ("mixing sources to target weights", mixed),
]

#: A trained classifier is not expressible in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
