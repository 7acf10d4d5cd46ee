"""Registered queries of the corpus operators, one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from openloop.llm.decontam import contaminated
from openloop.llm.exact import exact_dedup
from openloop.llm.langid import identify
from openloop.llm.lines import drop_common_lines
from openloop.llm.merkle import manifest
from openloop.llm.mixing import mix_sources
from openloop.llm.quality_net import score_quality
from openloop.llm.recompression import remove_repeated_passages
from openloop.llm.simhash import simhash_components
from openloop.llm.spelling import spelling_groups
from openloop.llm.suffixes import remove_repeated_bytes
from openloop.llm.texts import fold, table
from openloop.llm.tokens import count_tokens
from openloop.llm.warc import archived_pages

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


@query
def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


@query
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_bytes(table(spark, sf_dir, "documents")).select(
        "doc_id", F.col("n_units").alias("n_bytes"), "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


@query
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_passages(table(spark, sf_dir, "documents")).select(
        "doc_id", F.col("n_units").alias("n_words"), "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


@query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents before and after three edits of each, whose places and
    lengths are hashes of the id and whose new text is a piece of the document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    size = F.coalesce(F.length("text"), F.lit(0)) + 1

    def draw(number: int, below: Column | int) -> Column:
        return F.pmod(F.xxhash64("doc_id", F.lit(number)), F.lit(below) if isinstance(below, int) else below)

    edits = F.array(*(
        F.struct(
            draw(k, size).alias("start"), draw(k + 1, 24).alias("removed"),
            F.substring("text", draw(k + 2, size).cast("int") + 1, F.lit(16)).alias("inserted"),
        )
        for k in (0, 3, 6)
    ))
    counted = count_tokens(docs.withColumn("edits", edits), edits_column="edits")
    return counted.select("doc_id", "n_tokens", "n_edits", "tokens_after", "reencoded")


@query
def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


@query
def op9_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = archived_pages(spark, table(spark, sf_dir, "pages"), min_bytes=0)
    return pages.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh document, by checksum of its id, is held against its proof with one more
    character counted."""
    tampered = F.when(fold("doc_id", 7) == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    return manifest(table(spark, sf_dir, "documents"), given={"n_chars": tampered})


@query
def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_common_lines(table(spark, sf_dir, "documents"), least=10, shortest=1).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(table(spark, sf_dir, "documents"), shortest=7, least=2, times=10)
