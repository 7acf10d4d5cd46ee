"""Flat audit records to star columns, and natural keys to surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from openloop.functions.sizing import hinted

# Fields of a flat audit record and the star columns they become.
FLAT_FIELDS = {
    "target_index": "name",
    "target_document_id": "external_document_id",
    "action_taken": "action_taken",
    "reason": "reason",
    "timestamp": "detected_at",
}


def star_columns(flat: DataFrame) -> DataFrame:
    """Flat records under the column names of the star."""
    return flat.select(*[F.col(old).alias(new) for old, new in FLAT_FIELDS.items()])


def external_id(source: Column, number: Column) -> Column:
    """Document id composed of its source name and a zero-padded number. A number of more than
    six digits stays whole."""
    digits = number.cast("string")
    return F.concat(source, F.lit(":"), F.lpad(digits, F.greatest(F.length(digits), F.lit(6)), "0"))


def sources_in(flat: DataFrame) -> DataFrame:
    """Distinct data sources named by flat records."""
    return flat.select(F.col("target_index").alias("name")).distinct()


def documents_in(flat: DataFrame) -> DataFrame:
    """Distinct documents per source, first seen at their earliest record."""
    return star_columns(flat).groupBy("name", "external_document_id").agg(
        F.min("detected_at").alias("first_seen_at")
    )


def resolve_documents(
    records: DataFrame, data_source: DataFrame, document_ref: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Records (name, external_document_id, ...) with their ``document_ref_id``, and apart from
    them the records whose document is unknown. Both read one join."""
    known = document_ref.select("document_ref_id", "data_source_id", "external_document_id").join(
        hinted(data_source.select("data_source_id", "name")), "data_source_id"
    )
    key = ["name", "external_document_id"]
    joined = records.join(known.select("document_ref_id", *key), key, "left")
    found = F.col("document_ref_id").isNotNull()
    return joined.filter(found), joined.filter(~found).drop("document_ref_id")
