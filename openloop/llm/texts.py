"""What all corpus operators share: white space and words, tables, hash folds."""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ASCII white space, and a word between it; ``bytes.split()`` cuts at the same six bytes.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(id_column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(F.col(id_column).cast("string")) % folds


def held_out(id_column: str, folds: int, remainder: int) -> Column:
    """Whether a row is kept from learning; a null id is not."""
    return F.coalesce(fold(id_column, folds) == remainder, F.lit(False))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_bytes(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).cast("binary")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often the body looks at it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, ascii_uppercase, ascii_lowercase)
