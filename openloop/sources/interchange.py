"""CSV interchange files: typed load, dense surrogate keys in file order, export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from openloop.functions.clock import epoch_micros, iso_utc
from openloop.functions.durable import staged
from openloop.functions.sizing import hinted
from openloop.schemas import SURROGATE, TABLES, interchange_columns

# CSV dialect of the interchange files. Quotes are doubled inside quoted text. An
# empty field is NULL and "" is the empty text: a NULL mark other than "" keeps the two apart.
DIALECT = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "nullValue": "\u0001",
    "emptyValue": "",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSXXX",
}


def read_table(spark: SparkSession, path: str, table: str, multiline: bool = False) -> DataFrame:
    """One table from its CSV file or folder of files, typed by the declared schema. Columns
    are matched by the names in the header, in any order; a bad row fails the load.

    ``multiline`` admits line breaks inside quoted text; each file is then one task's work.
    """
    names = spark.read.options(**DIALECT).csv(path).columns
    wanted = interchange_columns(table)
    if sorted(names) != sorted(wanted):
        raise ValueError(f"{table}: header {names} does not name {wanted}")
    schema = T.StructType([TABLES[table][name] for name in names])
    rows = (
        spark.read.schema(schema)
        .options(**DIALECT, mode="FAILFAST", enforceSchema="false", multiLine=str(multiline))
        .csv(path)
    )
    return rows.select(
        *wanted,
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )


def number_rows(rows: DataFrame, key: str, kind: T.DataType = T.LongType()) -> DataFrame:
    """Replaces ``file_path`` and ``block_start`` by a dense key 1..N in file order: by path,
    then by position in the file.

    Rows are stored with their place in the partition first, so both passes see the same
    places. Each block of a file is counted, the running total over blocks (one row per block)
    gives its offset, and the offset goes back to the rows.
    """
    placed = staged(rows.withColumn("place", F.monotonically_increasing_id()))
    blocks = placed.groupBy("file_path", "block_start").agg(
        F.count(F.lit(1)).alias("n"), F.min("place").alias("first_place")
    )
    in_order = Window.orderBy("file_path", "block_start").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    offsets = blocks.select(
        "file_path",
        "block_start",
        (F.sum("n").over(in_order) - F.col("n") - F.col("first_place") + 1).alias("shift"),
    )
    numbered = placed.join(hinted(offsets), ["file_path", "block_start"])
    return numbered.select(
        (F.col("place") + F.col("shift")).cast(kind).alias(key),
        *[c for c in rows.columns if c not in ("file_path", "block_start")],
    )


def number_stored_rows(rows: DataFrame, key: str, kind: T.DataType = T.LongType()) -> DataFrame:
    """Replaces ``file_path`` and ``row_index`` of Parquet rows by a dense key 1..N in file order.

    A Parquet file knows the place of each of its rows, so nothing is stored but one row per file:
    its length, from a pass over the two metadata columns that reads no data column. ``rows``
    must hold whole files.
    """
    lengths = staged(rows.groupBy("file_path").agg((F.max("row_index") + 1).alias("n"), F.count(F.lit(1)).alias("seen")))
    short = lengths.filter("n != seen").limit(1).collect()
    if short:
        raise ValueError(f"{short[0].file_path}: {short[0].seen} of {short[0].n} rows given")
    in_order = Window.orderBy("file_path").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = lengths.select("file_path", (F.sum("n").over(in_order) - F.col("n") + 1).alias("shift"))
    numbered = rows.join(hinted(offsets), "file_path")
    return numbered.select(
        (F.col("row_index") + F.col("shift")).cast(kind).alias(key),
        *[c for c in rows.columns if c not in ("file_path", "row_index")],
    )


def load_table(spark: SparkSession, path: str, table: str, multiline: bool = False) -> DataFrame:
    """A table with its surrogate key, as it would be after a load in file order."""
    key = SURROGATE[table]
    return number_rows(read_table(spark, path, table, multiline), key, TABLES[table][key].dataType)


def csv_line(df: DataFrame, columns: list[str]) -> Column:
    """One interchange line: text always quoted with doubled quotes, instants as ISO-8601 UTC
    with milliseconds, NULL as an empty field."""
    fields = []
    for name in columns:
        kind = df.schema[name].dataType
        if isinstance(kind, T.StringType):
            text = F.concat(F.lit('"'), F.replace(df[name], F.lit('"'), F.lit('""')), F.lit('"'))
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            text = iso_utc(epoch_micros(df, name))
        else:
            text = df[name].cast("string")
        fields.append(F.coalesce(text, F.lit("")))
    return F.concat_ws(",", *fields)


def write_table(df: DataFrame, path: str, table: str) -> None:
    """Exports a table as a folder of interchange files, each with a header line."""
    columns = interchange_columns(table)
    lines = df.select(csv_line(df, columns).alias(",".join(columns)))
    # The line is complete, so the writer must neither quote nor escape it again.
    (
        lines.write.mode("overwrite")
        .options(header="true", sep="\u0001", quote="\u0000", escape="\u0000")
        .options(ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false", emptyValue="")
        .csv(path)
    )
