"""Publishing a model: staged, validated, then made visible; and layouts for hot queries."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from openloop import schemas
from openloop.functions.clock import DAY_US, epoch_micros, slot_of
from openloop.model import AuditModel
from openloop.operators.gaps import gap_segments
from openloop.plans.quality import duplicate_groups, integrity_checks, require_pass, rule_counts
from openloop.sources.interchange import load_table


class InvalidTable(ValueError):
    """Loaded rows break declared rules."""


def _demand_valid(df: DataFrame, table: str) -> None:
    broken = rule_counts(df, table).collect()
    repeated = duplicate_groups(df, (schemas.SURROGATE[table],)).limit(1).count()
    if broken or repeated:
        listed = "; ".join(f"{row.rule}: {row.failures}" for row in broken)
        raise InvalidTable(f"{table}: {listed or 'surrogate key repeats'}")


def load_model(spark: SparkSession, csv_root: str, staging: str) -> AuditModel:
    """Loads ``<table>.csv`` of each table, parents first, into Parquet under ``staging`` and
    validates rows, keys and references. Nothing outside ``staging`` is touched."""
    for table in schemas.TABLES:
        rows = load_table(spark, f"{csv_root}/{table}.csv", table)
        rows.write.mode("overwrite").parquet(f"{staging}/{table}")
        _demand_valid(spark.read.parquet(f"{staging}/{table}"), table)
    model = AuditModel.from_parquet(spark, staging)
    require_pass(integrity_checks(model))
    return model


class PublishConflict(RuntimeError):
    """Another writer published first."""


def _file_system(spark: SparkSession, place: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _log_entries(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the entries of the commit log, ascending."""
    files, path = _file_system(spark, f"{root}/log")
    if not files.exists(path):
        return []
    names = [status.getPath().getName() for status in files.listStatus(path)]
    return sorted(int(name[:-5]) for name in names if name.endswith(".json"))


def _log_entry(spark: SparkSession, root: str, number: int) -> dict:
    line = spark.read.text(f"{root}/log/{number:012d}.json").first()
    if line is None:  # created by a writer that was lost before it could say what it holds
        raise PublishConflict(f"entry {number} of {root}/log is empty; remove it and publish again")
    return json.loads(line.value)


def publish_model(model: AuditModel, root: str, version: str) -> str:
    """Writes all tables into a folder of their own, validates what was written, and then adds
    the next entry to the commit log under ``root/log``; returns the folder.

    A version exists as soon as its log entry does, and an entry is created exclusively: of two
    writers that began after the same entry one gets the number, the other's version is refused
    with :class:`PublishConflict` and leaves nothing. Readers that go through
    :func:`current_model` see the old tables or the new, never a mix. A version that fails
    validation leaves nothing either, and its name can be used again. Versions order by name; one
    that is not greater than the newest is refused.
    """
    spark = model.violation.sparkSession
    entries = _log_entries(spark, root)
    if entries:
        newest = _log_entry(spark, root, entries[-1])["version"]
        if version <= newest:
            raise ValueError(f"version {version} is not greater than the current one, {newest}")
    folder = f"{version}-{uuid.uuid4().hex}"
    target = f"{root}/versions/{folder}"
    files, path = _file_system(spark, target)
    try:
        for name, df in model.tables().items():
            df.write.mode("errorifexists").parquet(f"{target}/{name}")
            _demand_valid(spark.read.parquet(f"{target}/{name}"), name)
        require_pass(integrity_checks(AuditModel.from_parquet(spark, target)))
        _commit(spark, root, entries[-1] + 1 if entries else 1, version, folder)
    except Exception:
        files.delete(path, True)
        raise
    return target


def _commit(spark: SparkSession, root: str, number: int, version: str, folder: str) -> None:
    files, entry = _file_system(spark, f"{root}/log/{number:012d}.json")
    try:
        out = files.create(entry, False)  # fails if the entry is there
    except Py4JJavaError as taken:
        if files.exists(entry):
            raise PublishConflict(f"another writer took entry {number} of {root}/log") from taken
        raise
    out.write(bytearray(json.dumps({"version": version, "folder": folder}).encode()))
    out.close()


def current_model(spark: SparkSession, root: str) -> AuditModel:
    """The version published last."""
    folder = _log_entry(spark, root, _log_entries(spark, root)[-1])["folder"]
    return AuditModel.from_parquet(spark, f"{root}/versions/{folder}")


# Narrow findings of a bucket on average; one task sorts and folds them in some 100 MB.
BUCKET_ROWS = 1_000_000


def buckets_for(violation: DataFrame, least: int) -> int:
    """A number of buckets that grows with the findings, so that a bucket, which one task reads
    whole, does not; ``least`` for small tables. Counting a Parquet table reads file footers only."""
    return max(least, -(-violation.count() // BUCKET_ROWS))


def save_by_document(violation: DataFrame, name: str, buckets: int, slice_days: int = 30) -> None:
    """Catalog table bucketed and sorted by (document, time slice), so that work per document and
    slice needs no shuffle of the findings and a document with very many of them is spread over
    as many buckets as it has slices. A slice is ``slice_days`` long; its number is a column."""
    us = epoch_micros(violation, "detected_at")
    sliced = violation.withColumn("time_slice", slot_of(us, slice_days * DAY_US))
    (
        sliced.repartition(buckets, "document_ref_id", "time_slice")
        .write.mode("overwrite")
        .bucketBy(buckets, "document_ref_id", "time_slice")
        .sortBy("document_ref_id", "time_slice", "detected_at")
        .saveAsTable(name)
    )


def segments_of_layout(spark: SparkSession, name: str) -> DataFrame:
    """Gap segments per document and time slice of a table of :func:`save_by_document`, taken
    where the findings lie; only the segments are shuffled afterwards."""
    facts = spark.table(name)
    events = facts.select(
        "document_ref_id", "time_slice", epoch_micros(facts, "detected_at").alias("us")
    )
    return gap_segments(events, "document_ref_id", "us", ["time_slice"])


def save_by_action(violation: DataFrame, path: str) -> None:
    """Parquet split by action: a query for flags reads only the files of flags."""
    violation.write.mode("overwrite").partitionBy("action_taken").parquet(path)


def refresh_statistics(spark: SparkSession, name: str) -> None:
    """Row count and column statistics of a catalog table, after a load."""
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")


def stored_statistics(spark: SparkSession, name: str, column: str) -> tuple[int | None, int | None]:
    """Row count of a catalog table and distinct count of a column (an estimate, as the catalog
    keeps it), as the last :func:`refresh_statistics` left them; None where there is none."""
    described = spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name = 'Statistics'")
    line = described.select(F.regexp_extract("data_type", r"(\d+) rows", 1).alias("rows")).first()
    of_column = spark.sql(f"DESCRIBE EXTENDED {name} {column}").filter("info_name = 'distinct_count'")
    distinct = of_column.first()
    rows = line.rows if line else ""
    known = distinct and distinct.info_value and distinct.info_value.isdigit()
    return (int(rows) if rows else None), (int(distinct.info_value) if known else None)


def report_result(slug: str, rows: DataFrame, path: str) -> dict:
    """Stores the rows of a report as JSON lines and returns its envelope without the rows:
    they stay in files, and only their number comes to the driver."""
    rows.write.mode("overwrite").json(path)
    written = rows.sparkSession.read.schema(rows.schema).json(path)
    return {"slug": slug, "count": written.count(), "rows": path}
