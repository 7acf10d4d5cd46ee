"""Hit rates and stored daily totals."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from openloop.functions.clock import day_of, epoch_micros, month_of, utc_hour
from openloop.functions.durable import staged
from openloop.functions.numbers import ratio
from openloop.model import AuditModel


def hit_rate(model: AuditModel, by: str = "agent_version") -> DataFrame:
    """Findings per hundred documents scanned, by ``agent_version`` or ``hour_utc``. Findings
    are folded per run first, and a run without findings still counts its documents."""
    per_run = model.violation.groupBy("scan_run_id").agg(F.count(F.lit(1)).alias("findings"))
    runs = model.scan_run
    if by == "hour_utc":
        runs = runs.withColumn("hour_utc", utc_hour(epoch_micros(runs, "started_at")))
    joined = runs.select("scan_run_id", "documents_scanned", by).join(
        per_run, "scan_run_id", "left"
    )
    totals = joined.groupBy(by).agg(
        F.count(F.lit(1)).alias("runs"),
        F.coalesce(F.sum("findings"), F.lit(0)).alias("findings"),
        F.sum("documents_scanned").alias("documents_scanned"),
    )
    rate = ratio(F.col("findings") * F.lit(100), F.col("documents_scanned"), 1)
    return totals.withColumn("findings_per_100", rate)


def _daily(facts: DataFrame) -> DataFrame:
    day = day_of(facts, "detected_at").alias("day")
    return (
        facts.select(day, "policy_id", "action_taken")
        .groupBy("day", "policy_id", "action_taken")
        .agg(F.count(F.lit(1)).alias("violations"))
        .withColumn("month", F.trunc("day", "month"))
    )


def daily_rollup(model: AuditModel) -> DataFrame:
    """Findings per UTC day, policy and action."""
    return _daily(model.violation)


ROLLUP = ["day", "policy_id", "action_taken", "violations", "month"]


def _store(rows: DataFrame, path: str, spread: int, overwrite: str) -> None:
    (
        rows.repartition("month", F.pmod(F.xxhash64("policy_id"), F.lit(spread)))
        .sortWithinPartitions("day")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", overwrite)
        .partitionBy("month")
        .parquet(path)
    )


def write_rollup(model: AuditModel, path: str, spread: int = 8) -> None:
    """Stores the rollup by month, at most ``spread`` sorted files per month, so that a range of
    dates reads its months only and a large month is not one task. Replaces what is there."""
    first = daily_rollup(model).withColumn("change", F.lit(0).cast("bigint"))
    _store(first, path, spread, "static")


class ImpossibleRetraction(ValueError):
    """A change takes away findings that the rollup does not have."""


def change_rollup(
    spark: SparkSession,
    path: str,
    change: int,
    added: DataFrame | None = None,
    retracted: DataFrame | None = None,
    spread: int = 8,
) -> list[dt.date]:
    """Brings a stored rollup up to date with findings added and findings retracted; returns the
    months rewritten.

    Findings fold to signed counts per day, policy and action, and only the months that these
    name are read and written again; the files of all other months stay. Changes are numbered
    upwards from 1. A month remembers the last change it took in, so a change that was cut short
    is simply run again. A month whose last finding is retracted keeps one row of count zero for
    that memory. Refused, before anything is written, if a count would fall below zero.
    """
    signed = [
        _daily(facts).withColumn("violations", F.col("violations") * sign)
        for facts, sign in ((added, 1), (retracted, -1))
        if facts is not None
    ]
    if not signed:
        return []
    delta = staged(reduce(DataFrame.unionByName, signed))
    named = [row.month for row in delta.select("month").distinct().collect()]  # calendar months
    stored = spark.read.parquet(path).filter(F.col("month").isin(named))
    done = stored.groupBy("month").agg(F.max("change").alias("change"))
    done = [row.month for row in done.filter(F.col("change") >= change).collect()]
    months = sorted(set(named) - set(done))
    if not months:
        return []
    touched = F.col("month").isin(months)
    both = stored.select(*ROLLUP).unionByName(delta.select(*ROLLUP)).filter(touched)
    total = both.groupBy("day", "policy_id", "action_taken", "month").agg(
        F.sum("violations").alias("violations")
    )
    total = staged(total.filter(F.col("violations") != 0).select(*ROLLUP))
    short = total.filter(F.col("violations") < 0).orderBy("day", "policy_id").limit(20).collect()
    if short:
        listed = ", ".join(f"{r.day} {r.policy_id} {r.action_taken}: {r.violations}" for r in short)
        raise ImpossibleRetraction(f"counts below zero, first 20: {listed}")
    left = {row.month for row in total.select("month").distinct().collect()}
    empty = [(month, None, None, 0, month) for month in months if month not in left]
    if empty:
        total = total.unionByName(spark.createDataFrame(empty, total.schema))
    _store(total.withColumn("change", F.lit(change).cast("bigint")), path, spread, "dynamic")
    return months


def read_rollup(
    spark: SparkSession, path: str, first: dt.date | None = None, last: dt.date | None = None
) -> DataFrame:
    """Rollup rows of the days ``first`` to ``last``, each of which may be left open; the files
    of other months are skipped."""
    rows = spark.read.parquet(path).filter(F.col("violations") > 0).select(*ROLLUP)
    if first is not None:
        rows = rows.filter(
            (F.col("month") >= F.lit(first.replace(day=1))) & (F.col("day") >= F.lit(first))
        )
    if last is not None:
        rows = rows.filter(
            (F.col("month") <= F.lit(last.replace(day=1))) & (F.col("day") <= F.lit(last))
        )
    return rows


# Size of a duration sketch: ranks are off by at most 0.071 % of the values, 99 times in 100.
SKETCH = 4096


def rank_error(k: int = SKETCH) -> float:
    """Largest error of a rank as a share of the values, held 99 times in 100 (published formula
    of KLL sketches)."""
    return 2.296 / k**0.9723


def duration_sketches(model: AuditModel, k: int = SKETCH) -> DataFrame:
    """Per UTC day and start hour of finished runs: their number, documents, busy and longest time
    and a mergeable sketch of their durations in microseconds."""
    runs = model.scan_run.filter(F.col("finished_at").isNotNull())
    start, end = epoch_micros(runs, "started_at"), epoch_micros(runs, "finished_at")
    runs = runs.select(
        day_of(runs, "started_at").alias("day"),
        utc_hour(start).alias("hour_utc"),
        "documents_scanned",
        (end - start).alias("took_us"),
    )
    return (
        runs.filter(F.col("took_us").isNotNull())
        .groupBy("day", "hour_utc")
        .agg(
            F.count(F.lit(1)).alias("runs"),
            F.sum("documents_scanned").alias("documents_scanned"),
            F.sum(F.col("took_us").cast("decimal(19,0)")).alias("busy_us"),
            F.max("took_us").alias("max_duration_us"),
            F.kll_sketch_agg_bigint("took_us", F.lit(k)).alias("durations"),
        )
    )


def throughput_from_sketches(sketches: DataFrame, k: int = SKETCH) -> DataFrame:
    """Scan throughput per start hour over the days in ``sketches``, which may be any range of
    those stored. Durations are merged from the sketches; median and p95 have the error of
    :func:`rank_error`, all other columns are exact."""
    merged = sketches.groupBy("hour_utc").agg(
        F.sum("runs").alias("runs"),
        F.sum("documents_scanned").alias("documents_scanned"),
        F.sum("busy_us").alias("busy_us"),
        F.max("max_duration_us").alias("max_duration_us"),
        F.kll_merge_agg_bigint("durations", F.lit(k)).alias("durations"),
    )

    def quantile(share: float):
        return F.kll_sketch_get_quantile_bigint("durations", F.lit(share))

    return merged.select(
        "hour_utc",
        "runs",
        "documents_scanned",
        "busy_us",
        quantile(0.5).alias("median_duration_us"),
        quantile(0.95).alias("p95_duration_us"),
        "max_duration_us",
    )


def document_bitmaps(model: AuditModel, by: str = "policy_code") -> DataFrame:
    """Per UTC month and policy column ``by`` the set of documents with findings, as bitmaps of
    32,768 document keys each."""
    rules = model.policy.select("policy_id", by)
    facts = model.violation.select(
        "policy_id", "document_ref_id", month_of(model.violation, "detected_at").alias("month")
    )
    facts = facts.filter(F.col("document_ref_id").isNotNull()).join(rules, "policy_id")
    return facts.groupBy(
        "month", by, F.bitmap_bucket_number("document_ref_id").alias("bucket")
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position("document_ref_id")).alias("documents"))


def write_document_bitmaps(model: AuditModel, path: str, by: str = "policy_code") -> None:
    """Stores the bitmaps by month; a month that is written again replaces itself only."""
    (
        document_bitmaps(model, by)
        .repartition("month")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("month")
        .parquet(path)
    )


def documents_between(
    spark: SparkSession, path: str, first: dt.date, last: dt.date, by: list[str] | None = None
) -> DataFrame:
    """How many different documents had findings in the months from that of ``first`` to that of
    ``last``, exactly, per column of ``by`` or over all. A document that came up in several
    months or under several policies counts once. Reads the bitmaps of these months only."""
    months = F.col("month").between(F.lit(first.replace(day=1)), F.lit(last.replace(day=1)))
    stored = spark.read.parquet(path).filter(months)
    by = by or []
    sets = stored.groupBy(*by, "bucket").agg(F.bitmap_or_agg("documents").alias("documents"))
    counts = sets.select(*by, F.bitmap_count("documents").alias("n"))
    return counts.groupBy(*by).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("documents"))


def documents_with_findings(model: AuditModel) -> DataFrame:
    """How many documents have at least one finding, and how many there are."""
    found = model.violation.agg(F.count_distinct("document_ref_id").alias("n")).scalar()
    return model.document_ref.agg(F.count(F.lit(1)).alias("documents")).withColumn(
        "with_findings", found
    )
