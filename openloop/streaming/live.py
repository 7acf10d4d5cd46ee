"""Live forms of the time-bounded reports over an append-only stream of findings.

Event times are ``timestamp`` columns; :func:`with_event_time` makes one from any instant.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from openloop.functions.clock import epoch_micros
from openloop.plans.quality import row_rule_counts
from openloop.schemas import UNIQUE


def with_event_time(findings: DataFrame, name: str, event_time: str = "event_time") -> DataFrame:
    """Adds the instant of ``name`` as a ``timestamp``, whatever the session time zone."""
    return findings.withColumn(event_time, F.timestamp_micros(epoch_micros(findings, name)))


def daily_counts_live(findings: DataFrame, lateness_hours: int = 1) -> DataFrame:
    """Findings per UTC day, each day once, when it is over. The running total and the mean of
    seven rows are taken in batch from these rows."""
    day = F.window("event_time", "1 day")
    counts = (
        findings.withWatermark("event_time", f"{lateness_hours} hours")
        .groupBy(day.alias("w"))
        .agg(F.count(F.lit(1)).alias("violations"))
    )
    start = F.unix_micros(F.col("w.start"))
    return counts.select(
        F.date_from_unix_date((start / F.lit(86_400_000_000)).cast("int")).alias("day"),
        "violations",
    )


def first_arrivals(
    findings: DataFrame, grain: tuple[str, ...] = UNIQUE["violation"][0], within_hours: int = 24
) -> DataFrame:
    """Drops a finding whose grain was seen within the last ``within_hours``."""
    return findings.withWatermark("event_time", f"{within_hours} hours").dropDuplicatesWithinWatermark(
        list(grain)
    )


# Stored runs of key counts that are merged into one.
FANOUT = 4


def _folder(spark: SparkSession, place: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _stored_runs(spark: SparkSession, place: str) -> list[tuple[int, int]]:
    """(first, last) batch of each finished run of key counts below ``place``."""
    files, path = _folder(spark, place)
    if not files.exists(path):
        return []
    spans = []
    for status in files.listStatus(path):
        done = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if files.exists(done):
            first, last = status.getPath().getName().split("-")[1:]
            spans.append((int(first), int(last)))
    return spans


def covering_runs(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The fewest runs that hold every batch once: those that no longer run contains."""
    return sorted(s for s in spans if not any(o != s and o[0] <= s[0] and s[1] <= o[1] for o in spans))


def _run_place(place: str, span: tuple[int, int]) -> str:
    return f"{place}/run-{span[0]}-{span[1]}"


def add_key_counts(batch: DataFrame, keys: list[str], place: str, number: int, fanout: int = FANOUT) -> None:
    """Adds the key counts of micro-batch ``number`` to the runs stored below ``place``.

    Runs grow as the digits of a number to the base ``fanout``: as soon as ``fanout`` runs of one
    size are there, they are merged into one of the next size, so after n batches there are at
    most (fanout - 1) x log(n) to the base fanout of them, and a count is rewritten as often as
    that. The runs merged go when the next batch comes; until then the batch may be run again and
    replaces what it wrote.
    """
    spark = batch.sparkSession
    spans = _stored_runs(spark, place)
    kept = covering_runs([s for s in spans if s[1] < number])
    files, _ = _folder(spark, place)
    for span in spans:
        if span[1] < number and span not in kept:
            files.delete(_folder(spark, _run_place(place, span))[1], True)
    counts = batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    counts.write.mode("overwrite").parquet(_run_place(place, (number, number)))
    runs, size = [*kept, (number, number)], fanout
    while (number + 1) % size == 0:
        merged = [s for s in runs if s[0] > number - size]
        stored = spark.read.schema(counts.schema).parquet(*(_run_place(place, s) for s in merged))
        total = stored.groupBy(*keys).agg(F.sum("n").alias("n"))
        total.write.mode("overwrite").parquet(_run_place(place, (number + 1 - size, number)))
        runs = [s for s in runs if s not in merged] + [(number + 1 - size, number)]
        size *= fanout


def key_counts(spark: SparkSession, keys: list[str], place: str) -> DataFrame | None:
    """(keys, n) over all batches stored below ``place``; None before the first one."""
    spans = covering_runs(_stored_runs(spark, place))
    if not spans:
        return None
    stored = spark.read.parquet(*(_run_place(place, s) for s in spans))
    return stored.groupBy(*keys).agg(F.sum("n").alias("n"))


def check_each_batch(findings: DataFrame, table: str, sink: str, checkpoint: str) -> StreamingQuery:
    """Runs the row rules of ``table`` on each micro-batch and appends the failures found, with
    the batch number, to ``sink/rows``; for each unique column set the values of the batch are
    counted into ``sink/keys-N`` (see :func:`add_key_counts`), so that repeats across batches are
    found by :func:`failures_so_far`. A batch that is run again replaces its own rows."""

    def check(batch: DataFrame, number: int) -> None:
        numbered = row_rule_counts(batch, table).withColumn("batch", F.lit(number).cast("bigint"))
        numbered.write.mode("overwrite").parquet(f"{sink}/rows/run={number}")
        for n, keys in enumerate(UNIQUE[table]):
            add_key_counts(batch, list(keys), f"{sink}/keys-{n}", number)

    return (
        findings.writeStream.foreachBatch(check)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def failures_so_far(spark: SparkSession, table: str, sink: str) -> DataFrame:
    """Failures per rule over all batches checked so far, however the input was cut into them;
    no row before the first batch."""
    files, path = _folder(spark, f"{sink}/rows")
    if not files.exists(path):
        return spark.createDataFrame([], "rule string, failures bigint")
    stored = spark.read.schema("rule string, failures bigint, batch bigint").parquet(f"{sink}/rows")
    found = stored.groupBy("rule").agg(F.sum("failures").alias("failures"))
    for n, keys in enumerate(UNIQUE[table]):
        counts = key_counts(spark, list(keys), f"{sink}/keys-{n}")
        if counts is not None:
            repeated = counts.filter(F.col("n") > 1).agg(F.count(F.lit(1)).alias("failures"))
            rule = F.lit(f"({', '.join(keys)}) is not unique").alias("rule")
            found = found.unionByName(repeated.filter("failures > 0").select(rule, "failures"))
    return found


def run_to_end(
    stream: DataFrame,
    sink: str,
    checkpoint: str,
    state_partitions: int | None = None,
    state_store: str | None = None,
) -> DataFrame:
    """Processes what has arrived so far into Parquet files and reads them back.

    ``state_partitions`` is kept for life with the checkpoint, so it is chosen for the cluster
    rather than for one batch; ``state_store`` is the class that keeps the state. A query takes
    both settings over when it starts.
    """
    spark = stream.sparkSession
    wanted = {
        "spark.sql.shuffle.partitions": state_partitions and str(state_partitions),
        "spark.sql.streaming.stateStore.providerClass": state_store,
    }
    before = {name: spark.conf.get(name) for name in wanted}
    for name, value in wanted.items():
        if value is not None:
            spark.conf.set(name, value)
    try:
        query = (
            stream.writeStream.format("parquet")
            .option("path", sink)
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(sink)
