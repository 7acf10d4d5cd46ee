"""Registered queries: every report and operator bound to the given tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from openloop.bindings import star
from openloop.functions.clock import (
    DAY_US,
    HOUR_US,
    day_of,
    epoch_micros,
    month_of,
    utc_day,
    utc_hour,
)
from openloop.functions.durable import shared_folder, staged
from openloop.functions.numbers import ratio
from openloop.operators.calendar import calendar_spine, documents_in_existence
from openloop.operators.gaps import consecutive_gaps, gaps_from_segments
from openloop.operators.open_loops import never_closed
from openloop.operators.percentiles import exact_percentiles
from openloop.operators.validity import (
    eligible_runs,
    first_run_after,
    number_in_force,
    policies_at,
    policies_by_month,
    policies_in_force,
)
from openloop.plans import maintenance, quality, reports, rollups, telemetry
from openloop.sources import interchange, publish, records
from openloop.streaming import deadlines, live

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


# Reports -------------------------------------------------------------------------------------


@query
def q1_repeat_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.REPORTS["repeat-offenders"].run(star.customer_model(spark, sf_dir))


@query
def q1_repeat_customers_500(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.REPORTS["repeat-offenders"].run(star.customer_model(spark, sf_dir), limit=500)


@query
def q1_repeat_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = star.table(spark, sf_dir, "events")
    instants = events.select("user_id", epoch_micros(events, "ts").alias("us"))
    return (
        reports.entity_gaps(instants, "user_id", "us", limit=40)
        .orderBy(F.desc("violation_count"), "median_gap_us", "user_id")
        .limit(40)
        .select(
            "user_id",
            "violation_count",
            utc_day(F.col("first_us")).alias("first_violation"),
            utc_day(F.col("last_us")).alias("last_violation"),
            ratio(F.col("median_gap_us"), HOUR_US, 1).alias("median_gap_hours"),
            ratio(F.col("p90_gap_us"), HOUR_US, 1).alias("p90_gap_hours"),
        )
    )


@query
def q2_type_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.REPORTS["policy-trend"].run(star.trade_model(spark, sf_dir, code="p_type"))


@query
def q3_top_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.REPORTS["top-policies-per-department"].run(star.trade_model(spark, sf_dir))


@query
def q4_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.scan_throughput_micros(star.event_model(spark, sf_dir)).orderBy("hour_utc")


@query
def q5_errors_unresolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: errors of a user with no purchase of that user within two days."""
    model = star.event_model(spark, sf_dir)
    facts = model.violation.withColumn("us", epoch_micros(model.violation, "detected_at"))
    waiting = reports.open_findings(
        facts,
        ["document_ref_id"],
        "us",
        2,
        F.col("action_taken") == model.open_action,
        F.col("action_taken").isin(*model.closing_actions),
    )
    return waiting.select(
        F.col("violation_id").alias("event_id"),
        F.col("document_ref_id").alias("user_id"),
        F.col("detected_at").alias("flagged_at"),
        ratio(F.col("age_us"), DAY_US, 1).alias("days_open"),
    ).orderBy("flagged_at", "event_id")


@query
def q5_returns_unclosed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.REPORTS["flagged-never-actioned"].run(star.trade_model(spark, sf_dir), days=30)


@query
def q6_daily_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.REPORTS["cumulative-load"].run(star.event_model(spark, sf_dir))


@query
def q6_daily_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.REPORTS["cumulative-load"].run(star.customer_model(spark, sf_dir))


@query
def w1_gaps_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps between shipments per return flag, each flag holding a third of all line items, on
    the plan for oversized groups."""
    lines = star.table(spark, sf_dir, "lineitem")
    events = lines.select("l_returnflag", epoch_micros(lines, "l_shipdate").alias("us"))
    gaps = consecutive_gaps(events, "l_returnflag", "us")
    return exact_percentiles(
        gaps,
        ["l_returnflag"],
        "gap",
        {"median_gap_us": (1, 2), "p90_gap_us": (9, 10), "longest_gap_us": (1, 1)},
        weight="n",
    )


@query
def a7_percentiles_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of price in cents per line status, each status holding half of all rows."""
    lines = star.table(spark, sf_dir, "lineitem")
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    return exact_percentiles(
        lines.select("l_linestatus", cents.alias("cents")),
        ["l_linestatus"],
        "cents",
        {"p50": (1, 2), "p90": (9, 10), "p95": (19, 20)},
    )


@query
def a7_percentiles_wide_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles per line status of values spread over 62 bits, nearly all in chunks of their
    own."""
    lines = star.table(spark, sf_dir, "lineitem")
    high = (F.col("l_orderkey") * 1000003 + F.col("l_partkey")) % 2147483647
    wide = high * 2147483647 + F.col("l_suppkey") * 7919 + F.col("l_linenumber")
    return exact_percentiles(
        lines.select("l_linestatus", wide.alias("wide")),
        ["l_linestatus"],
        "wide",
        {"smallest": (0, 1), "middle": (1, 2), "p90": (9, 10), "largest": (1, 1)},
    )


@query
def a8_sketch_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of users per start hour: how many there are, and whether median and p95 duration
    merged from stored daily sketches are off by no more of the ranks than the sketch allows."""
    model, place = star.event_model(spark, sf_dir), _shared_place(spark, "sketches")
    rollups.duration_sketches(model).write.parquet(place)
    found = rollups.throughput_from_sketches(spark.read.parquet(place))
    runs = model.scan_run.filter(F.col("finished_at").isNotNull())
    start, end = epoch_micros(runs, "started_at"), epoch_micros(runs, "finished_at")
    took = runs.select(utc_hour(start).alias("hour_utc"), (end - start).alias("took_us"))
    rank = {n: found[f"{n}_duration_us"] for n in ("median", "p95")}
    ranked = took.join(F.broadcast(found), "hour_utc").groupBy("hour_utc").agg(
        F.count(F.lit(1)).alias("runs"),
        *(F.count_if(F.col("took_us") < value).alias(f"{n}_below") for n, value in rank.items()),
        *(F.count_if(F.col("took_us") <= value).alias(f"{n}_upto") for n, value in rank.items()),
    )
    # A stored value stands for all ranks of its equals; each merge rounds to a whole rank.
    allowed = F.lit(rollups.rank_error()) * F.col("runs") + 1

    def within(n: str, share: float) -> Column:
        wanted = F.lit(share) * F.col("runs")
        off = F.greatest(F.col(f"{n}_below") - wanted, wanted - F.col(f"{n}_upto"), F.lit(0.0))
        return (off <= allowed).alias(f"{n}_within")

    return ranked.select("hour_utc", "runs", within("median", 0.5), within("p95", 0.95))


@query
def q1_from_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeat offenders from stored segments of one customer and month each."""
    model, place = star.customer_model(spark, sf_dir), _shared_place(spark, "segments")
    reports.finding_segments(model).write.partitionBy("month").parquet(place)
    return reports.repeat_offenders_of(spark.read.parquet(place), model)


@query
def s10_gaps_of_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps between the line items of each supplier, from a table bucketed by supplier and time."""
    name = f"findings_{uuid.uuid4().hex}"
    findings = star.line_findings(spark, sf_dir)
    publish.save_by_document(findings, name, publish.buckets_for(findings, 8))
    segments = staged(publish.segments_of_layout(spark, name))
    spark.sql(f"DROP TABLE {name}")
    gaps = gaps_from_segments(segments, "document_ref_id", ["time_slice"])
    return gaps.groupBy("document_ref_id").agg(
        F.sum("n").alias("gaps"), F.sum(F.col("gap") * F.col("n")).alias("span_us"),
        F.max("gap").alias("longest_us"),
    )


@query
def s9_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of four tables read back from the catalog, and whether the distinct count of a
    key that the catalog estimates lies within a tenth of the exact one."""
    found = None
    for table, key in (("lineitem", "l_suppkey"), ("orders", "o_custkey"), ("part", "p_brand"), ("events", "user_id")):
        name, given = f"{table}_{uuid.uuid4().hex}", star.table(spark, sf_dir, table)
        given.write.saveAsTable(name)
        publish.refresh_statistics(spark, name)
        rows, distinct = publish.stored_statistics(spark, name, key)
        spark.sql(f"DROP TABLE {name}")
        exact = F.count_distinct(key)
        line = given.agg(
            F.lit(table).alias("name"), F.lit(rows).cast("bigint").alias("n_rows"),
            (F.abs(exact - F.lit(distinct)) <= exact / 10).alias("distinct_close"),
        )
        found = line if found is None else found.unionByName(line)
    return found


@query
def s3_publish_and_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items per supplier of the model that was published last, of two versions."""
    place, model = _shared_place(spark, "published"), star.publishable_model(spark, sf_dir)
    half = F.col("violation_id") % 2 == 0
    publish.publish_model(replace(model, violation=model.violation.filter(half)), place, "v1")
    publish.publish_model(model, place, "v2")
    found = publish.current_model(spark, place)
    return found.violation.groupBy("document_ref_id", "action_taken").agg(F.count(F.lit(1)).alias("n"))


@query
def a14_documents_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers with line items shipped from 1995 to 1996, per brand, from monthly bitmaps."""
    place = _shared_place(spark, "bitmaps")
    rollups.write_document_bitmaps(star.trade_model(spark, sf_dir), place)
    first, last = dt.date(1995, 1, 1), dt.date(1996, 12, 1)
    by_brand = rollups.documents_between(spark, place, first, last, ["policy_code"])
    over_all = rollups.documents_between(spark, place, first, last)
    return by_brand.unionByName(over_all.withColumn("policy_code", F.lit("all")))


@query
def j5_never_closed_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned lines with no accepted line of the same status within an hour."""
    lines = star.table(spark, sf_dir, "lineitem")
    lines = lines.withColumn("us", epoch_micros(lines, "l_shipdate"))
    openers = lines.filter(F.col("l_returnflag") == "R").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_linestatus", "us", "l_shipdate"
    )
    closers = lines.filter(F.col("l_returnflag") == "A")
    keys = ["l_linestatus"]
    return never_closed(openers, closers.select(*keys, "us"), keys, "us", HOUR_US).drop("us")


# Sources -------------------------------------------------------------------------------------


@query
def s1_csv_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts written as interchange lines and parsed again by the declared types."""
    rules = star.parts(spark, sf_dir)
    columns = ["policy_id", "policy_code", "title", "severity", "effective_from", "effective_to"]
    lines = rules.select(interchange.csv_line(rules, columns).alias("line"))
    declared = (
        "policy_id bigint, policy_code string, title string, severity string,"
        " effective_from timestamp, effective_to timestamp"
    )
    dialect = {**interchange.DIALECT, "mode": "FAILFAST"}
    parsed = lines.select(F.from_csv("line", declared, dialect).alias("r")).select("r.*")
    return parsed.withColumns(
        {name: epoch_micros(parsed, name) for name in ("effective_from", "effective_to")}
    )


def _shared_place(spark: SparkSession, name: str) -> str:
    """A new place in the shared folder, which goes when the application ends."""
    place = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(place)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return place


@query
def s1_csv_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts written as a folder of interchange files and read back by the declared schema."""
    place = _shared_place(spark, "csv")
    interchange.write_table(star.parts(spark, sf_dir), place, "policy")
    rows = interchange.read_table(spark, place, "policy").drop("file_path", "block_start")
    return rows.withColumns({n: epoch_micros(rows, n) for n in ("effective_from", "effective_to")})


@query
def s8_report_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slug and number of rows of a report whose rows are stored as JSON lines."""
    slug = "cumulative-load"
    rows = reports.REPORTS[slug].run(star.event_model(spark, sf_dir))
    envelope = publish.report_result(slug, rows, _shared_place(spark, "report"))
    stored = spark.read.schema(rows.schema).json(envelope["rows"])
    return stored.agg(
        F.lit(envelope["slug"]).alias("slug"),
        F.lit(envelope["count"]).cast("bigint").alias("count"),
        F.count(F.lit(1)).alias("stored"),
        F.max("cumulative_violations").alias("last_total"),
    )


@query
def s11_action_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned lines per supplier, read from a layout that is split by action."""
    place = _shared_place(spark, "by-action")
    publish.save_by_action(star.line_findings(spark, sf_dir), place)
    returned = spark.read.parquet(place).filter(F.col("action_taken") == "R")
    return returned.groupBy("document_ref_id").agg(F.count(F.lit(1)).alias("n"))


@query
def s2_dense_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items numbered 1..N in file order."""
    rows = star.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.row_index").alias("row_index"),
    )
    return interchange.number_stored_rows(rows, "violation_id")


@query
def s4_resolve_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order records matched by natural key with all customers. Those in debit go by another
    name here, so their records stay unknown."""
    renamed = F.when(F.col("c_acctbal") >= 0, F.col("c_name")).otherwise(F.concat("c_name", F.lit(" ")))
    documents = star.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("document_ref_id"),
        F.col("c_nationkey").alias("data_source_id"),
        renamed.alias("external_document_id"),
    )
    flat = records.star_columns(star.flat_records(spark, sf_dir))
    found, unknown = records.resolve_documents(flat, star.nations(spark, sf_dir), documents)
    return found.unionByName(unknown, allowMissingColumns=True)


@query
def s5_flat_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.documents_in(star.flat_records(spark, sf_dir))


@query
def s5_flat_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.sources_in(star.flat_records(spark, sf_dir))


@query
def s6_csv_lines_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = star.parts(spark, sf_dir)
    columns = ["policy_code", "title", "severity", "effective_from", "effective_to"]
    return rules.select("policy_id", interchange.csv_line(rules, columns).alias("line"))


@query
def s6_csv_lines_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = star.table(spark, sf_dir, "documents")
    columns = ["lang", "source", "n_chars", "text"]
    return texts.select("doc_id", interchange.csv_line(texts, columns).alias("line"))


# Data quality --------------------------------------------------------------------------------

# Row and action counts of the given tables at scale 0.01.
TRADE_COUNTS = {
    "policy": 2000,
    "data_source": 25,
    "document_ref": 100,
    "scan_run": 15000,
    "violation": 60000,
}
TRADE_ACTIONS = {"A": 20000, "N": 20000, "R": 20000}
TRADE_REPORTS = {
    "repeat-offenders": 40,
    "policy-trend": 10000,
    "top-policies-per-department": 15,
    "scan-throughput": 1,
    "flagged-never-actioned": 20000,
    "cumulative-load": 2495,
}


@query
def k_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks on the trade tables, whose actions have three values."""
    return quality.quality_gate(
        star.trade_model(spark, sf_dir), TRADE_COUNTS, TRADE_ACTIONS, TRADE_REPORTS
    )


@query
def k30_failed_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Integrity, grain and invariant checks that do not match on the trade tables."""
    model = star.trade_model(spark, sf_dir)
    checks = quality.integrity_checks(model).unionByName(quality.grain_check(model))
    return quality.failed_checks(checks.unionByName(quality.invariant_checks(model)))


@query
def k10_orphans_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of orders that never appear as users of events."""
    users = star.table(spark, sf_dir, "events").select("user_id").distinct()
    orders = star.table(spark, sf_dir, "orders")
    return quality.orphans(orders, "o_custkey", users, "user_id")


@query
def k10_orphans_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = star.table(spark, sf_dir, "labels")
    return quality.orphans(labels, "doc_id", star.table(spark, sf_dir, "documents")).agg(
        F.count(F.lit(1)).alias("orphan_keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("orphans")
    )


@query
def k17_grain_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = star.table(spark, sf_dir, "lineitem")
    return quality.duplicate_groups(lines, ("l_orderkey", "l_linenumber"))


@query
def k18_before_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.before_first_seen(star.trade_model(spark, sf_dir))
    return found.select("scan_run_id", "document_ref_id", "policy_id", "line", "detected_at")


@query
def k19_outside_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.outside_run(star.trade_model(spark, sf_dir))
    return found.select("scan_run_id", "document_ref_id", "policy_id", "line", "detected_at")


@query
def k20_overfull_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.overfull_runs(star.trade_model(spark, sf_dir))


@query
def k27_outside_policy_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.outside_policy_window(star.trade_model(spark, sf_dir))
    return found.groupBy("policy_id").agg(F.count(F.lit(1)).alias("findings"))


@query
def k28_rule_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = star.trade_model(spark, sf_dir).tables()
    parts = [
        quality.rule_counts(df, name).withColumn("table_name", F.lit(name))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def k28_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations set aside by the rules of a data source, with the rules they break."""
    _, bad = quality.split_valid(star.nations(spark, sf_dir), "data_source")
    return bad.withColumn("broken", F.array_join("broken", "; "))


@query
def k28_quarantine_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts set aside by the rules of a policy: their codes repeat, some end before they begin."""
    _, bad = quality.split_valid(star.parts(spark, sf_dir), "policy")
    return bad.withColumn("broken", F.array_join("broken", "; "))


@query
def k31_readiness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.readiness(star.trade_model(spark, sf_dir), TRADE_COUNTS)


@query
def a14_documents_with_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.documents_with_findings(star.trade_model(spark, sf_dir))


# Maintenance ---------------------------------------------------------------------------------


@query
def m1_retract_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings left per supplier after all urgent orders are retracted."""
    model = star.trade_model(spark, sf_dir)
    ids = model.scan_run.filter(F.col("agent_version") == "1-URGENT")
    findings, runs = maintenance.retract_runs(model.violation, model.scan_run, ids)
    left = findings.groupBy("document_ref_id").agg(F.count(F.lit(1)).alias("n"))
    return left.unionByName(
        runs.agg(F.lit(-1).cast("bigint").alias("document_ref_id"), F.count(F.lit(1)).alias("n"))
    )


@query
def m2_still_referenced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of size 50 that line items still refer to, so they may not be deleted."""
    ids = star.table(spark, sf_dir, "part").filter(F.col("p_size") == 50)
    return maintenance.still_referenced(
        ids.select(F.col("p_partkey").alias("policy_id")),
        star.line_findings(spark, sf_dir),
        "policy_id",
    )


@query
def m3_supersede_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first part without an end is closed on 1998-01-01 and followed by a new one."""
    policy = star.parts(spark, sf_dir).withColumn(
        "policy_code", F.concat(F.lit("P"), F.col("policy_id").cast("string"))
    )
    first = policy.filter(F.col("effective_to").isNull()).agg(F.min("policy_id")).first()[0]
    successor = spark.range(1).select(
        F.lit("P-NEW").alias("policy_code"),
        F.lit("SUCCESSOR").alias("title"),
        F.lit("high").alias("severity"),
    )
    at = F.expr("timestamp_ntz'1998-01-01 00:00:00'")
    return maintenance.supersede_policy(policy, f"P{first}", at, successor)


@query
def m4_first_per_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = star.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
    return maintenance.first_per_grain(lines, ["l_orderkey", "l_linenumber"], order)


def _repeated_load(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Line items with a key of their own, and a batch that brings all returned lines again with
    later keys (every third one with an earlier key), next to lines of new orders."""
    table = star.table(spark, sf_dir, "lineitem")
    day = F.unix_date(day_of(table, "l_shipdate")).cast("bigint")
    number = (day * 100 + F.col("l_linenumber")) * 100 + F.ascii("l_returnflag")
    later = F.when(F.col("l_linenumber") % 2 == 0, 1).otherwise(-1)
    columns = ("l_suppkey", "l_partkey", "l_returnflag")
    lines = table.select(number.alias("violation_id"), "l_orderkey", *columns)
    again = table.filter(F.col("l_returnflag") == "R").select(
        (number + later).alias("violation_id"), "l_orderkey", *columns
    )
    new = table.select(number.alias("violation_id"), (-F.col("l_orderkey")).alias("l_orderkey"), *columns)
    return lines, again.unionByName(new)


LINE_GRAIN = ["l_orderkey", "l_suppkey", "l_partkey"]


@query
def m4_add_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    existing, batch = _repeated_load(spark, sf_dir)
    return maintenance.add_findings(existing, batch, "keep_first", LINE_GRAIN)


@query
def m4_repeated_in_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    existing, batch = _repeated_load(spark, sf_dir)
    return maintenance.repeated_findings(existing, batch, LINE_GRAIN)


# Request log ---------------------------------------------------------------------------------


@query
def l1_requests_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry.requests_by_status(star.request_log(spark, sf_dir))


@query
def l2_latency_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry.latency_histogram(star.request_log(spark, sf_dir))


@query
def l3_load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry.load_summary(star.request_log(spark, sf_dir))


@query
def l3_load_summary_by_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = star.request_log(spark, sf_dir)
    return telemetry.load_summary(log.withColumn("day", day_of(log, "ts")), ["day", "route"])


@query
def l4_redact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event records with credentials in nested fields, after redaction, as JSON."""
    events = star.table(spark, sf_dir, "events")
    log = events.select(
        "event_id",
        F.struct(
            F.struct(
                F.col("props").alias("authorization"),
                F.col("props").alias("cookie"),
                F.col("event_type").alias("accept"),
            ).alias("headers"),
            F.col("user_id").alias("user"),
        ).alias("req"),
        F.struct(F.col("user_id").alias("name"), F.col("props").alias("password")).alias("db"),
        F.col("props").alias("password"),
    )
    kept = telemetry.redact(log)
    inside = [c for c in kept.columns if c != "event_id"]
    return kept.select("event_id", F.to_json(F.struct(*inside)).alias("record"))


@query
def l4_redact_maps_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event records with credentials as keys of maps, in arrays and in a struct of nothing
    else, after redaction, as JSON."""
    events = star.table(spark, sf_dir, "events")
    secret = F.col("props").alias("password")
    log = events.select(
        "event_id",
        F.struct(
            F.create_map(
                F.lit("authorization"), F.col("props"), F.lit("accept"), F.col("event_type"),
                F.lit("cookie"), F.col("props"),
            ).alias("headers"),
            F.col("user_id").alias("user"),
        ).alias("req"),
        F.array(F.struct(F.col("user_id").alias("name"), secret)).alias("db"),
        F.struct(F.col("props").alias("authorization"), F.col("props").alias("cookie")).alias("headers"),
        F.create_map(F.lit("first"), F.create_map(F.lit("password"), F.col("props"))).alias("pools"),
    )
    kept = telemetry.redact(log, (*telemetry.SENSITIVE_PATHS, "pools.*.password"))
    inside = [c for c in kept.columns if c != "event_id"]
    return kept.select("event_id", F.to_json(F.struct(*inside)).alias("record"))


@query
def l5_outages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of an endpoint without one successful request."""
    log = star.request_log(spark, sf_dir)
    return telemetry.outages(log.withColumn("day", day_of(log, "ts")), ["day", "endpoint"])


# Lookups and named extensions ----------------------------------------------------------------


@query
def p11_policies_in_force(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.expr("timestamp_ntz'1995-11-12 00:00:00'")
    return policies_in_force(star.parts(spark, sf_dir), at)


@query
def p11_policies_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, last = F.lit("1994-01-01").cast("date"), F.lit("1998-12-01").cast("date")
    listed = policies_by_month(star.parts(spark, sf_dir), first, last)
    return listed.groupBy("month", "severity").agg(F.count(F.lit(1)).alias("policies"))


@query
def p11_policies_at_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each line item the number of policies in force when it was shipped."""
    lines = star.table(spark, sf_dir, "lineitem")
    lines = lines.select("l_orderkey", "l_linenumber", epoch_micros(lines, "l_shipdate").alias("us"))
    return number_in_force(lines, "us", star.parts(spark, sf_dir)).drop("us")


@query
def p11_own_policy_in_force(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line items whose own part was in force when they were shipped."""
    facts = star.line_findings(spark, sf_dir)
    facts = facts.select(
        "scan_run_id", "line", "policy_id", epoch_micros(facts, "detected_at").alias("us")
    )
    found = policies_at(facts, "us", star.parts(spark, sf_dir), {"policy_id": "policy_id"})
    return found.select("scan_run_id", "line", "policy_id", "severity")


@query
def j9_first_run_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each returned line item the first order placed after it was shipped. Many orders are
    placed at one instant, and after the last order there is none."""
    facts = star.line_findings(spark, sf_dir)
    facts = facts.filter(F.col("action_taken") == "R")
    flags = facts.select(
        F.col("scan_run_id").alias("flagged_in"), "line", epoch_micros(facts, "detected_at").alias("us")
    )
    return first_run_after(flags, "us", star.order_runs(spark, sf_dir))


@query
def j9_eligible_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors with the number of user-day runs that start within the next two days."""
    model = star.event_model(spark, sf_dir)
    flags = model.violation.filter(F.col("action_taken") == "error").select(
        F.col("violation_id").alias("event_id"), F.col("detected_at").alias("flagged_at")
    )
    return eligible_runs(flags, model.scan_run, 2)


@query
def e1_daily_orders_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = reports.daily_counts(star.customer_model(spark, sf_dir))
    return reports.with_running_load(calendar_spine(daily, "day", "violations", "day"))


@query
def e1_monthly_trend_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    monthly = reports.monthly_counts(star.trade_model(spark, sf_dir, code="p_type"))
    keys = ["policy_code", "severity", "department"]
    return reports.with_change(calendar_spine(monthly, "month", "violations", "month", keys))


@query
def e2_documents_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers that had ordered at or before each month start."""
    orders = star.table(spark, sf_dir, "orders")
    first = orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("seen"))
    start = month_of(first, "seen")
    whole = start.cast("timestamp_ntz") == F.col("seen")
    month = F.when(whole, start).otherwise(F.add_months(start, 1))
    return documents_in_existence(first.select(month.alias("month")))


@query
def e3_hit_rate_by_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.hit_rate(star.trade_model(spark, sf_dir))


@query
def e4_daily_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.daily_rollup(star.trade_model(spark, sf_dir))


@query
def e4_rollup_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range of days read from the rollup as it is stored."""
    place = _shared_place(spark, "rollup")
    rollups.write_rollup(star.trade_model(spark, sf_dir), place)
    return rollups.read_rollup(spark, place, dt.date(1996, 3, 10), dt.date(1997, 2, 20))


@query
def e4_rollup_after_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rollup of the line items shipped before June 1998, after the later ones were added and
    all urgent orders retracted."""
    model = star.trade_model(spark, sf_dir)
    facts, place = model.violation, _shared_place(spark, "rollup")
    late = F.col("detected_at") >= F.expr("timestamp_ntz'1998-06-01 00:00:00'")
    rollups.write_rollup(replace(model, violation=facts.filter(~late)), place)
    rollups.change_rollup(spark, place, 1, added=facts.filter(late))
    ids = model.scan_run.filter(F.col("agent_version") == "1-URGENT")
    rollups.change_rollup(spark, place, 2, retracted=maintenance.findings_of_runs(facts, ids))
    return rollups.read_rollup(spark, place)


@query
def e4_load_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = star.trade_model(spark, sf_dir)
    chosen = model.between(dt.date(1996, 3, 10), dt.date(1997, 2, 20))
    return reports.REPORTS["cumulative-load"].run(chosen)


@query
def e4_trend_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = star.trade_model(spark, sf_dir, code="p_type")
    chosen = model.between(dt.date(1996, 3, 10), dt.date(1997, 2, 20))
    return reports.REPORTS["policy-trend"].run(chosen)


@query
def f12_external_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document ids in their composed form: source name and six-digit number."""
    customer, nation = star.table(spark, sf_dir, "customer"), star.table(spark, sf_dir, "nation")
    joined = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    return joined.select(
        "c_custkey", records.external_id(F.col("n_name"), F.col("c_custkey")).alias("external_id")
    )


# Streams -------------------------------------------------------------------------------------


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A pattern that matches this name only: one file or a folder of part files.
    arriving = spark.readStream.schema(star.GIVEN["events"]).parquet(f"{sf_dir}/events.parque[t]")
    return live.with_event_time(arriving, "ts")


def _drain(stream: DataFrame, state_store: str | None = None) -> DataFrame:
    place = _shared_place(stream.sparkSession, "live")
    cores = stream.sparkSession.sparkContext.defaultParallelism
    return live.run_to_end(stream, f"{place}/rows", f"{place}/progress", cores, state_store)


@query
def t1_live_unresolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors without a purchase in two days, emitted by a stream at the end of the two days."""
    stream = deadlines.never_closed_live(
        _event_stream(spark, sf_dir),
        ["user_id"],
        F.col("event_type") == "error",
        F.col("event_type") == "purchase",
        days=2,
        lateness_hours=1,
    )
    flags = stream.select("event_id", "user_id", F.col("ts").alias("flagged_at"))
    return _drain(flags, deadlines.STATE_STORE)


@query
def t2_live_daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drain(live.daily_counts_live(_event_stream(spark, sf_dir), lateness_hours=1))


@query
def t3_live_rule_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row rules of findings checked on each micro-batch of events, summed over the batches."""
    arriving = _event_stream(spark, sf_dir)
    findings = arriving.select(
        F.col("event_id").alias("violation_id"),
        F.col("user_id").alias("document_ref_id"),
        day_of(arriving, "ts").alias("scan_run_id"),
        F.col("event_type").alias("policy_id"),
        F.when(F.col("event_type") == "error", "flagged")
        .when(F.col("event_type") == "purchase", "redacted")
        .otherwise(F.col("event_type"))
        .alias("action_taken"),
        F.nullif(F.col("event_type"), F.lit("view")).alias("reason"),
    )
    place = _shared_place(spark, "live")
    live.check_each_batch(
        findings, "violation", f"{place}/rows", f"{place}/progress"
    ).awaitTermination()
    return live.failures_so_far(spark, "violation", f"{place}/rows")


@query
def t4_live_first_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    grain = ("user_id", "event_type")
    stream = live.first_arrivals(_event_stream(spark, sf_dir), grain, within_hours=24 * 40)
    return _drain(stream.select(*grain))
