"""Role mappings: the given trade and event tables read as an audit star.

Every mapping is a projection of whole tables, so a report's filters and column choice still
reach the Parquet scans below it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from openloop.functions.clock import epoch_micros, utc_day
from openloop.model import AuditModel
from openloop.plans.maintenance import first_per_grain
from openloop.schemas import ENVIRONMENTS, SEVERITIES

# Severity given to each part type. ECONOMY stands outside the ladder.
SEVERITY_OF_TYPE = {
    "PROMO": "critical",
    "LARGE": "high",
    "STANDARD": "medium",
    "MEDIUM": "medium",
    "SMALL": "low",
    "ECONOMY": "unrated",
}
# Action given to each return flag where the declared schema is asked for.
ACTION_OF_FLAG = {"R": "flagged", "A": "redacted", "N": "ignored"}
# Environment given to each region.
ENV_OF_REGION = {
    "AFRICA": "dev",
    "AMERICA": "prod",
    "ASIA": "prod",
    "EUROPE": "staging",
    "MIDDLE EAST": "test",
}


# Declared schemas of the given tables, so that no job is spent on reading them.
GIVEN = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
    " p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,"
    " value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(GIVEN[name]).parquet(f"{sf_dir}/{name}.parquet")


def _lookup(value: Column, names: dict[str, str]) -> Column:
    mapped = F.lit(None).cast("string")
    for source, target in names.items():
        mapped = F.when(value == source, target).otherwise(mapped)
    return mapped


def nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """data_source = nation, department = its region."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("data_source_id"),
        F.col("n_name").alias("name"),
        F.col("r_name").alias("department"),
        _lookup(F.col("r_name"), ENV_OF_REGION).alias("env"),
    )


def parts(spark: SparkSession, sf_dir: str, code: str = "p_brand") -> DataFrame:
    """policy = part, in force from a day set by its size until, for some, a day set by price."""
    epoch = F.expr("timestamp_ntz'1992-01-01 00:00:00'")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("policy_id"),
        F.col(code).alias("policy_code"),
        F.col("p_type").alias("title"),
        _lookup(F.col("p_type"), SEVERITY_OF_TYPE).alias("severity"),
        (epoch + F.make_dt_interval(F.col("p_size") * 30)).alias("effective_from"),
        F.when(
            F.col("p_size") > 25,
            epoch + F.make_dt_interval(F.col("p_retailprice").cast("int") * 2),
        ).alias("effective_to"),
    )


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """document_ref = supplier, first seen on a day set by its nation."""
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("document_ref_id"),
        F.col("s_nationkey").alias("data_source_id"),
        F.col("s_name").alias("external_document_id"),
        (
            F.expr("timestamp_ntz'1995-01-01 00:00:00'")
            + F.make_dt_interval(F.col("s_nationkey") * 30)
        ).alias("first_seen_at"),
    )


def order_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """scan_run = order; status O is still in flight, others end after 60 days."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("scan_run_id"),
        F.col("o_orderdate").alias("started_at"),
        F.when(
            F.col("o_orderstatus") != "O", F.col("o_orderdate") + F.make_dt_interval(F.lit(60))
        ).alias("finished_at"),
        F.col("o_orderpriority").alias("agent_version"),
        F.floor(F.col("o_totalprice") / 100000).cast("int").alias("documents_scanned"),
    )


def line_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """violation = lineitem: run = order, document = supplier, policy = part."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("scan_run_id"),
        F.col("l_suppkey").alias("document_ref_id"),
        F.col("l_partkey").alias("policy_id"),
        F.col("l_returnflag").alias("action_taken"),
        F.col("l_linestatus").alias("reason"),
        F.col("l_shipdate").alias("detected_at"),
        F.col("l_linenumber").alias("line"),
    )


def trade_model(spark: SparkSession, sf_dir: str, code: str = "p_brand") -> AuditModel:
    return AuditModel(
        policy=parts(spark, sf_dir, code),
        data_source=nations(spark, sf_dir),
        document_ref=suppliers(spark, sf_dir),
        scan_run=order_runs(spark, sf_dir),
        violation=line_findings(spark, sf_dir),
        open_action="R",
        closing_actions=("A", "N"),
    )


def publishable_model(spark: SparkSession, sf_dir: str) -> AuditModel:
    """The trade tables under the rules of the declared schema: values from its closed sets, codes
    of their own, and the first line item of each (order, supplier, part), and of each (order, line),
    with known parents."""
    policy = parts(spark, sf_dir).withColumns({
        "policy_code": F.concat(F.lit("P-"), F.col("policy_id").cast("string")),
        "severity": F.when(F.col("severity").isin(*SEVERITIES), F.col("severity")).otherwise("low"),
        "effective_to": F.when(F.col("effective_to") > F.col("effective_from"), F.col("effective_to")),
    })
    sources = nations(spark, sf_dir)
    env = F.when(F.col("env").isin(*ENVIRONMENTS), F.col("env")).otherwise("dev")
    action = F.create_map(*(F.lit(x) for pair in ACTION_OF_FLAG.items() for x in pair))
    findings = line_findings(spark, sf_dir)
    for parent, key in ((order_runs, "scan_run_id"), (suppliers, "document_ref_id"), (parts, "policy_id")):
        findings = findings.join(parent(spark, sf_dir).select(key), key, "left_semi")
    findings = findings.select(
        (F.col("scan_run_id") * 8 + F.col("line")).alias("violation_id"), "scan_run_id", "document_ref_id",
        "policy_id", action[F.col("action_taken")].alias("action_taken"), "reason", "detected_at",
    )
    rest = ["action_taken", "reason", "detected_at"]
    grain = ["scan_run_id", "document_ref_id", "policy_id"]
    findings = first_per_grain(findings, grain, ["violation_id", *rest])
    return AuditModel(
        policy=policy,
        data_source=sources.withColumn("env", env),
        document_ref=suppliers(spark, sf_dir),
        scan_run=order_runs(spark, sf_dir),
        violation=first_per_grain(findings, ["violation_id"], [*grain[1:], *rest]),
    )


def customer_model(spark: SparkSession, sf_dir: str) -> AuditModel:
    """document = customer, finding = order."""
    return AuditModel(
        data_source=nations(spark, sf_dir),
        document_ref=table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("document_ref_id"),
            F.col("c_nationkey").alias("data_source_id"),
            F.col("c_name").alias("external_document_id"),
        ),
        violation=table(spark, sf_dir, "orders").select(
            F.col("o_custkey").alias("document_ref_id"),
            F.col("o_orderstatus").alias("action_taken"),
            F.col("o_orderdate").alias("detected_at"),
        ),
    )


def event_model(spark: SparkSession, sf_dir: str) -> AuditModel:
    """finding = event; run = one user's events of one day, in flight while it has one event."""
    events = table(spark, sf_dir, "events")
    us = epoch_micros(events, "ts")
    runs = events.groupBy("user_id", utc_day(us).alias("day")).agg(
        F.min("ts").alias("started_at"),
        F.when(F.count(F.lit(1)) > 1, F.max("ts")).alias("finished_at"),
        F.count(F.lit(1)).alias("documents_scanned"),
    )
    return AuditModel(
        scan_run=runs,
        violation=events.select(
            F.col("event_id").alias("violation_id"),
            F.col("user_id").alias("document_ref_id"),
            F.col("event_type").alias("action_taken"),
            F.col("props").alias("reason"),
            F.col("ts").alias("detected_at"),
        ),
        open_action="error",
        closing_actions=("purchase",),
    )


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request log = events: route = event type, an error answers 500, latency from value."""
    events = table(spark, sf_dir, "events")
    return events.select(
        F.concat(F.lit("/"), "event_type", F.lit("?user="), F.col("user_id").cast("string")).alias(
            "endpoint"
        ),
        F.concat(F.lit("/"), "event_type").alias("route"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"),
        F.floor(F.col("value") * 10).cast("bigint").alias("latency_ms"),
        F.when(F.col("event_type") != "error", F.col("user_id")).alias("rows"),
        F.col("ts"),
    )


def flat_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat audit records = orders: index = nation, document = customer."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    named = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        "c_custkey", "c_name", "n_name"
    )
    return orders.join(named, orders.o_custkey == named.c_custkey).select(
        F.col("n_name").alias("target_index"),
        F.col("c_name").alias("target_document_id"),
        F.col("o_orderstatus").alias("action_taken"),
        F.col("o_orderpriority").alias("reason"),
        F.col("o_orderdate").alias("timestamp"),
    )
