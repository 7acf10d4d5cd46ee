"""Data-quality checks with exact expected and actual values.

Simple checks of a table share one aggregate over it. A check that needs a parent table folds
the children to one row per parent before the join; rows are then counted only for parents
that were found at fault, none on clean data.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from openloop import schemas
from openloop.functions.clock import epoch_micros
from openloop.functions.durable import staged
from openloop.functions.sizing import attach, hinted
from openloop.model import AuditModel
from openloop.plans.reports import REPORTS

# Row counts, action counts and report sizes of the audited baseline.
BASELINE_COUNTS = {
    "policy": 14,
    "data_source": 18,
    "document_ref": 48000,
    "scan_run": 3395,
    "violation": 201619,
}
BASELINE_ACTIONS = {"redacted": 103829, "flagged": 40811, "ignored": 37246, "escalated": 19733}
BASELINE_REPORTS = {
    "repeat-offenders": 40,
    "policy-trend": 1313,
    "top-policies-per-department": 18,
    "scan-throughput": 24,
    "flagged-never-actioned": 9029,
    "cumulative-load": 546,
}

Line = tuple[str, str, int | None, Column]


# The categories and names of checks in this module are output names.


def _lines(df: DataFrame, lines: list[Line]) -> DataFrame:
    """Check rows out of one aggregate: category, name, expected, and the actual value as an
    aggregate over ``df``."""
    totals = df.agg(*[actual.alias(f"c{i}") for i, (_, _, _, actual) in enumerate(lines)])
    rows = [
        F.struct(
            F.lit(category).alias("category"),
            F.lit(name).alias("name"),
            F.lit(expected).cast("bigint").alias("expected"),
            F.coalesce(F.col(f"c{i}"), F.lit(0)).cast("bigint").alias("actual"),
        )
        for i, (category, name, expected, _) in enumerate(lines)
    ]
    return totals.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _together(parts: list[DataFrame]) -> DataFrame:
    rows = reduce(DataFrame.unionByName, parts)
    return rows.withColumn("ok", F.col("expected").eqNullSafe(F.col("actual")))


def _size() -> Column:
    return F.count(F.lit(1))


def _outside(column: str, allowed: tuple[str, ...]) -> Column:
    return F.count_if(~F.col(column).isin(*allowed))


def table_checks(
    model: AuditModel,
    counts: dict[str, int] = BASELINE_COUNTS,
    actions: dict[str, int] = BASELINE_ACTIONS,
    severities: tuple[str, ...] = schemas.SEVERITIES,
    environments: tuple[str, ...] = schemas.ENVIRONMENTS,
    allowed: tuple[str, ...] = schemas.ACTIONS,
) -> DataFrame:
    """Row counts, action distribution and closed value sets, one pass per table."""
    found = []
    for name, df in model.tables().items():
        lines: list[Line] = [("Counts", name, counts.get(name), _size())]
        if name == "policy":
            lines.append(
                ("Constraints", "policy.severity out of set", 0, _outside("severity", severities))
            )
        if name == "data_source":
            lines.append(
                ("Constraints", "data_source.env out of set", 0, _outside("env", environments))
            )
        if name == "violation":
            lines += [
                ("Distribution", f"action={action}", n, F.count_if(F.col("action_taken") == action))
                for action, n in actions.items()
            ]
            lines.append(
                (
                    "Constraints",
                    "violation.action_taken out of set",
                    0,
                    _outside("action_taken", allowed),
                )
            )
        found.append(_lines(df, lines))
    return _together(found)


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str | None = None):
    """Child keys without a parent row, with the number of child rows of each. Children are
    folded to one row per key before they meet the parents."""
    folded = child.groupBy(key).agg(_size().alias("n"))
    known = parent.select(F.col(parent_key or key).alias(key))
    return folded.join(known, key, "left_anti")


def integrity_checks(model: AuditModel) -> DataFrame:
    tables = model.tables()
    return _together(
        [
            _lines(
                orphans(tables[child], key, tables[parent]),
                [("Integrity", f"{child}->{parent} orphans", 0, F.sum("n"))],
            )
            for child, key, parent in schemas.FOREIGN_KEYS
        ]
    )


def duplicate_groups(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Key values that occur more than once, with how often."""
    return df.groupBy(*keys).agg(_size().alias("n")).filter(F.col("n") > 1)


def grain_check(model: AuditModel) -> DataFrame:
    (grain,) = schemas.UNIQUE["violation"]
    groups = duplicate_groups(model.violation, grain)
    return _together(
        [_lines(groups, [("Grain", "duplicate (run,doc,policy) triples", 0, _size())])]
    )


def before_first_seen(model: AuditModel) -> DataFrame:
    """Findings dated before their document was first seen."""
    facts = model.violation.withColumn("us", epoch_micros(model.violation, "detected_at"))
    seen = model.document_ref.select(
        "document_ref_id", epoch_micros(model.document_ref, "first_seen_at").alias("seen_us")
    )
    earliest = facts.groupBy("document_ref_id").agg(F.min("us").alias("earliest_us"))
    at_fault = (
        earliest.join(seen, "document_ref_id")
        .filter(F.col("earliest_us") < F.col("seen_us"))
        .select("document_ref_id", "seen_us")
    )
    return attach(facts, at_fault, "document_ref_id").filter(F.col("us") < F.col("seen_us"))


def outside_run(model: AuditModel) -> DataFrame:
    """Findings dated outside their run. A run still in flight bounds them from below only."""
    facts = model.violation.withColumn("us", epoch_micros(model.violation, "detected_at"))
    runs = model.scan_run.select(
        "scan_run_id",
        epoch_micros(model.scan_run, "started_at").alias("start_us"),
        epoch_micros(model.scan_run, "finished_at").alias("end_us"),
    )
    too_late = F.col("end_us").isNotNull()
    reach = facts.groupBy("scan_run_id").agg(
        F.min("us").alias("from_us"), F.max("us").alias("to_us")
    )
    at_fault = (
        reach.join(runs, "scan_run_id")
        .filter(
            (F.col("from_us") < F.col("start_us"))
            | (too_late & (F.col("to_us") > F.col("end_us")))
        )
        .select("scan_run_id", "start_us", "end_us")
    )
    return attach(facts, at_fault, "scan_run_id").filter(
        (F.col("us") < F.col("start_us")) | (too_late & (F.col("us") > F.col("end_us")))
    )


def overfull_runs(model: AuditModel) -> DataFrame:
    """Runs with findings in more documents than they scanned."""
    found = model.violation.groupBy("scan_run_id").agg(
        F.count_distinct("document_ref_id").alias("documents")
    )
    runs = model.scan_run.select("scan_run_id", "documents_scanned")
    return found.join(runs, "scan_run_id").filter(F.col("documents") > F.col("documents_scanned"))


def invariant_checks(model: AuditModel) -> DataFrame:
    kinds = {
        "violation before doc first_seen_at": before_first_seen,
        "violation outside its run window": outside_run,
        "run distinct docs > documents_scanned": overfull_runs,
    }
    return _together(
        [
            _lines(find(model), [("Invariants", name, 0, _size())])
            for name, find in kinds.items()
        ]
    )


def report_checks(model: AuditModel, sizes: dict[str, int] = BASELINE_REPORTS) -> DataFrame:
    """Row count of each report at its default parameters, taken before labels and order."""
    return _together(
        [
            _lines(REPORTS[slug].rows(model), [("Regression", slug, n, _size())])
            for slug, n in sizes.items()
        ]
    )


def quality_gate(
    model: AuditModel,
    counts: dict[str, int] = BASELINE_COUNTS,
    actions: dict[str, int] = BASELINE_ACTIONS,
    reports: dict[str, int] = BASELINE_REPORTS,
) -> DataFrame:
    """All 26 checks as rows (category, name, expected, actual, ok)."""
    return (
        table_checks(model, counts, actions)
        .unionByName(integrity_checks(model))
        .unionByName(grain_check(model))
        .unionByName(invariant_checks(model))
        .unionByName(report_checks(model, reports))
    )


class QualityFailure(AssertionError):
    """At least one check did not match."""


def failed_checks(checks: DataFrame) -> DataFrame:
    """The checks that do not match, each with its message."""
    message = F.format_string(
        "%s: %s: expected %d, got %d", "category", "name", "expected", "actual"
    )
    return checks.filter(~F.col("ok")).withColumn("message", message).drop("ok")


def require_pass(checks: DataFrame) -> int:
    """Number of checks when all match; raises with each mismatch spelled out otherwise. The
    input has one row per check, so it is small by construction."""
    rows = checks.collect()
    bad = [
        f"{r.category}: {r.name}: expected {r.expected}, got {r.actual}" for r in rows if not r.ok
    ]
    if bad:
        raise QualityFailure(f"{len(bad)} of {len(rows)} checks failed\n" + "\n".join(bad))
    return len(rows)


def readiness(model: AuditModel, counts: dict[str, int] = BASELINE_COUNTS) -> DataFrame:
    """One row: ``ready`` when every table has its expected row count, else ``degraded``,
    with the counts."""
    parts = [
        _lines(df, [("Counts", name, counts.get(name), _size())])
        for name, df in model.tables().items()
    ]
    rows = _together(parts)
    return rows.agg(
        F.when(F.every("ok"), "ready").otherwise("degraded").alias("status"),
        *[
            F.max(F.when(F.col("name") == name, F.col("actual"))).alias(name)
            for name in model.tables()
        ],
    )


def outside_policy_window(model: AuditModel) -> DataFrame:
    """Findings dated outside the half-open validity window of their policy. A metric: nothing
    promises that this is empty."""
    facts = model.violation.withColumn("us", epoch_micros(model.violation, "detected_at"))
    rules = model.policy.select(
        "policy_id",
        epoch_micros(model.policy, "effective_from").alias("from_us"),
        epoch_micros(model.policy, "effective_to").alias("to_us"),
    )
    ended = F.col("to_us").isNotNull() & (F.col("us") >= F.col("to_us"))
    return facts.join(hinted(rules), "policy_id").filter((F.col("us") < F.col("from_us")) | ended)


def broken_rules(df: DataFrame, table: str) -> DataFrame:
    """``df`` with the names of the row rules each row breaks, in column ``broken``."""
    names = []
    for field in schemas.TABLES[table].fields:
        if not field.nullable and field.name in df.columns:
            names.append((f"{field.name} is null", F.col(field.name).isNull()))
    for rule, good in schemas.ROW_RULES[table].items():
        names.append((rule, ~F.coalesce(F.expr(good), F.lit(True))))
    found = F.array(*[F.when(bad, F.lit(rule)) for rule, bad in names])
    return df.withColumn("broken", F.array_compact(found))


def row_rule_counts(df: DataFrame, table: str) -> DataFrame:
    """Rows that break a row rule, per rule, found ones only."""
    return (
        broken_rules(df, table)
        .select(F.explode("broken").alias("rule"))
        .groupBy("rule")
        .agg(_size().alias("failures"))
    )


def rule_counts(df: DataFrame, table: str) -> DataFrame:
    """Failures per rule, found ones only: rows breaking a row rule, and key values that occur
    more than once."""
    rows = row_rule_counts(df, table)
    for keys in schemas.UNIQUE[table]:
        groups = duplicate_groups(df, keys).agg(_size().alias("failures"))
        rows = rows.unionByName(
            groups.filter(F.col("failures") > 0).select(
                F.lit(f"({', '.join(keys)}) is not unique").alias("rule"), "failures"
            )
        )
    return rows


def split_valid(df: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """Rows that meet every rule, and the others with the names of the rules they break. All
    rows of a repeated unique key are set aside, since none can be told to be the right one."""
    marked = broken_rules(df, table)
    for keys in schemas.UNIQUE[table]:
        repeated = staged(duplicate_groups(df, keys).select(*keys, F.lit(True).alias("again")))
        rule = F.array(F.lit(f"({', '.join(keys)}) is not unique"))
        marked = (
            marked.join(hinted(repeated), list(keys), "left")
            .withColumn("broken", F.when(F.col("again"), F.concat("broken", rule)).otherwise(F.col("broken")))
            .select(*marked.columns)
        )
    clean = F.size("broken") == 0
    return marked.filter(clean).drop("broken"), marked.filter(~clean)
