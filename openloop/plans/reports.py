"""The six audit reports. Each takes an :class:`AuditModel` and returns a DataFrame. Building
one may already run jobs: where an intermediate result is used more than once, it is stored."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from openloop.functions.clock import (
    DAY_US,
    HOUR_US,
    as_interval,
    day_of,
    epoch_micros,
    month_of,
    utc_day,
    utc_hour,
)
from openloop.functions.durable import durable, staged
from openloop.functions.numbers import percent, ratio, severity_rank
from openloop.functions.sizing import MOST_BROADCAST_ROWS, is_small
from openloop.model import AuditModel
from openloop.operators.gaps import (
    consecutive_gaps,
    counts_from_segments,
    gap_segments,
    gaps_from_segments,
    gaps_of_small,
)
from openloop.operators.open_loops import never_closed
from openloop.operators.percentiles import exact_percentiles

MEDIAN, P90, P95 = (1, 2), (9, 10), (19, 20)


def _bounded(name: str, value: int, low: int, high: int) -> int:
    if isinstance(value, bool) or not isinstance(value, int) or not low <= value <= high:
        raise ValueError(f"{name} must be a whole number from {low} to {high}, got {value!r}")
    return value


# Narrow rows of one group that one task may sort.
MOST_ROWS_PER_TASK = 2_000_000


def _leading_gaps(events: DataFrame, key: str, us: str, leading: DataFrame) -> DataFrame:
    """Gaps of the leading entities, on the plan their measured size allows.

    Up to a million keys are broadcast. Beyond that nearly all of them tie at the smallest
    count, each with at most a millionth of the events, so these may meet in a shuffle. The
    others are fewer than the report's limit; they are broadcast, and their events kept out of
    the shuffle. An entity goes to a single task only when the largest one is small.
    """
    size, least, most = leading.agg(
        F.count(F.lit(1)), F.min("violation_count"), F.max("violation_count")
    ).first()
    if size <= MOST_BROADCAST_ROWS:
        theirs = events.join(F.broadcast(leading.select(key)), key, "left_semi")
    else:
        top = F.broadcast(leading.filter(F.col("violation_count") > least).select(key))
        tied = leading.filter(F.col("violation_count") == least).select(key)
        rest = events.join(top, key, "left_anti").join(tied, key, "left_semi")
        theirs = events.join(top, key, "left_semi").unionByName(rest)
    if (most or 0) <= MOST_ROWS_PER_TASK:
        return gaps_of_small(theirs, key, us)
    return consecutive_gaps(theirs, key, us)


def entity_gaps(
    events: DataFrame, key: str, us: str, label: DataFrame | None = None, limit: int = 40
) -> DataFrame:
    """Entities of ``events`` with two or more events whose count is among the ``limit``
    largest (ties kept), each with first and last instant and median and p90 gap.

    ``label`` is an optional table with one row per key; entities without a row drop out.
    Counting folds on the map side, once, into a stored table of one row per entity. The leading
    entities are stored as well, so their number is known, and gaps, the expensive part, are
    taken for them alone: events are read twice in all. Distinct gaps of one entity
    add up to at most its time span, so there are at most sqrt(2 x span) of them, 25 million
    for a decade of microseconds.
    """
    counted = events.groupBy(key).agg(
        F.count(F.lit(1)).alias("violation_count"),
        F.min(us).alias("first_us"),
        F.max(us).alias("last_us"),
    )
    leading = _leading(counted, key, label, limit)
    return _with_gaps(leading, _leading_gaps(events.select(key, us), key, us, leading), key)


def _leading(counted: DataFrame, key: str, label: DataFrame | None, limit: int) -> DataFrame:
    counted = staged(counted.filter(F.col("violation_count") >= 2))
    known = counted if label is None else counted.join(label.select(key), key, "left_semi")
    cutoff = (
        known.select("violation_count")
        .orderBy(F.desc("violation_count"))
        .limit(limit)
        .agg(F.min("violation_count").alias("least"))
    )
    leading = counted.filter(F.col("violation_count") >= cutoff.scalar())
    return durable(leading if label is None else leading.join(label, key))


def _with_gaps(leading: DataFrame, gaps: DataFrame, key: str) -> DataFrame:
    found = exact_percentiles(
        gaps,
        [key],
        "gap",
        {"median_gap_us": MEDIAN, "p90_gap_us": P90},
        weight="n",
        few_distinct=True,
    )
    return leading.join(found, key)


def entity_gaps_of_segments(
    segments: DataFrame,
    key: str,
    segment: list[str],
    label: DataFrame | None = None,
    limit: int = 40,
) -> DataFrame:
    """:func:`entity_gaps` from stored segments (see :func:`openloop.operators.gaps.gap_segments`):
    the events themselves are not read, so a new month costs what the new month holds."""
    leading = _leading(counts_from_segments(segments, key), key, label, limit)
    theirs = segments.join(leading.select(key), key, "left_semi")
    return _with_gaps(leading, gaps_from_segments(theirs, key, segment), key)


def _document_labels(model: AuditModel) -> DataFrame:
    source = model.data_source.select(
        "data_source_id", "department", F.col("name").alias("data_source")
    )
    documents = model.document_ref.select(
        "document_ref_id", "data_source_id", "external_document_id"
    )
    return documents.join(source, "data_source_id")


def _repeat_offenders(found: DataFrame, limit: int) -> DataFrame:
    return (
        found.orderBy(
            F.desc("violation_count"), F.asc_nulls_last("median_gap_us"), "external_document_id"
        )
        .limit(limit)
        .select(
            "department",
            "data_source",
            "external_document_id",
            "violation_count",
            utc_day(F.col("first_us")).alias("first_violation"),
            utc_day(F.col("last_us")).alias("last_violation"),
            ratio(F.col("median_gap_us"), HOUR_US, 1).alias("median_gap_hours"),
            ratio(F.col("p90_gap_us"), HOUR_US, 1).alias("p90_gap_hours"),
        )
    )


def repeat_offenders(model: AuditModel, limit: int = 40) -> DataFrame:
    """Documents that offend again and again, with the typical gap between two findings."""
    _bounded("limit", limit, 1, 500)
    events = model.violation.select(
        "document_ref_id", epoch_micros(model.violation, "detected_at").alias("us")
    )
    found = entity_gaps(events, "document_ref_id", "us", _document_labels(model), limit)
    return _repeat_offenders(found, limit)


def finding_segments(model: AuditModel) -> DataFrame:
    """Findings folded to one segment per document and UTC month; see :func:`repeat_offenders_of`."""
    facts = model.violation
    events = facts.select(
        "document_ref_id",
        month_of(facts, "detected_at").alias("month"),
        epoch_micros(facts, "detected_at").alias("us"),
    )
    return gap_segments(events, "document_ref_id", "us", ["month"])


def repeat_offenders_of(segments: DataFrame, model: AuditModel, limit: int = 40) -> DataFrame:
    """:func:`repeat_offenders` from stored segments of the findings."""
    _bounded("limit", limit, 1, 500)
    found = entity_gaps_of_segments(
        segments, "document_ref_id", ["month"], _document_labels(model), limit
    )
    return _repeat_offenders(found, limit)


def _labelled_counts(model: AuditModel, facts: DataFrame, labels: list[str], by: list[str]):
    """Counts of ``facts`` by department, the policy columns ``labels`` and the fact columns
    ``by``.

    While documents are few enough to broadcast, facts meet their labels on the map side and
    only finished counts are shuffled. Beyond that, facts are first folded to one row per
    (document, policy, ``by``), so that a document with very many findings reaches the shuffle
    join as a handful of rows.
    """
    source = model.data_source.select("data_source_id", "department")
    owner = model.document_ref.select("document_ref_id", "data_source_id")
    owner = owner.join(source, "data_source_id").select("document_ref_id", "department")
    rules = model.policy.select("policy_id", *labels)
    size = F.count(F.lit(1))
    if is_small(model.document_ref):
        owner = F.broadcast(owner)
    else:
        facts = facts.groupBy("document_ref_id", "policy_id", *by).agg(size.alias("n"))
        size = F.sum("n")
    return (
        facts.join(owner, "document_ref_id")
        .join(rules, "policy_id")
        .groupBy("department", *labels, *by)
        .agg(size.alias("violations"))
    )


def monthly_counts(model: AuditModel) -> DataFrame:
    """Findings per policy, severity, department and UTC month."""
    facts = model.violation.select(
        "document_ref_id", "policy_id", month_of(model.violation, "detected_at").alias("month")
    )
    return _labelled_counts(model, facts, ["policy_code", "severity"], ["month"])


def with_change(monthly: DataFrame) -> DataFrame:
    """Change from the previous row of the same policy and department, absolute and percent."""
    series = Window.partitionBy("policy_code", "department").orderBy("month")
    before = F.lag("violations").over(series)
    return monthly.select(
        "policy_code",
        "severity",
        "department",
        "month",
        "violations",
        (F.col("violations") - before).alias("mom_delta"),
        percent(F.col("violations") - before, before).alias("mom_pct"),
    )


def policy_trend(model: AuditModel) -> DataFrame:
    """Month-over-month movement. The comparison is with the previous month that has rows."""
    return with_change(monthly_counts(model)).orderBy("policy_code", "department", "month")


def top_policies(model: AuditModel, k: int = 3) -> DataFrame:
    """The policies that fire most in each department, true ties kept."""
    facts = model.violation.select("document_ref_id", "policy_id")
    counts = _labelled_counts(model, facts, ["policy_code", "title", "severity"], [])
    counts = counts.withColumn("severity_rank", severity_rank(F.col("severity")))
    by_volume = Window.partitionBy("department").orderBy(
        F.desc("violations"), F.desc_nulls_first("severity_rank"), "policy_code"
    )
    everything = F.sum("violations").over(Window.partitionBy("department"))
    return (
        counts.withColumns(
            {
                "rnk": F.rank().over(by_volume),
                "pct_of_department": percent(F.col("violations"), everything),
            }
        )
        .filter(F.col("rnk") <= k)
        .orderBy("department", "rnk")
        .select(
            "department",
            F.col("rnk").cast("bigint").alias("rnk"),
            "policy_code",
            "severity",
            "title",
            "violations",
            "pct_of_department",
        )
    )


def scan_throughput_micros(model: AuditModel) -> DataFrame:
    """Per UTC start hour of finished runs: volume, rate and duration percentiles in
    microseconds. Totals fold to a row per hour in the scan tasks, durations to their distinct
    values."""
    runs = model.scan_run.filter(F.col("finished_at").isNotNull())
    start, end = epoch_micros(runs, "started_at"), epoch_micros(runs, "finished_at")
    runs = runs.select(
        utc_hour(start).alias("hour_utc"), "documents_scanned", (end - start).alias("took_us")
    )
    totals = runs.groupBy("hour_utc").agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum("documents_scanned").alias("documents_scanned"),
        F.sum(F.col("took_us").cast("decimal(19,0)")).alias("busy_us"),
        F.max("took_us").alias("max_duration_us"),
    )
    spread = exact_percentiles(
        runs.select("hour_utc", "took_us"),
        ["hour_utc"],
        "took_us",
        {"median_duration_us": MEDIAN, "p95_duration_us": P95},
        few_keys=True,
    )
    busy = F.nullif(F.col("busy_us"), F.lit(0).cast("decimal(29,0)"))
    scanned = F.col("documents_scanned").cast("decimal(19,0)") * F.lit(HOUR_US)
    return totals.join(spread, "hour_utc").select(
        "hour_utc",
        "runs",
        "documents_scanned",
        F.round(scanned / busy, 0).cast("double").alias("documents_per_hour"),
        "median_duration_us",
        "p95_duration_us",
        "max_duration_us",
    )


def scan_throughput(model: AuditModel) -> DataFrame:
    """Scan throughput with durations as intervals."""
    return (
        scan_throughput_micros(model)
        .orderBy("hour_utc")
        .select(
            "hour_utc",
            "runs",
            "documents_scanned",
            "documents_per_hour",
            as_interval(F.col("median_duration_us")).alias("median_duration"),
            as_interval(F.col("p95_duration_us")).alias("p95_duration"),
            as_interval(F.col("max_duration_us")).alias("max_duration"),
        )
    )


def open_findings(
    events: DataFrame,
    keys: list[str],
    us: str,
    days: int,
    opens,
    closes,
) -> DataFrame:
    """Openers whose window of ``days`` has fully elapsed by the newest event and saw no closer
    of the same keys. Adds ``age_us``, the time from the opener to the newest event."""
    width = days * DAY_US
    newest = events.agg(F.max(us).alias("newest")).scalar()
    due = events.filter(opens).filter(F.col(us) <= newest - F.lit(width))
    closers = events.filter(closes).select(*keys, us)
    waiting = never_closed(due, closers, keys, us, width).withColumn("age_us", newest - F.col(us))
    return staged(waiting)  # a sort of it samples it first


def _waiting_flags(model: AuditModel, days: int) -> DataFrame:
    facts = model.violation.select(
        "document_ref_id",
        "policy_id",
        "action_taken",
        "reason",
        "detected_at",
        epoch_micros(model.violation, "detected_at").alias("us"),
    )
    return open_findings(
        facts,
        ["document_ref_id", "policy_id"],
        "us",
        days,
        F.col("action_taken") == model.open_action,
        F.col("action_taken").isin(*model.closing_actions),
    )


def flagged_never_actioned(model: AuditModel, days: int = 2) -> DataFrame:
    """Flags that nobody redacted or escalated within the courtesy window."""
    _bounded("days", days, 1, 90)
    waiting = _waiting_flags(model, days)
    source = model.data_source.select(
        "data_source_id", "department", F.col("name").alias("data_source"), "env"
    )
    document = model.document_ref.select(
        "document_ref_id", "data_source_id", "external_document_id"
    )
    rules = model.policy.select("policy_id", "policy_code", "severity")
    # Many flags may share severity and instant; the last two keys let them be divided.
    labelled = (
        waiting.join(document, "document_ref_id")
        .join(source, "data_source_id")
        .join(rules, "policy_id")
        .withColumn("severity_rank", severity_rank(F.col("severity")))
        .orderBy(
            F.desc_nulls_first("severity_rank"), "detected_at", "document_ref_id", "policy_id"
        )
    )
    return labelled.select(
        "department",
        "data_source",
        "env",
        "policy_code",
        "severity",
        "external_document_id",
        F.col("detected_at").alias("flagged_at"),
        "reason",
        ratio(F.col("age_us"), DAY_US, 1).alias("days_open"),
        "severity_rank",
    )


def daily_counts(model: AuditModel) -> DataFrame:
    facts = model.violation
    return (
        facts.select(day_of(facts, "detected_at").alias("day"))
        .groupBy("day")
        .agg(F.count(F.lit(1)).alias("violations"))
    )


def with_running_load(daily: DataFrame) -> DataFrame:
    """Running total and mean of the last seven rows. The window has no partition key, which is
    sound here only because its input has one row per calendar day."""
    so_far = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last_seven = Window.orderBy("day").rowsBetween(-6, Window.currentRow)
    return daily.select(
        "day",
        "violations",
        F.sum("violations").over(so_far).alias("cumulative_violations"),
        ratio(
            F.sum("violations").over(last_seven), F.count(F.lit(1)).over(last_seven), 1
        ).alias("trailing_7d_avg"),
    )


def cumulative_load(model: AuditModel) -> DataFrame:
    """How the total has grown, day by day."""
    return with_running_load(daily_counts(model)).orderBy("day")


def _known_documents(model: AuditModel) -> DataFrame:
    """(document_ref_id), as often as a report would repeat a row of that document."""
    source = model.data_source.select("data_source_id")
    owned = model.document_ref.select("document_ref_id", "data_source_id")
    return owned.join(source, "data_source_id").select("document_ref_id")


def _repeat_offender_rows(model: AuditModel, limit: int = 40) -> DataFrame:
    counted = model.violation.groupBy("document_ref_id").agg(F.count(F.lit(1)).alias("n"))
    counted = counted.filter(F.col("n") >= 2).join(_known_documents(model), "document_ref_id")
    return counted.limit(limit)


def _throughput_rows(model: AuditModel) -> DataFrame:
    runs = model.scan_run.filter(F.col("finished_at").isNotNull())
    hours = runs.select(utc_hour(epoch_micros(runs, "started_at")).alias("hour_utc"))
    return hours.filter("hour_utc IS NOT NULL").distinct()


def _flagged_rows(model: AuditModel, days: int = 2) -> DataFrame:
    waiting = _waiting_flags(model, days).join(_known_documents(model), "document_ref_id")
    return waiting.join(model.policy.select("policy_id"), "policy_id")


@dataclass(frozen=True)
class Report:
    """A report under its public name. ``parameters`` maps a parameter to (low, high, default).
    ``rows`` gives as many rows as the report has at its defaults, without labels and order."""

    slug: str
    build: Callable[..., DataFrame]
    rows: Callable[[AuditModel], DataFrame]
    parameters: dict[str, tuple[int, int, int]] = field(default_factory=dict)

    def run(self, model: AuditModel, **given) -> DataFrame:
        """Builds the report. A report without parameters ignores what it is given."""
        if not self.parameters:
            return self.build(model)
        unknown = set(given) - set(self.parameters)
        if unknown:
            raise ValueError(f"{self.slug} takes {sorted(self.parameters)}, not {sorted(unknown)}")
        chosen = {
            name: _bounded(name, given.get(name, default), low, high)
            for name, (low, high, default) in self.parameters.items()
        }
        return self.build(model, **chosen)


# Public report names, parameter ranges and defaults.
REPORTS = {
    report.slug: report
    for report in (
        Report(
            "repeat-offenders", repeat_offenders, _repeat_offender_rows, {"limit": (1, 500, 40)}
        ),
        Report("policy-trend", policy_trend, monthly_counts),
        Report("top-policies-per-department", top_policies, top_policies),
        Report("scan-throughput", scan_throughput, _throughput_rows),
        Report(
            "flagged-never-actioned", flagged_never_actioned, _flagged_rows, {"days": (1, 90, 2)}
        ),
        Report("cumulative-load", cumulative_load, daily_counts),
    )
}
