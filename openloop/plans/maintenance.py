"""Audit-safe changes. Each returns new DataFrames; the caller publishes them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from openloop.functions.durable import staged
from openloop.functions.sizing import hinted, keep_matching
from openloop.schemas import SEVERITIES, SURROGATE, UNIQUE

GRAIN = list(UNIQUE["violation"][0])


def retract_runs(
    violation: DataFrame, scan_run: DataFrame, ids: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Findings and runs left after the runs in ``ids`` (column ``scan_run_id``) are retracted.
    A retracted run takes its findings with it. The ids are stored once for both."""
    gone = hinted(staged(ids.select("scan_run_id").distinct()))
    return (
        violation.join(gone, "scan_run_id", "left_anti").select(*violation.columns),
        scan_run.join(gone, "scan_run_id", "left_anti").select(*scan_run.columns),
    )


def findings_of_runs(violation: DataFrame, ids: DataFrame) -> DataFrame:
    """The findings that a retraction of the runs in ``ids`` takes away."""
    return keep_matching(violation, ids.select("scan_run_id"))


def still_referenced(ids: DataFrame, child: DataFrame, key: str) -> DataFrame:
    """The keys in ``ids`` that ``child`` refers to, with the number of referring rows."""
    uses = keep_matching(child.select(key), ids.select(key))
    return uses.groupBy(key).agg(F.count(F.lit(1)).alias("uses"))


class StillReferenced(ValueError):
    """A row cannot be deleted while other rows refer to it."""


def restrict_delete(parent: DataFrame, children: list[DataFrame], key: str, ids: DataFrame):
    """``parent`` without the rows in ``ids``; refuses while a child refers to one of them."""
    for child in children:
        in_use = still_referenced(ids, child, key)
        named = in_use.orderBy(key).limit(20).collect()
        if named:
            listed = ", ".join(f"{row[key]} ({row.uses} rows)" for row in named)
            raise StillReferenced(f"{key} still referenced, first 20: {listed}")
    return keep_matching(parent, ids.select(key), "left_anti")


class InvalidPolicy(ValueError):
    """A policy cannot be superseded as asked."""


def supersede_policy(policy: DataFrame, code: str, at: Column, successor: DataFrame) -> DataFrame:
    """Closes the window of ``code`` at ``at`` and adds the one-row ``successor`` (policy_code,
    title, severity) under a code of its own, in force from then on.

    Refused unless there is exactly one policy ``code``, it has no end yet and began before
    ``at``, and the successor is one valid row with a code that no policy has.
    """
    new = successor.select("policy_code", "title", "severity").limit(2).collect()
    if len(new) != 1:
        raise InvalidPolicy("the successor is one row")
    if new[0].title is None or new[0].severity not in SEVERITIES:
        raise InvalidPolicy(f"the successor needs a title and a severity of {', '.join(SEVERITIES)}")
    named, taken = F.col("policy_code") == code, F.col("policy_code") == new[0].policy_code
    key = SURROGATE["policy"]
    found = policy.agg(
        F.count_if(named).alias("named"),
        F.count_if(named & F.col("effective_to").isNotNull()).alias("ended"),
        F.count_if(named & (F.col("effective_from") < at)).alias("begun"),
        F.count_if(taken).alias("taken"),
        F.max(key).alias("highest"),
    ).first()
    if found.named != 1:
        raise InvalidPolicy(f"{found.named} policies {code}, not one")
    if found.ended:
        raise InvalidPolicy(f"policy {code} has ended already")
    if not found.begun:
        raise InvalidPolicy(f"policy {code} would end before it begins")
    if found.taken or new[0].policy_code is None:
        raise InvalidPolicy("the successor needs a policy_code of its own")
    closed = policy.withColumn(
        "effective_to",
        F.when(named, at).otherwise(F.col("effective_to")),
    )
    added = successor.select(
        F.lit(found.highest + 1).cast(policy.schema[key].dataType).alias(key),
        "policy_code",
        "title",
        "severity",
        at.alias("effective_from"),
        F.lit(None).cast(policy.schema["effective_to"].dataType).alias("effective_to"),
    )
    return closed.unionByName(added)


class DuplicateFinding(ValueError):
    """A batch repeats a (run, document, policy) triple."""


def first_per_grain(findings: DataFrame, grain: list[str], order: list[str]) -> DataFrame:
    """One row per grain, the first by ``order``. Rows are sorted within each task and folded
    before they move (a row is no hash buffer), so a triple repeated very often is one row per
    task in the shuffle. ``order`` must tell the rows of a triple apart."""
    rest = [c for c in findings.columns if c not in grain]
    row = F.struct(*[F.col(c) for c in rest])
    least = F.min_by(row, F.struct(*[F.col(c) for c in order]))
    return findings.groupBy(*grain).agg(least.alias("r")).select(
        *[F.col(c) if c in grain else F.col(f"r.{c}").alias(c) for c in findings.columns]
    )


def repeated_findings(existing: DataFrame, batch: DataFrame, grain: list[str] = GRAIN) -> DataFrame:
    """The grain values of ``batch`` that it holds more than once or that ``existing`` has, with
    the number of rows in both. ``existing`` is only looked through for values of the batch."""
    mine = batch.select(*grain)
    known = keep_matching(existing.select(*grain), mine).select(*grain, F.lit(1).alias("n"))
    both = mine.select(*grain, F.lit(1).alias("n")).unionByName(known)
    return both.groupBy(*grain).agg(F.sum("n").alias("n")).filter(F.col("n") > 1)


def add_findings(
    existing: DataFrame,
    batch: DataFrame,
    on_repeat: str = "fail",
    grain: list[str] = GRAIN,
    order: str = "violation_id",
) -> DataFrame:
    """``existing`` with ``batch`` added under the grain rule. A repeated triple is an error;
    with ``keep_first`` the finding with the lowest ``violation_id`` stays. Only rows with a
    triple of the batch are compared; the others of ``existing`` stay where they are."""
    if on_repeat == "keep_first":
        mine = batch.select(*grain)
        touched = keep_matching(existing, mine).unionByName(batch)
        untouched = keep_matching(existing, mine, "left_anti")
        return untouched.unionByName(first_per_grain(touched, grain, [order]))
    if on_repeat != "fail":
        raise ValueError("on_repeat is 'fail' or 'keep_first'")
    named = repeated_findings(existing, batch, grain).orderBy(*grain).limit(20).collect()
    if named:
        listed = ", ".join(str(tuple(row[c] for c in grain)) for row in named)
        raise DuplicateFinding(f"repeated (run, document, policy), first 20: {listed}")
    return existing.unionByName(batch)
