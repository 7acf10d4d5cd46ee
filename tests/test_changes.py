"""Rollups that follow changes, windows as dyadic cells, the first run after a flag, and gate counts."""

import datetime as dt
import os
import random
from bisect import bisect_right
from dataclasses import replace

import pytest
from audit import DOCUMENTS, POLICIES, SOURCES, at, star
from openloop.functions.clock import epoch_micros
from openloop.operators import validity
from openloop.plans import maintenance, rollups
from openloop.plans.reports import REPORTS
from pyspark.sql import functions as F

ACTIONS = ("flagged", "redacted", "ignored", "escalated")


def findings(n=120, days=200):
    rng = random.Random(n)
    return [
        (rng.randrange(1, 4), rng.randrange(1, 5), rng.choice(ACTIONS), at(rng.randrange(days), rng.randrange(24)))
        for _ in range(n)
    ]


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def rows(df):
    return sorted(tuple(r) for r in df.select(rollups.ROLLUP).collect())


def test_rollup_follows_added_and_retracted_findings(spark, tmp_path):
    model, place = star(spark, findings()), str(tmp_path / "rollup")
    facts = model.violation
    early = F.col("violation_id") <= 80
    rollups.write_rollup(replace(model, violation=facts.filter(early)), place)
    before = files(place)
    added = facts.filter(~early & (F.col("detected_at") < F.lit(at(40))))
    months = rollups.change_rollup(spark, place, 1, added=added)
    now = facts.filter(early).unionByName(added)
    assert months == sorted({dt.date(r.detected_at.year, r.detected_at.month, 1) for r in added.collect()})
    assert rows(rollups.read_rollup(spark, place)) == rows(rollups.daily_rollup(replace(model, violation=now)))
    # The files of months that no change names are the same files as before.
    untouched = {f for f in before if not any(f"month={m}" in f for m in months)}
    assert untouched and untouched <= files(place)
    assert not (before - untouched) & files(place)

    ids = model.scan_run.filter(F.col("scan_run_id") % 3 == 0)
    gone = maintenance.findings_of_runs(now, ids)
    rollups.change_rollup(spark, place, 2, retracted=gone)
    left, _ = maintenance.retract_runs(now, model.scan_run, ids)
    expected = rows(rollups.daily_rollup(replace(model, violation=left)))
    assert rows(rollups.read_rollup(spark, place)) == expected
    # A change that is run again changes nothing.
    assert rollups.change_rollup(spark, place, 2, retracted=gone) == []
    assert rows(rollups.read_rollup(spark, place)) == expected
    with pytest.raises(rollups.ImpossibleRetraction, match="below zero"):
        rollups.change_rollup(spark, place, 3, retracted=gone)
    assert rows(rollups.read_rollup(spark, place)) == expected


def test_an_emptied_month_remembers_its_change(spark, tmp_path):
    model, place = star(spark, [(1, 1, "flagged", at(0)), (1, 2, "ignored", at(1)), (2, 1, "ignored", at(70))]), str(tmp_path / "r")
    rollups.write_rollup(model, place)
    march = model.violation.filter(F.col("detected_at") < F.lit(at(30)))
    assert rollups.change_rollup(spark, place, 1, retracted=march) == [dt.date(2025, 3, 1)]
    assert rollups.change_rollup(spark, place, 1, retracted=march) == []
    assert [r.violations for r in rollups.read_rollup(spark, place).collect()] == [1]
    assert rollups.change_rollup(spark, place, 2, added=march) == [dt.date(2025, 3, 1)]
    assert rows(rollups.read_rollup(spark, place)) == rows(rollups.daily_rollup(model))
    assert rollups.read_rollup(spark, place, last=dt.date(2025, 3, 1)).count() == 1
    assert rollups.change_rollup(spark, place, 3) == []


def test_a_change_cut_short_is_finished(spark, tmp_path):
    model, place = star(spark, findings(60, 90)), str(tmp_path / "r")
    facts = model.violation
    early, late = facts.filter("violation_id <= 30"), facts.filter("violation_id > 30")
    rollups.write_rollup(replace(model, violation=early), place)
    # As if only the findings of March had been taken in before the writer was lost.
    march = F.col("detected_at") < F.lit(at(31))
    rollups.change_rollup(spark, place, 1, added=late.filter(march))
    months = rollups.change_rollup(spark, place, 1, added=late)
    assert dt.date(2025, 3, 1) not in months and months
    assert rows(rollups.read_rollup(spark, place)) == rows(rollups.daily_rollup(model))


# Windows -------------------------------------------------------------------------------------


def test_cells_cover_a_window_exactly(spark):
    rng = random.Random(5)
    bounds = [(3, 3), (5, 4), (0, 1), (-7, 9), (7, None), (None, 4)] + [
        tuple(sorted((rng.randrange(-200, 200), rng.randrange(-200, 200)))) for _ in range(40)
    ]
    windows = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(bounds)], "id int, a long, b long")
    cells = validity.window_cells(windows, F.col("a"), F.col("b"))
    covered = {}
    for r in cells.collect():
        low = (r.dyadic_cell << r.dyadic_level) - (1 << 58)
        covered.setdefault(r.id, []).append((low, low + (1 << r.dyadic_level)))
    for k, (a, b) in enumerate(bounds):
        spans = sorted(covered.get(k, []))
        end = (1 << 58) if b is None else b
        if a is None or a >= end:
            assert spans == []
        else:
            assert spans[0][0] == a and spans[-1][1] == end
            assert all(x[1] == y[0] for x, y in zip(spans, spans[1:]))
            assert len(spans) <= 2 * (end - a).bit_length()


def test_policies_at_instants(spark):
    rng = random.Random(9)
    policies = [
        (k, f"P{k}", "t", "low", at(rng.randrange(100)), rng.choice([None, at(rng.randrange(100)), at(50)]))
        for k in range(30)
    ] + [(99, "P99", "t", "low", None, None)]
    policy = star(spark, [], policies=[(*p[:4], p[4] or at(0), p[5]) for p in policies]).policy
    policy = policy.withColumn("effective_from", F.when(F.col("policy_id") != 99, F.col("effective_from")))
    moments = [(k, k % 3, at(rng.randrange(110), 0, rng.choice([0, 1]))) for k in range(50)] + [(50, 1, None), (51, 1, at(50)), (52, 2, at(50))]
    instants = spark.createDataFrame(moments, "id int, level int, when timestamp")
    instants = instants.withColumn("us", epoch_micros(instants, "when"))
    found = validity.policies_at(instants, "us", policy)
    assert found.columns == [*instants.columns, *policy.columns]
    holds = {
        (i, p[0]) for i, _, t in moments for p in policies
        if t is not None and p[4] is not None and p[4] <= t and (p[5] is None or t < p[5])
    }
    assert sorted((r.id, r.policy_id) for r in found.collect()) == sorted(holds)
    counted = {r.id: r.in_force for r in validity.number_in_force(instants, "us", policy).collect()}
    assert counted == {i: sum(1 for a, _ in holds if a == i) for i, _, _ in moments}
    mine = instants.withColumn("policy_id", F.col("id") % 30)
    own = validity.policies_at(mine, "us", policy, {"policy_id": "policy_id"})
    assert own.columns.count("policy_id") == 1
    assert sorted((r.id, r.policy_id) for r in own.collect()) == sorted(p for p in holds if p[1] == p[0] % 30)


def test_own_policies_are_met_by_key(spark):
    """Instants are not listed by cell where a key has few versions; keys with many are."""
    rng = random.Random(21)
    versions = [(k % 3, k, at(rng.randrange(100)), rng.choice([None, at(rng.randrange(100)), at(50)])) for k in range(9)]
    versions += [(5, 100 + k, at(rng.randrange(100)), rng.choice([None, at(rng.randrange(100))])) for k in range(2 * validity.FEW_VERSIONS)]
    versions += [(None, 7, at(0), None), (1, 8, None, None), (0, 9, at(3), at(3)), (0, 10, at(2), None), (0, 10, at(2), None)]
    schema = "policy_id int, version int, effective_from timestamp, effective_to timestamp"
    moments = [(k, rng.choice([0, 1, 2, 3, 5, None]), at(rng.randrange(110), 0, rng.choice([0, 1])), 0) for k in range(200)]
    moments += [(200, 5, None, 0), (201, 0, at(3), 0), (201, 0, at(3), 0)]
    instants = spark.createDataFrame(moments, "id int, own int, when timestamp, version int")
    instants = instants.withColumn("us", epoch_micros(instants, "when"))
    for listed, plain in ((versions, False), ([v for v in versions if v[0] != 5], True)):
        policy = spark.createDataFrame(listed, schema).withColumnRenamed("version", "number")
        found = validity.policies_at(instants, "us", policy, {"own": "policy_id"})
        assert ("Generate" not in found._jdf.queryExecution().optimizedPlan().toString()) == plain
        assert found.columns == [*instants.columns, "number", "effective_from", "effective_to"]
        expected = sorted(
            (i, n) for i, own, t, _ in moments for key, n, a, b in listed
            if own is not None and own == key and t is not None and a is not None and a <= t and (b is None or t < b)
        )
        assert sorted((r.id, r.number) for r in found.collect()) == expected and len(expected) > 100


# Runs ----------------------------------------------------------------------------------------


def test_first_run_after_a_flag(spark):
    rng = random.Random(3)
    starts = [rng.choice([at(rng.randrange(20)), at(3, 4, rng.randrange(5)), at(rng.randrange(20), 0, rng.randrange(90_000_000))]) for _ in range(60)]
    runs = [(k, t, None, "1", 1) for k, t in enumerate(starts)]
    moments = [at(-1), at(99), None, *starts[:20]] + [at(rng.randrange(20), rng.randrange(24)) for _ in range(60)] + [at(3, 4, 2)] * 40
    model = star(spark, [], runs=runs)
    flags = spark.createDataFrame(list(enumerate(moments)), "id int, at timestamp")
    flags = flags.withColumn("us", epoch_micros(flags, "at"))
    found = {r.id: (r.scan_run_id, r.wait_us) for r in validity.first_run_after(flags, "us", model.scan_run).collect()}
    ordered = sorted((t, k) for k, t in enumerate(starts))
    assert len(found) == len(moments)
    for k, t in enumerate(moments):
        place = len(ordered) if t is None else bisect_right(ordered, (t, 10**9))
        if place == len(ordered):
            assert found[k] == (None, None)
        else:
            after, run = ordered[place]
            assert found[k] == (run, (after - t) // dt.timedelta(microseconds=1))
    assert validity.first_run_after(flags, "us", model.scan_run.filter("false")).filter("run_us IS NULL").count() == len(moments)


# Gate counts ---------------------------------------------------------------------------------


def test_counts_of_the_gate_are_those_of_the_reports(spark):
    events = findings(80, 30)
    runs = [
        (k, None if k % 7 == 0 else t, None if k % 5 == 0 else t + dt.timedelta(minutes=k), "1", 4)
        for k, (_, _, _, t) in enumerate(events, 1)
    ]
    usual = star(spark, events, runs=[r if r[1] else (r[0], at(0), *r[2:]) for r in runs])
    nulls = replace(usual, scan_run=usual.scan_run.withColumn(
        "started_at", F.when(F.col("scan_run_id") % 7 != 0, F.col("started_at"))))
    repeated = star(
        spark, events, policies=[*POLICIES, POLICIES[0], POLICIES[0]], sources=[*SOURCES, SOURCES[1]],
        documents=[*DOCUMENTS, DOCUMENTS[0], DOCUMENTS[2]],
    )
    unknown = star(spark, events, policies=POLICIES[:2], sources=SOURCES[:1], documents=DOCUMENTS[:2])
    for model in (usual, nulls, repeated, unknown):
        for report in REPORTS.values():
            assert report.rows(model).count() == report.run(model).count(), report.slug
