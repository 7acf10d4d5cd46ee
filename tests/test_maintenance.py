"""Retraction, restricted deletes, supersession and double loads."""

import dataclasses
import datetime as dt

import pytest
from audit import at, frame, star
from openloop.operators.validity import policies_by_month, policies_in_force
from openloop.plans import maintenance
from openloop.plans.rollups import daily_rollup, hit_rate, read_rollup, write_rollup
from openloop.plans.reports import cumulative_load
from openloop.session import cluster_settings
from pyspark.sql import functions as F

FINDINGS = [(1, 1, "flagged", at(0)), (2, 2, "redacted", at(1)), (1, 2, "ignored", at(40))]


def test_retracted_run_takes_its_findings(spark):
    model = star(spark, FINDINGS)
    ids = spark.createDataFrame([(2,)], "scan_run_id int")
    findings, runs = maintenance.retract_runs(model.violation, model.scan_run, ids)
    assert sorted(r.scan_run_id for r in findings.collect()) == [1, 3]
    assert sorted(r.scan_run_id for r in runs.collect()) == [1, 3]
    assert findings.columns == model.violation.columns


def test_restricted_delete(spark):
    model = star(spark, FINDINGS)
    used = spark.createDataFrame([(2,), (3,)], "policy_id int")
    with pytest.raises(maintenance.StillReferenced, match=r"2 \(2 rows\)"):
        maintenance.restrict_delete(model.policy, [model.violation], "policy_id", used)
    free = spark.createDataFrame([(3,)], "policy_id int")
    left = maintenance.restrict_delete(model.policy, [model.violation], "policy_id", free)
    assert sorted(r.policy_id for r in left.collect()) == [1, 2, 4]


def successor(spark, code):
    return spark.createDataFrame(
        [(code, "New", "low")], "policy_code string, title string, severity string"
    )


def test_supersede(spark):
    model = star(spark, FINDINGS)
    when = F.lit(at(10))
    after = maintenance.supersede_policy(model.policy, "PII-1", when, successor(spark, "PII-2"))
    rows = {r.policy_code: r for r in after.collect()}
    assert len(rows) == 5
    assert rows["PII-2"].policy_id == 5 and rows["PII-2"].effective_to is None
    assert rows["PII-1"].effective_to == rows["PII-2"].effective_from
    codes = {r.policy_code for r in policies_in_force(after, when).collect()}
    assert codes == {"PII-2", "SEC-1", "RET-1", "ODD-1"}
    for code, new in (("NONE", "X"), ("PII-1", "PII-1"), ("PII-1", "SEC-1")):
        with pytest.raises(ValueError):
            maintenance.supersede_policy(model.policy, code, when, successor(spark, new))
    with pytest.raises(ValueError, match="ended"):
        maintenance.supersede_policy(after, "PII-1", when, successor(spark, "Z"))


def test_supersede_refuses_what_the_schema_forbids(spark):
    model = star(spark, FINDINGS)
    when = F.lit(at(10))
    good = successor(spark, "NEW")
    refused = [
        (F.lit(at(-1000)), good),
        (when, good.union(good)),
        (when, good.limit(0)),
        (when, good.withColumn("severity", F.lit("nonsense"))),
        (when, good.withColumn("title", F.lit(None).cast("string"))),
    ]
    for moment, new in refused:
        with pytest.raises(maintenance.InvalidPolicy):
            maintenance.supersede_policy(model.policy, "PII-1", moment, new)
    twice = model.policy.union(model.policy.filter("policy_code = 'PII-1'"))
    with pytest.raises(maintenance.InvalidPolicy, match="2 policies"):
        maintenance.supersede_policy(twice, "PII-1", when, good)


def test_adding_leaves_other_findings_where_they_are(spark):
    model = star(spark, FINDINGS)
    batch = frame(spark, "violation", [(12, 9, 1, 1, "ignored", "new", at(5))])
    for mode in ("fail", "keep_first"):
        added = maintenance.add_findings(model.violation, batch, mode)
        untouched = added._jdf.queryExecution().executedPlan().toString().partition("Union")[2]
        assert added.count() == 4
        if mode == "fail":
            assert "Exchange" not in untouched
        else:
            assert "BroadcastHashJoin" in untouched and "LeftAnti" in untouched


def test_double_load(spark):
    model = star(spark, FINDINGS)
    batch = frame(
        spark,
        "violation",
        [(11, 1, 1, 1, "ignored", "again", at(0)), (12, 9, 1, 1, "ignored", "new", at(5))],
    )
    with pytest.raises(maintenance.DuplicateFinding, match=r"\(1, 1, 1\)"):
        maintenance.add_findings(model.violation, batch)
    kept = maintenance.add_findings(model.violation, batch, "keep_first").collect()
    assert sorted(r.violation_id for r in kept) == [1, 2, 3, 12]
    fresh = maintenance.add_findings(model.violation, batch.filter("violation_id = 12"))
    assert fresh.count() == 4
    with pytest.raises(ValueError):
        maintenance.add_findings(model.violation, batch, "replace")


def test_policies_by_month(spark):
    policy = frame(
        spark,
        "policy",
        [
            (1, "A", "t", "low", at(0), at(31)),
            (2, "B", "t", "low", at(0, us=1), None),
        ],
    )
    first, last = F.lit("2025-02-01").cast("date"), F.lit("2025-05-01").cast("date")
    with_utc = policies_by_month(policy, first, last)
    found = sorted((r.policy_code, r.month.isoformat()) for r in with_utc.collect())
    assert found == [("A", "2025-03-01"), ("B", "2025-04-01"), ("B", "2025-05-01")]


def test_hit_rate_counts_clean_runs(spark):
    runs = [
        (1, at(0), at(1), "1.0", 10),
        (2, at(1), at(2), "1.0", 30),
        (3, at(2), None, "2.0", 0),
    ]
    model = star(spark, FINDINGS[:1], runs=runs)
    found = {r.agent_version: r for r in hit_rate(model).collect()}
    assert (found["1.0"].findings, found["1.0"].documents_scanned) == (1, 40)
    assert found["1.0"].findings_per_100 == 2.5
    assert found["2.0"].findings_per_100 is None
    assert hit_rate(model, "hour_utc").count() == 1


def test_rollup_reads_its_months_only(spark, tmp_path):
    model = star(spark, FINDINGS)
    write_rollup(model, str(tmp_path / "daily"))
    first, last = dt.date(2025, 3, 2), dt.date(2025, 3, 31)
    read = read_rollup(spark, str(tmp_path / "daily"), first, last)
    assert [(r.policy_id, r.violations) for r in read.collect()] == [(2, 1)]
    assert "PartitionFilters: [isnotnull(month" in read._jdf.queryExecution().toString()
    assert daily_rollup(model).count() == 3


def test_date_range_reaches_the_scan(spark, tmp_path):
    model = star(spark, [*FINDINGS, (1, 1, "ignored", at(2, us=-1)), (1, 1, "ignored", at(2))])
    model.violation.write.parquet(str(tmp_path / "violation"))
    stored = dataclasses.replace(
        model, violation=spark.read.parquet(str(tmp_path / "violation"))
    ).between(dt.date(2025, 3, 2), dt.date(2025, 3, 2))
    assert sorted(r.violation_id for r in stored.violation.collect()) == [2, 4]
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = stored.violation.select("detected_at")._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(detected_at" in plan and "LessThan(detected_at" in plan
    assert cumulative_load(stored).first().violations == 2


def test_settings_grow_with_the_input():
    small = cluster_settings(10**9, 8)
    assert small["spark.sql.shuffle.partitions"] == "8"
    large = cluster_settings(100 * 10**12, 8000)
    assert large["spark.sql.shuffle.partitions"] == "48000"
    assert large["spark.sql.files.maxPartitionBytes"] == str(1 << 30)
