"""Hand-computed results of the six reports on the declared schema."""

import datetime as dt

import pytest
from audit import at, star
from openloop.plans import reports
from openloop.plans.reports import REPORTS


def rows(df):
    return [r.asDict() for r in df.collect()]


def run(slug, model, **given):
    return rows(REPORTS[slug].run(model, **given))


def test_repeat_offenders(spark):
    model = star(
        spark,
        [
            (1, 1, "ignored", at(0)),
            (1, 1, "ignored", at(0, 2)),
            (1, 2, "ignored", at(0, 8)),
            (2, 1, "ignored", at(1)),
            (2, 1, "ignored", at(1, 10)),
            (3, 1, "ignored", at(2)),
        ],
    )
    found = run("repeat-offenders", model)
    assert [(r["external_document_id"], r["violation_count"]) for r in found] == [
        ("a:000001", 3),
        ("a:000002", 2),
    ]
    assert (found[0]["median_gap_hours"], found[0]["p90_gap_hours"]) == (4.0, 5.6)
    assert (found[1]["median_gap_hours"], found[1]["p90_gap_hours"]) == (10.0, 10.0)
    assert found[0]["first_violation"] == dt.date(2025, 3, 1)
    assert found[0]["department"] == "Support" and found[0]["data_source"] == "logs-a"


def test_repeat_offenders_same_instant_and_order(spark):
    model = star(
        spark,
        [(2, 1, "ignored", at(0)), (2, 2, "ignored", at(0))]
        + [(1, 1, "ignored", at(0)), (1, 2, "ignored", at(0))]
        + [(3, 1, "ignored", at(0)), (3, 2, "ignored", at(0, 1))],
    )
    found = run("repeat-offenders", model)
    assert [r["external_document_id"] for r in found] == ["a:000001", "a:000002", "b:000001"]
    assert [r["median_gap_hours"] for r in found] == [0.0, 0.0, 1.0]
    assert len(run("repeat-offenders", model, limit=2)) == 2


def test_repeat_offenders_skips_documents_without_a_row(spark):
    findings = [(9, 1, "ignored", at(h / 24)) for h in range(5)]
    findings += [(1, 1, "ignored", at(0)), (1, 2, "ignored", at(1))]
    found = run("repeat-offenders", star(spark, findings), limit=1)
    assert [r["external_document_id"] for r in found] == ["a:000001"]


def test_policy_trend_compares_with_the_last_active_month(spark):
    findings = [(1, 1, "ignored", at(-59 + i)) for i in range(4)]
    findings += [(1, 1, "ignored", at(i)) for i in range(3)]
    findings += [(1, 1, "ignored", dt.datetime(2025, 1, 31, 23, 59, 59, 999000, dt.timezone.utc))]
    found = run("policy-trend", star(spark, findings))
    assert [(r["month"], r["violations"], r["mom_delta"], r["mom_pct"]) for r in found] == [
        (dt.date(2025, 1, 1), 5, None, None),
        (dt.date(2025, 3, 1), 3, -2, -40.0),
    ]


def test_top_policies_ties(spark):
    findings = []
    for policy, times in ((1, 2), (2, 2), (3, 2), (4, 2)):
        findings += [(1, policy, "ignored", at(i)) for i in range(times)]
    found = run("top-policies-per-department", star(spark, findings))
    # An unknown severity sorts first under DESC, then the ladder decides.
    assert [(r["rnk"], r["policy_code"]) for r in found] == [
        (1, "ODD-1"),
        (2, "SEC-1"),
        (3, "PII-1"),
    ]
    assert {r["pct_of_department"] for r in found} == {25.0}


def test_top_policies_keeps_true_ties(spark):
    twins = [(i, "SAME", f"T{i}", "low", at(-9), None) for i in (1, 2, 3, 4)]
    findings = [(1, p, "ignored", at(p)) for p in (1, 2, 3, 4)]
    found = run("top-policies-per-department", star(spark, findings, policies=twins))
    assert [r["rnk"] for r in found] == [1, 1, 1, 1]


def test_scan_throughput(spark):
    runs = [
        (1, at(0), at(0) + dt.timedelta(seconds=10), "1", 10),
        (2, at(1), at(1) + dt.timedelta(seconds=20), "1", 20),
        (3, at(2), None, "1", 500),
        (4, at(0, 5), at(0, 5), "1", 7),
    ]
    found = run("scan-throughput", star(spark, [(1, 1, "ignored", at(0))], runs=runs))
    assert [(r["hour_utc"], r["runs"], r["documents_scanned"]) for r in found] == [
        (0, 2, 30),
        (5, 1, 7),
    ]
    assert found[0]["documents_per_hour"] == 3600.0
    assert found[0]["median_duration"] == dt.timedelta(seconds=15)
    assert found[0]["p95_duration"] == dt.timedelta(seconds=19.5)
    assert found[0]["max_duration"] == dt.timedelta(seconds=20)
    assert found[1]["documents_per_hour"] is None


NEWEST = (3, 3, "ignored", at(30))


@pytest.mark.parametrize(
    ("action", "policy", "when", "reported"),
    [
        ("redacted", 1, at(0), False),
        ("redacted", 1, at(2), False),
        ("redacted", 1, at(2, us=1), True),
        ("redacted", 1, at(0, us=-1), True),
        ("escalated", 1, at(1), False),
        ("ignored", 1, at(1), True),
        ("flagged", 1, at(29), True),
        ("redacted", 2, at(1), True),
    ],
)
def test_what_closes_a_flag(spark, action, policy, when, reported):
    model = star(spark, [(1, 1, "flagged", at(0)), (1, policy, action, when), NEWEST])
    assert len(run("flagged-never-actioned", model)) == int(reported)


def test_flag_rows_and_horizon(spark):
    model = star(
        spark,
        [
            (1, 1, "flagged", at(28)),
            (1, 2, "flagged", at(28, us=1)),
            (2, 4, "flagged", at(3)),
            (2, 3, "flagged", at(1)),
            (2, 3, "flagged", at(9, 12)),
            NEWEST,
        ],
    )
    found = run("flagged-never-actioned", model)
    assert [(r["policy_code"], r["severity_rank"], r["days_open"]) for r in found] == [
        ("ODD-1", None, 27.0),
        ("PII-1", 3, 2.0),
        ("RET-1", 2, 29.0),
        ("RET-1", 2, 20.5),
    ]
    assert found[1]["reason"] == "r1" and found[1]["env"] == "prod"
    # 27 + 29 + 20.5 days old; with 21 days only the two oldest have run out.
    assert len(run("flagged-never-actioned", model, days=21)) == 2


def test_cumulative_load(spark):
    findings = [(1, 1, "ignored", at(d)) for d in (0, 0, 1, 3, 4, 5, 6, 7, 8)]
    found = run("cumulative-load", star(spark, findings))
    assert [r["cumulative_violations"] for r in found] == [2, 3, 4, 5, 6, 7, 8, 9]
    # The seventh row looks back over a missing day; the eighth leaves the first day out.
    assert [r["trailing_7d_avg"] for r in found] == [2.0, 1.5, 1.3, 1.3, 1.2, 1.2, 1.1, 1.0]


def test_report_parameters(spark):
    model = star(spark, [(1, 1, "ignored", at(0))])
    for slug, given in (
        ("repeat-offenders", {"limit": 0}),
        ("repeat-offenders", {"limit": 501}),
        ("repeat-offenders", {"limit": "5"}),
        ("flagged-never-actioned", {"days": 91}),
        ("flagged-never-actioned", {"limit": 5}),
    ):
        with pytest.raises(ValueError):
            REPORTS[slug].run(model, **given)
    assert len(run("policy-trend", model, anything=1)) == 1


def test_empty_facts(spark):
    model = star(spark, [(1, 1, "ignored", at(0))])
    empty = reports.AuditModel(
        policy=model.policy,
        data_source=model.data_source,
        document_ref=model.document_ref,
        scan_run=model.scan_run.filter("false"),
        violation=model.violation.filter("false"),
    )
    for report in REPORTS.values():
        assert report.run(empty).count() == 0


@pytest.mark.parametrize("partitions", [1, 5, 40])
def test_partitioning_does_not_matter(spark, partitions):
    findings = [
        (1 + i % 3, 1 + i % 4, ("flagged", "redacted", "ignored")[i % 3], at(i * 0.4))
        for i in range(120)
    ]
    model = star(spark, findings)
    spread = reports.AuditModel(
        policy=model.policy,
        data_source=model.data_source,
        document_ref=model.document_ref.repartition(partitions),
        scan_run=model.scan_run.repartition(partitions),
        violation=model.violation.orderBy("reason").repartition(partitions),
    )
    for report in REPORTS.values():
        key = str
        assert sorted(map(key, rows(report.run(spread)))) == sorted(map(key, rows(report.run(model))))

