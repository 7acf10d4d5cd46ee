"""Each check passes on clean rows and shows the exact difference after one bad row."""

import dataclasses

import pytest
from audit import DOCUMENTS, POLICIES, SOURCES, at, frame, star
from openloop.functions import sizing
from openloop.plans import quality

FINDINGS = [
    (1, 1, "redacted", at(0)),
    (1, 2, "flagged", at(1)),
    (2, 1, "ignored", at(2)),
    (3, 3, "escalated", at(3)),
]
COUNTS = {"policy": 4, "data_source": 2, "document_ref": 3, "scan_run": 4, "violation": 4}
ACTIONS = {"redacted": 1, "flagged": 1, "ignored": 1, "escalated": 1}
SIZES = {
    "repeat-offenders": 1,
    "policy-trend": 3,
    "top-policies-per-department": 3,
    "scan-throughput": 1,
    "flagged-never-actioned": 1,
    "cumulative-load": 4,
}


def failures(df):
    return {r["name"]: (r["expected"], r["actual"]) for r in df.collect() if not r["ok"]}


@pytest.fixture
def clean(spark):
    return star(spark, FINDINGS, policies=[*POLICIES[:3], (4, "LOW-1", "Low", "low", at(-100), None)])


def changed(spark, model, **rows):
    return dataclasses.replace(
        model, **{name: frame(spark, name, data) for name, data in rows.items()}
    )


def violations(*extra):
    base = [
        (i, i, doc, pol, action, f"r{i}", when)
        for i, (doc, pol, action, when) in enumerate(FINDINGS, 1)
    ]
    return base + list(extra)


def test_gate_has_26_checks_and_passes(clean):
    gate = quality.quality_gate(clean, COUNTS, ACTIONS, SIZES)
    assert quality.require_pass(gate) == 26
    per_category = {}
    for row in gate.collect():
        per_category[row.category] = per_category.get(row.category, 0) + 1
    assert per_category == {
        "Counts": 5,
        "Distribution": 4,
        "Integrity": 4,
        "Constraints": 3,
        "Grain": 1,
        "Invariants": 3,
        "Regression": 6,
    }


def test_gate_names_each_mismatch(clean):
    gate = quality.quality_gate(clean, {**COUNTS, "violation": 5}, ACTIONS, SIZES)
    with pytest.raises(quality.QualityFailure, match="Counts: violation: expected 5, got 4"):
        quality.require_pass(gate)


def test_missing_action_counts_as_zero(spark, clean):
    fewer = changed(spark, clean, violation=violations()[:3])
    found = failures(quality.table_checks(fewer, {**COUNTS, "violation": 3}, ACTIONS))
    assert found == {"action=escalated": (1, 0)}


BAD_ROW = {
    "violation->scan_run orphans": (9, 77, 1, 1, "redacted", "x", at(1)),
    "violation->document_ref orphans": (9, 1, 77, 1, "redacted", "x", at(1)),
    "violation->policy orphans": (9, 1, 1, 77, "redacted", "x", at(1)),
}


@pytest.mark.parametrize("name", sorted(BAD_ROW))
def test_orphans(spark, clean, name):
    assert failures(quality.integrity_checks(clean)) == {}
    bad = changed(spark, clean, violation=violations(BAD_ROW[name], BAD_ROW[name]))
    assert failures(quality.integrity_checks(bad)) == {name: (0, 2)}


def test_document_without_source(spark, clean):
    bad = changed(spark, clean, document_ref=[*DOCUMENTS, (4, 77, "c", at(0))])
    assert failures(quality.integrity_checks(bad)) == {"document_ref->data_source orphans": (0, 1)}


def test_closed_sets(spark, clean):
    bad = changed(
        spark,
        clean,
        policy=[*POLICIES[:3], (4, "ODD-1", "Odd", "unknown", at(-100), None)],
        data_source=[*SOURCES, (3, "logs-c", "HR", "test")],
        violation=violations((9, 1, 1, 3, "deleted", "x", at(0))),
    )
    found = failures(quality.table_checks(bad, {}, {}))
    names = {n: v for n, v in found.items() if "out of set" in n}
    assert names == {
        "policy.severity out of set": (0, 1),
        "data_source.env out of set": (0, 1),
        "violation.action_taken out of set": (0, 1),
    }


def test_grain(spark, clean):
    assert failures(quality.grain_check(clean)) == {}
    again = (9, 1, 1, 1, "redacted", "x", at(0))
    bad = changed(spark, clean, violation=violations(again, again))
    assert failures(quality.grain_check(bad)) == {"duplicate (run,doc,policy) triples": (0, 1)}


@pytest.mark.parametrize("most", [0, 1_000_000])
def test_invariants(spark, clean, monkeypatch, most):
    monkeypatch.setattr(sizing, "MOST_BROADCAST_ROWS", most)
    assert failures(quality.invariant_checks(clean)) == {}
    early = changed(spark, clean, document_ref=[(1, 1, "a:000001", at(0, 1)), *DOCUMENTS[1:]])
    assert failures(quality.invariant_checks(early)) == {
        "violation before doc first_seen_at": (0, 1)
    }
    late = changed(spark, clean, violation=violations((9, 1, 2, 1, "ignored", "x", at(0, 1))))
    assert failures(quality.invariant_checks(late)) == {"violation outside its run window": (0, 1)}
    full = [(i, at(i - 1), at(i - 1, 1), "1.0", 0 if i == 3 else 5) for i in range(1, 5)]
    assert failures(quality.invariant_checks(changed(spark, clean, scan_run=full))) == {
        "run distinct docs > documents_scanned": (0, 1)
    }


def test_open_run_bounds_from_below_only(spark, clean):
    runs = [(i, at(i - 1), None, "1.0", 5) for i in range(1, 5)]
    open_runs = changed(spark, clean, scan_run=runs)
    after = changed(
        spark, open_runs, violation=violations((9, 1, 2, 1, "ignored", "x", at(400)))
    )
    before = changed(
        spark, open_runs, violation=violations((9, 1, 2, 1, "ignored", "x", at(0, us=-1)))
    )
    assert quality.outside_run(after).count() == 0
    assert quality.outside_run(before).count() == 1


def test_policy_window_is_half_open(spark, clean):
    windows = [(1, "PII-1", "Names", "high", at(0), at(2)), *POLICIES[1:]]
    bound = changed(spark, clean, policy=windows)
    found = quality.outside_policy_window(bound).collect()
    assert [r.violation_id for r in found] == [3]


def test_readiness(clean):
    assert quality.readiness(clean, COUNTS).first().status == "ready"
    row = quality.readiness(clean, {**COUNTS, "policy": 5}).first()
    assert (row.status, row.policy) == ("degraded", 4)


def test_rules_split_valid_rows(spark):
    good = (1, at(0), at(0), "1.0", 0)
    rows = [
        good,
        (2, at(1), at(0), "1.0", 5),
        (3, at(1), None, "1.0", -1),
        (4, at(1), at(0), "1.0", -1),
    ]
    runs = frame(spark, "scan_run", rows)
    assert {r.rule: r.failures for r in quality.rule_counts(runs, "scan_run").collect()} == {
        "duration is not negative": 2,
        "documents_scanned is not negative": 2,
    }
    valid, bad = quality.split_valid(runs, "scan_run")
    assert [r.scan_run_id for r in valid.collect()] == [1]
    assert {r.scan_run_id: len(r.broken) for r in bad.collect()} == {2: 1, 3: 1, 4: 2}


def test_rules_on_nulls_and_keys(spark):
    rows = [
        (1, "A", "t", "low", at(0), at(0)),
        (2, "B", None, "low", at(0), None),
        (3, "C", "t", None, at(0), at(1)),
        (4, "C", "t", "low", at(0), at(1)),
    ]
    loose = spark.createDataFrame(
        rows,
        "policy_id int, policy_code string, title string, severity string,"
        " effective_from timestamp, effective_to timestamp",
    )
    assert {r.rule: r.failures for r in quality.rule_counts(loose, "policy").collect()} == {
        "window is not empty": 1,
        "title is null": 1,
        "severity is null": 1,
        "(policy_code) is not unique": 1,
    }
    valid, bad = quality.split_valid(loose, "policy")
    assert valid.count() == 0 and bad.count() == 4


def test_baseline_actions_add_up():
    assert sum(quality.BASELINE_ACTIONS.values()) == quality.BASELINE_COUNTS["violation"]
