"""A small audit star built from rows, on the declared schema."""

from __future__ import annotations

import datetime as dt

from openloop.model import AuditModel
from openloop.schemas import TABLES

UTC = dt.timezone.utc
START = dt.datetime(2025, 3, 1, tzinfo=UTC)


def at(days=0.0, hours=0.0, us=0):
    return START + dt.timedelta(days=days, hours=hours, microseconds=us)


POLICIES = [
    (1, "PII-1", "Names", "high", at(-100), None),
    (2, "SEC-1", "Keys", "critical", at(-100), None),
    (3, "RET-1", "Age", "medium", at(-100), None),
    (4, "ODD-1", "Odd", "unknown", at(-100), None),
]
SOURCES = [(1, "logs-a", "Support", "prod"), (2, "logs-b", "Legal", "dev")]
DOCUMENTS = [
    (1, 1, "a:000001", at(-50)),
    (2, 1, "a:000002", at(-50)),
    (3, 2, "b:000001", at(-50)),
]


def frame(spark, table, rows):
    return spark.createDataFrame(rows, TABLES[table])


def star(spark, findings, runs=None, policies=POLICIES, sources=SOURCES, documents=DOCUMENTS):
    """``findings``: (document, policy, action, instant); each gets a run of its own that starts
    at its instant and ends a minute later, unless ``runs`` gives the runs."""
    violations = [
        (i, i, doc, pol, action, f"r{i}", when)
        for i, (doc, pol, action, when) in enumerate(findings, 1)
    ]
    if runs is None:
        runs = [
            (i, when, when + dt.timedelta(minutes=1), "1.0", 5)
            for i, (_, _, _, when) in enumerate(findings, 1)
        ]
    return AuditModel(
        policy=frame(spark, "policy", policies),
        data_source=frame(spark, "data_source", sources),
        document_ref=frame(spark, "document_ref", documents),
        scan_run=frame(spark, "scan_run", runs),
        violation=frame(spark, "violation", violations),
    )
