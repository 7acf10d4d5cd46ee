"""Declared schema of the audit star: types, closed value sets, keys and row rules."""

from __future__ import annotations

from pyspark.sql import types as T

# Closed value sets of the text columns.
SEVERITIES = ("low", "medium", "high", "critical")
ENVIRONMENTS = ("dev", "staging", "prod")
ACTIONS = ("redacted", "flagged", "ignored", "escalated")

# The action that opens a loop and the actions that close one.
OPEN_ACTION = "flagged"
CLOSING_ACTIONS = ("redacted", "escalated")


def _table(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, null) for name, kind, null in fields])


INT, LONG, TEXT, INSTANT = T.IntegerType(), T.LongType(), T.StringType(), T.TimestampType()

POLICY = _table(
    ("policy_id", INT, False),
    ("policy_code", TEXT, False),
    ("title", TEXT, False),
    ("severity", TEXT, False),
    ("effective_from", INSTANT, False),
    ("effective_to", INSTANT, True),
)
DATA_SOURCE = _table(
    ("data_source_id", INT, False),
    ("name", TEXT, False),
    ("department", TEXT, False),
    ("env", TEXT, False),
)
DOCUMENT_REF = _table(
    ("document_ref_id", LONG, False),
    ("data_source_id", INT, False),
    ("external_document_id", TEXT, False),
    ("first_seen_at", INSTANT, False),
)
SCAN_RUN = _table(
    ("scan_run_id", INT, False),
    ("started_at", INSTANT, False),
    ("finished_at", INSTANT, True),
    ("agent_version", TEXT, False),
    ("documents_scanned", INT, False),
)
VIOLATION = _table(
    ("violation_id", LONG, False),
    ("scan_run_id", INT, False),
    ("document_ref_id", LONG, False),
    ("policy_id", INT, False),
    ("action_taken", TEXT, False),
    ("reason", TEXT, False),
    ("detected_at", INSTANT, False),
)

# Parents before children: the order in which tables are loaded and published.
TABLES = {
    "policy": POLICY,
    "data_source": DATA_SOURCE,
    "document_ref": DOCUMENT_REF,
    "scan_run": SCAN_RUN,
    "violation": VIOLATION,
}

# The surrogate key of each table, absent from interchange files.
SURROGATE = {
    "policy": "policy_id",
    "data_source": "data_source_id",
    "document_ref": "document_ref_id",
    "scan_run": "scan_run_id",
    "violation": "violation_id",
}

# Unique column sets besides the surrogate key.
UNIQUE = {
    "policy": [("policy_code",)],
    "data_source": [("name",)],
    "document_ref": [("data_source_id", "external_document_id")],
    "scan_run": [],
    "violation": [("scan_run_id", "document_ref_id", "policy_id")],
}

# child table, foreign key, parent table
FOREIGN_KEYS = [
    ("violation", "scan_run_id", "scan_run"),
    ("violation", "document_ref_id", "document_ref"),
    ("violation", "policy_id", "policy"),
    ("document_ref", "data_source_id", "data_source"),
]

# Row rules as SQL conditions that a good row satisfies. As with a CHECK constraint, a NULL
# outcome is not a failure; NOT NULL is a rule of its own.
ROW_RULES = {
    "policy": {
        "severity in set": f"severity IN {SEVERITIES}",
        "window is not empty": "effective_to IS NULL OR effective_to > effective_from",
    },
    "data_source": {"env in set": f"env IN {ENVIRONMENTS}"},
    "document_ref": {},
    "scan_run": {
        "duration is not negative": "finished_at IS NULL OR finished_at >= started_at",
        "documents_scanned is not negative": "documents_scanned >= 0",
    },
    "violation": {
        "action_taken in set": f"action_taken IN {ACTIONS}",
    },
}


def interchange_columns(table: str) -> list[str]:
    """Columns of a table as they stand in its CSV file: all but the surrogate key."""
    return [f.name for f in TABLES[table].fields if f.name != SURROGATE[table]]
