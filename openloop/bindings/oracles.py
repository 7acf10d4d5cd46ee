"""ANSI SQL statements of the registered queries, for a second engine to check them with.

They are written from the meaning of each query (window lag, anti join, ranked rows), not from
the shape of the Spark plan.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}


def half_up(number: str, by: str, digits: int = 1) -> str:
    """``number / by`` rounded half away from zero, in whole-number arithmetic."""
    scale = 10**digits
    return (
        f"(CASE WHEN ({number}) < 0 THEN -1 ELSE 1 END"
        f" * ((abs({number}) * {2 * scale} + ({by})) // (2 * ({by}))) / {scale}.0)"
    )


def between_ranks(value: str, share: tuple[int, int]) -> str:
    """Interpolated percentile over rows numbered ``rn`` (from 1) of ``n``."""
    top, bottom = share
    low = f"max(CASE WHEN rn = 1 + ((n - 1) * {top}) // {bottom} THEN {value} END)"
    high = f"max(CASE WHEN rn = 1 + ((n - 1) * {top} + {bottom - 1}) // {bottom} THEN {value} END)"
    part = f"((max(n) - 1) * {top}) % {bottom}"
    return (
        f"({low} + CAST(round_even((({high}) - ({low})) * ({part}) / {bottom}.0, 0) AS BIGINT))"
    )


SEVERITY = """coalesce(MAP {'PROMO': 'critical', 'LARGE': 'high', 'STANDARD': 'medium',
    'MEDIUM': 'medium', 'SMALL': 'low'}[p_type], 'unrated')"""
LADDER = "nullif(coalesce(list_position(['low', 'medium', 'high', 'critical'], severity), 0), 0)"
ENV = """CASE r_name WHEN 'AFRICA' THEN 'dev' WHEN 'AMERICA' THEN 'prod' WHEN 'ASIA' THEN 'prod'
    WHEN 'EUROPE' THEN 'staging' WHEN 'MIDDLE EAST' THEN 'test' END"""

SOURCES = f"""sources AS (
    SELECT n_nationkey AS data_source_id, n_name AS name, r_name AS department, {ENV} AS env
    FROM nation JOIN region ON r_regionkey = n_regionkey)"""


def _repeat(key: str, rows: str, label: str, columns: str, order: str, limit: int) -> str:
    return f"""
WITH {SOURCES},
facts AS ({rows}),
gaps AS (
    SELECT {key}, us, us - lag(us) OVER (PARTITION BY {key} ORDER BY us) AS gap FROM facts),
ranked AS (
    SELECT {key}, gap, row_number() OVER (PARTITION BY {key} ORDER BY gap) AS rn,
           count(*) OVER (PARTITION BY {key}) AS n
    FROM gaps WHERE gap IS NOT NULL),
typical AS (
    SELECT {key}, {between_ranks('gap', (1, 2))} AS median_us,
           {between_ranks('gap', (9, 10))} AS p90_us
    FROM ranked GROUP BY {key}),
counted AS (
    SELECT {key}, count(*) AS violation_count, min(us) AS first_us, max(us) AS last_us
    FROM facts GROUP BY {key} HAVING count(*) >= 2)
SELECT {columns},
       violation_count,
       CAST(make_timestamp(first_us) AS DATE) AS first_violation,
       CAST(make_timestamp(last_us) AS DATE) AS last_violation,
       {half_up('median_us', '3600000000')} AS median_gap_hours,
       {half_up('p90_us', '3600000000')} AS p90_gap_hours
FROM counted JOIN typical USING ({key}) {label}
ORDER BY violation_count DESC, median_us ASC NULLS LAST, {order}
LIMIT {limit}"""


for _name, _limit in (("q1_repeat_customers", 40), ("q1_repeat_customers_500", 500)):
    ORACLES[_name] = _repeat(
        "o_custkey",
        "SELECT o_custkey, epoch_us(o_orderdate) AS us FROM orders",
        "JOIN customer ON c_custkey = o_custkey JOIN sources ON data_source_id = c_nationkey",
        "department, name AS data_source, c_name AS external_document_id",
        "c_name",
        _limit,
    )
ORACLES["q1_repeat_users"] = _repeat(
    "user_id", "SELECT user_id, epoch_us(ts) AS us FROM events", "", "user_id", "user_id", 40
)

ORACLES["q2_type_trend"] = f"""
WITH {SOURCES},
monthly AS (
    SELECT p_type AS policy_code, {SEVERITY} AS severity, department,
           CAST(date_trunc('month', l_shipdate) AS DATE) AS month, count(*) AS violations
    FROM lineitem
    JOIN part ON p_partkey = l_partkey
    JOIN supplier ON s_suppkey = l_suppkey
    JOIN sources ON data_source_id = s_nationkey
    GROUP BY ALL),
moved AS (
    SELECT *, lag(violations) OVER (PARTITION BY policy_code, department ORDER BY month) AS before
    FROM monthly)
SELECT policy_code, severity, department, month, violations,
       violations - before AS mom_delta,
       {half_up('100 * (violations - before)', 'before')} AS mom_pct
FROM moved"""

ORACLES["e4_trend_between"] = ORACLES["q2_type_trend"].replace(
    "    GROUP BY ALL",
    "    WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1996-03-10' AND DATE '1997-02-20'\n"
    "    GROUP BY ALL",
)

ORACLES["f12_external_ids"] = """
SELECT c_custkey, n_name || ':' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS external_id
FROM customer JOIN nation ON n_nationkey = c_nationkey"""

ORACLES["q3_top_brands"] = f"""
WITH {SOURCES},
labelled AS (
    SELECT department, p_brand AS policy_code, p_type AS title, {SEVERITY} AS severity
    FROM lineitem
    JOIN supplier ON s_suppkey = l_suppkey
    JOIN sources ON data_source_id = s_nationkey
    JOIN part ON p_partkey = l_partkey)
SELECT department, policy_code, severity, title, count(*) AS violations,
       rank() OVER (PARTITION BY department
                    ORDER BY count(*) DESC, {LADDER} DESC NULLS FIRST, policy_code) AS rnk,
       {half_up('100 * count(*)', 'CAST(sum(count(*)) OVER (PARTITION BY department) AS BIGINT)')}
           AS pct_of_department
FROM labelled
GROUP BY department, policy_code, severity, title
QUALIFY rnk <= 3"""

EVENT_RUNS = """runs AS (
    SELECT user_id, CAST(ts AS DATE) AS day, min(ts) AS started_at,
           CASE WHEN count(*) > 1 THEN max(ts) END AS finished_at, count(*) AS documents_scanned
    FROM events GROUP BY user_id, CAST(ts AS DATE))"""

ORACLES["q4_throughput"] = f"""
WITH {EVENT_RUNS},
timed AS (
    SELECT CAST(extract(hour FROM started_at) AS INTEGER) AS hour_utc, documents_scanned,
           epoch_us(finished_at) - epoch_us(started_at) AS took_us
    FROM runs WHERE finished_at IS NOT NULL),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY hour_utc ORDER BY took_us) AS rn,
           count(*) OVER (PARTITION BY hour_utc) AS n
    FROM timed)
SELECT hour_utc, count(*) AS runs, CAST(sum(documents_scanned) AS BIGINT) AS documents_scanned,
       {half_up('sum(documents_scanned) * 3600000000', 'nullif(sum(took_us), 0)', 0)}
           AS documents_per_hour,
       {between_ranks('took_us', (1, 2))} AS median_duration_us,
       {between_ranks('took_us', (19, 20))} AS p95_duration_us,
       max(took_us) AS max_duration_us
FROM ranked GROUP BY hour_utc"""

# The next purchase of the same user at or after each event: the frame holds all later rows and
# those of the same instant.
NEXT_PURCHASE = """newest AS (SELECT max(ts) AS ts FROM events),
next_purchase AS (
    SELECT *, min(ts) FILTER (event_type = 'purchase') OVER (
               PARTITION BY user_id ORDER BY ts RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING
           ) AS bought_at
    FROM events)"""

ORACLES["q5_errors_unresolved"] = f"""
WITH {NEXT_PURCHASE}
SELECT f.event_id, f.user_id, f.ts AS flagged_at,
       {half_up('epoch_us(newest.ts) - epoch_us(f.ts)', '86400000000')} AS days_open
FROM next_purchase AS f, newest
WHERE f.event_type = 'error' AND epoch_us(newest.ts) - epoch_us(f.ts) >= 172800000000
  AND coalesce(epoch_us(f.bought_at) - epoch_us(f.ts) > 172800000000, true)"""

NEXT_SETTLED = """
    SELECT *, min(l_shipdate) FILTER (l_returnflag <> 'R') OVER (
               PARTITION BY l_suppkey, l_partkey ORDER BY l_shipdate
               RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS settled_at
    FROM lineitem"""

ORACLES["q5_returns_unclosed"] = f"""
WITH {SOURCES},
newest AS (SELECT max(l_shipdate) AS ts FROM lineitem),
next_settled AS ({NEXT_SETTLED}),
waiting AS (
    SELECT f.*, newest.ts AS newest_ts FROM next_settled AS f, newest
    WHERE f.l_returnflag = 'R' AND f.l_shipdate + to_days(30) <= newest.ts
      AND (f.settled_at IS NULL OR f.settled_at > f.l_shipdate + to_days(30))),
labelled AS (
    SELECT department, name AS data_source, env, p_brand AS policy_code, {SEVERITY} AS severity,
           s_name AS external_document_id, l_shipdate AS flagged_at, l_linestatus AS reason,
           {half_up('epoch_us(newest_ts) - epoch_us(l_shipdate)', '86400000000')} AS days_open
    FROM waiting
    JOIN part ON p_partkey = l_partkey
    JOIN supplier ON s_suppkey = l_suppkey
    JOIN sources ON data_source_id = s_nationkey)
SELECT *, {LADDER} AS severity_rank FROM labelled"""


def _running(table: str, column: str) -> str:
    total = "CAST(sum(violations) OVER seven AS BIGINT)"
    return f"""
WITH daily AS (
    SELECT CAST({column} AS DATE) AS day, count(*) AS violations FROM {table} GROUP BY 1)
SELECT day, violations,
       CAST(sum(violations) OVER (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            AS BIGINT) AS cumulative_violations,
       {half_up(total, 'count(*) OVER seven')} AS trailing_7d_avg
FROM daily WINDOW seven AS (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""


ORACLES["q6_daily_events"] = _running("events", "ts")
ORACLES["q6_daily_orders"] = _running("orders", "o_orderdate")

ORACLES["w1_gaps_hot_keys"] = f"""
WITH gaps AS (
    SELECT l_returnflag, epoch_us(l_shipdate) - lag(epoch_us(l_shipdate)) OVER (
               PARTITION BY l_returnflag ORDER BY l_shipdate) AS gap
    FROM lineitem),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY gap) AS rn,
           count(*) OVER (PARTITION BY l_returnflag) AS n
    FROM gaps WHERE gap IS NOT NULL)
SELECT l_returnflag, {between_ranks('gap', (1, 2))} AS median_gap_us,
       {between_ranks('gap', (9, 10))} AS p90_gap_us, max(gap) AS longest_gap_us
FROM ranked GROUP BY 1"""

ORACLES["a7_percentiles_hot_keys"] = f"""
WITH ranked AS (
    SELECT l_linestatus, cents, row_number() OVER (PARTITION BY l_linestatus ORDER BY cents) AS rn,
           count(*) OVER (PARTITION BY l_linestatus) AS n
    FROM (SELECT l_linestatus, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem))
SELECT l_linestatus, {between_ranks('cents', (1, 2))} AS p50,
       {between_ranks('cents', (9, 10))} AS p90, {between_ranks('cents', (19, 20))} AS p95
FROM ranked GROUP BY 1"""

ORACLES["a7_percentiles_wide_values"] = """
WITH wide AS (
    SELECT l_linestatus, ((l_orderkey * 1000003 + l_partkey) % 2147483647) * 2147483647
                             + l_suppkey * 7919 + l_linenumber AS v
    FROM lineitem)
SELECT l_linestatus, min(v) AS smallest, PLACED_MIDDLE AS middle, PLACED_P90 AS p90, max(v) AS largest
FROM (SELECT *, row_number() OVER (PARTITION BY l_linestatus ORDER BY v) AS rn,
             count(*) OVER (PARTITION BY l_linestatus) AS n FROM wide) GROUP BY 1"""
ORACLES["a7_percentiles_wide_values"] = (
    ORACLES["a7_percentiles_wide_values"]
    .replace("PLACED_MIDDLE", between_ranks("v", (1, 2)))
    .replace("PLACED_P90", between_ranks("v", (9, 10)))
)

ORACLES["j5_never_closed_hot_keys"] = """
WITH accepted AS (
    SELECT *, min(l_shipdate) FILTER (l_returnflag = 'A') OVER (
               PARTITION BY l_linestatus ORDER BY l_shipdate
               RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS accepted_at
    FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_linestatus, l_shipdate FROM accepted
WHERE l_returnflag = 'R' AND coalesce(accepted_at > l_shipdate + to_hours(1), true)"""


# Sources -------------------------------------------------------------------------------------

PARTS = f"""parts AS (
    SELECT p_partkey AS policy_id, p_brand AS policy_code, p_type AS title, {SEVERITY} AS severity,
           TIMESTAMP '1992-01-01' + to_days(p_size * 30) AS effective_from,
           CASE WHEN p_size > 25
                THEN TIMESTAMP '1992-01-01' + to_days(CAST(trunc(p_retailprice) AS INTEGER) * 2)
           END AS effective_to
    FROM part)"""

ORACLES["s1_csv_files"] = f"""
WITH {PARTS}
SELECT policy_code, title, severity, epoch_us(effective_from) AS effective_from,
       epoch_us(effective_to) AS effective_to
FROM parts"""

ORACLES["s8_report_envelope"] = """
SELECT 'cumulative-load' AS slug, count(DISTINCT CAST(ts AS DATE)) AS count,
       count(DISTINCT CAST(ts AS DATE)) AS stored, count(*) AS last_total
FROM events"""

ORACLES["s11_action_layout"] = """
SELECT l_suppkey AS document_ref_id, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1"""

ORACLES["s1_csv_parse"] = f"""
WITH {PARTS}
SELECT policy_id, policy_code, title, severity, epoch_us(effective_from) AS effective_from,
       epoch_us(effective_to) AS effective_to
FROM parts"""

ORACLES["s2_dense_keys"] = """
SELECT row_number() OVER () AS violation_id, l_orderkey, l_linenumber, l_partkey, l_suppkey
FROM lineitem"""

FLAT = """flat AS (
    SELECT n_name AS name, c_name AS external_document_id, o_orderstatus AS action_taken,
           o_orderpriority AS reason, o_orderdate AS detected_at, c_acctbal, c_custkey
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey)"""

ORACLES["s4_resolve_documents"] = f"""
WITH {FLAT}
SELECT name, external_document_id, action_taken, reason, detected_at,
       CASE WHEN c_acctbal >= 0 THEN c_custkey END AS document_ref_id
FROM flat"""

ORACLES["s5_flat_documents"] = f"""
WITH {FLAT}
SELECT name, external_document_id, min(detected_at) AS first_seen_at FROM flat GROUP BY 1, 2"""

ORACLES["s5_flat_sources"] = f"WITH {FLAT} SELECT DISTINCT name FROM flat"


def _quoted(column: str) -> str:
    return f"""'"' || replace({column}, '"', '""') || '"'"""


def _instant(column: str) -> str:
    return f"coalesce(strftime({column}, '%Y-%m-%dT%H:%M:%S.%gZ'), '')"


ORACLES["s6_csv_lines_parts"] = f"""
WITH {PARTS}
SELECT policy_id,
       {_quoted('policy_code')} || ',' || {_quoted('title')} || ',' || {_quoted('severity')}
       || ',' || {_instant('effective_from')} || ',' || {_instant('effective_to')} AS line
FROM parts"""

ORACLES["s6_csv_lines_documents"] = f"""
SELECT doc_id,
       coalesce({_quoted('lang')}, '') || ',' || coalesce({_quoted('source')}, '') || ','
       || coalesce(CAST(n_chars AS VARCHAR), '') || ',' || coalesce({_quoted('text')}, '') AS line
FROM documents"""

# Data quality --------------------------------------------------------------------------------

TRADE = f"""{SOURCES}, {PARTS},
documents_seen AS (
    SELECT s_suppkey AS document_ref_id, s_nationkey AS data_source_id,
           s_name AS external_document_id,
           TIMESTAMP '1995-01-01' + to_days(s_nationkey * 30) AS first_seen_at
    FROM supplier),
runs AS (
    SELECT o_orderkey AS scan_run_id, o_orderdate AS started_at,
           CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL 60 DAY END AS finished_at,
           o_orderpriority AS agent_version,
           CAST(floor(o_totalprice / 100000) AS INTEGER) AS documents_scanned
    FROM orders),
findings AS (
    SELECT l_orderkey AS scan_run_id, l_suppkey AS document_ref_id, l_partkey AS policy_id,
           l_returnflag AS action_taken, l_linestatus AS reason, l_shipdate AS detected_at,
           l_linenumber AS line
    FROM lineitem)"""

_BEFORE = """FROM findings
    WHERE detected_at < (SELECT max(d.first_seen_at) FROM documents_seen AS d
                         WHERE d.document_ref_id = findings.document_ref_id)"""
_OUTSIDE = """FROM findings JOIN (
        SELECT scan_run_id, min(started_at) AS opened,
               coalesce(max(finished_at), TIMESTAMP 'infinity') AS closed
        FROM runs GROUP BY 1) USING (scan_run_id)
    WHERE NOT detected_at BETWEEN opened AND closed"""
_OVERFULL = """FROM (
        SELECT scan_run_id, max(place) AS documents FROM (
            SELECT scan_run_id,
                   dense_rank() OVER (PARTITION BY scan_run_id ORDER BY document_ref_id) AS place
            FROM findings)
        GROUP BY 1) JOIN runs USING (scan_run_id)
    WHERE documents > documents_scanned"""


def _orphan(child: str, key: str, parent: str) -> str:
    return (
        f"SELECT coalesce(sum(n), 0) FROM (SELECT {key}, count(*) AS n FROM {child} GROUP BY {key})"
        f" WHERE NOT coalesce({key} IN (SELECT {key} FROM {parent}), false)"
    )


_TRADE_QUERIES = {
    "repeat-offenders": f"""SELECT least(40, count(*)) FROM (
        SELECT document_ref_id FROM findings GROUP BY 1 HAVING count(*) >= 2)""",
    "policy-trend": """SELECT count(*) FROM (
        SELECT DISTINCT policy_code, severity, department, date_trunc('month', detected_at)
        FROM findings JOIN parts USING (policy_id) JOIN documents_seen USING (document_ref_id)
        JOIN sources USING (data_source_id))""",
    "top-policies-per-department": f"SELECT count(*) FROM ({ORACLES['q3_top_brands']})",
    "scan-throughput": """SELECT count(DISTINCT extract(hour FROM started_at)) FROM runs
        WHERE finished_at IS NOT NULL""",
    "flagged-never-actioned": f"""SELECT count(*) FROM ({NEXT_SETTLED}) AS f
        WHERE f.l_returnflag = 'R' AND coalesce(f.settled_at > f.l_shipdate + to_days(2), true)
          AND f.l_shipdate + to_days(2) <= (SELECT max(l_shipdate) FROM lineitem)""",
    "cumulative-load": "SELECT count(DISTINCT CAST(detected_at AS DATE)) FROM findings",
}
# The same expected numbers as the registered gate.
_COUNTS = {
    "policy": ("parts", 2000),
    "data_source": ("sources", 25),
    "document_ref": ("documents_seen", 100),
    "scan_run": ("runs", 15000),
    "violation": ("findings", 60000),
}
_REPORT_SIZES = {
    "repeat-offenders": 40,
    "policy-trend": 10000,
    "top-policies-per-department": 15,
    "scan-throughput": 1,
    "flagged-never-actioned": 20000,
    "cumulative-load": 2495,
}
_ACTION = "('redacted', 'flagged', 'ignored', 'escalated')"
_GATE = [("Counts", t, n, f"SELECT count(*) FROM {v}") for t, (v, n) in _COUNTS.items()]
_GATE += [
    ("Distribution", f"action={a}", 20000, f"SELECT count(*) FROM findings WHERE action_taken = '{a}'")
    for a in ("A", "N", "R")
]
_GATE += [
    (
        "Constraints",
        "policy.severity out of set",
        0,
        "SELECT count(*) FROM parts WHERE severity NOT IN ('low', 'medium', 'high', 'critical')",
    ),
    (
        "Constraints",
        "data_source.env out of set",
        0,
        "SELECT count(*) FROM sources WHERE env NOT IN ('dev', 'staging', 'prod')",
    ),
    (
        "Constraints",
        "violation.action_taken out of set",
        0,
        f"SELECT count(*) FROM findings WHERE action_taken NOT IN {_ACTION}",
    ),
    ("Integrity", "violation->scan_run orphans", 0, _orphan("findings", "scan_run_id", "runs")),
    (
        "Integrity",
        "violation->document_ref orphans",
        0,
        _orphan("findings", "document_ref_id", "documents_seen"),
    ),
    ("Integrity", "violation->policy orphans", 0, _orphan("findings", "policy_id", "parts")),
    (
        "Integrity",
        "document_ref->data_source orphans",
        0,
        _orphan("documents_seen", "data_source_id", "sources"),
    ),
    (
        "Grain",
        "duplicate (run,doc,policy) triples",
        0,
        "SELECT count(*) FROM (SELECT DISTINCT scan_run_id, document_ref_id, policy_id FROM ("
        "SELECT *, count(*) OVER (PARTITION BY scan_run_id, document_ref_id, policy_id) AS n"
        " FROM findings) WHERE n > 1)",
    ),
    ("Invariants", "violation before doc first_seen_at", 0, f"SELECT count(*) {_BEFORE}"),
    ("Invariants", "violation outside its run window", 0, f"SELECT count(*) {_OUTSIDE}"),
    ("Invariants", "run distinct docs > documents_scanned", 0, f"SELECT count(*) {_OVERFULL}"),
]
_GATE += [("Regression", s, _REPORT_SIZES[s], sql) for s, sql in _TRADE_QUERIES.items()]

ORACLES["k_gate"] = (
    f"WITH {TRADE},\nchecks AS ("
    + "\nUNION ALL ".join(
        f"SELECT '{category}' AS category, '{name}' AS name, CAST({expected} AS BIGINT)"
        f" AS expected, CAST(({sql}) AS BIGINT) AS actual"
        for category, name, expected, sql in _GATE
    )
    + ")\nSELECT *, expected = actual AS ok FROM checks"
)

ORACLES["k30_failed_checks"] = (
    f"WITH {TRADE},\nchecks AS ("
    + "\nUNION ALL ".join(
        f"SELECT '{category}' AS category, '{name}' AS name, CAST({expected} AS BIGINT)"
        f" AS expected, CAST(({sql}) AS BIGINT) AS actual"
        for category, name, expected, sql in _GATE
        if category in ("Integrity", "Grain", "Invariants")
    )
    + ")\nSELECT *, category || ': ' || name || ': expected ' || expected || ', got ' || actual AS message"
    " FROM checks WHERE expected <> actual"
)

ORACLES["k10_orphans_orders"] = """
SELECT o_custkey, count(*) AS n FROM orders
WHERE o_custkey NOT IN (SELECT user_id FROM events WHERE user_id IS NOT NULL) GROUP BY 1"""

ORACLES["k10_orphans_labels"] = """
SELECT count(DISTINCT l.doc_id) AS orphan_keys, count(*) AS orphans
FROM labels l LEFT JOIN documents d ON d.doc_id = l.doc_id WHERE d.doc_id IS NULL"""

ORACLES["k17_grain_lines"] = """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"""

_FINDING = "scan_run_id, document_ref_id, policy_id, line, detected_at"
ORACLES["k18_before_first_seen"] = f"WITH {TRADE} SELECT {_FINDING} {_BEFORE}"
ORACLES["k19_outside_run"] = f"WITH {TRADE} SELECT {_FINDING} {_OUTSIDE}"
ORACLES["k20_overfull_runs"] = (
    f"WITH {TRADE} SELECT scan_run_id, documents, documents_scanned {_OVERFULL}"
)
ORACLES["k27_outside_policy_window"] = f"""
WITH {TRADE}
SELECT policy_id, count(*) AS findings FROM findings JOIN parts USING (policy_id)
WHERE NOT (effective_from <= detected_at AND (effective_to IS NULL OR detected_at < effective_to))
GROUP BY 1"""

ORACLES["k28_rule_counts"] = f"""
WITH {TRADE},
found AS (
    SELECT 'policy' AS table_name, 'severity in set' AS rule, count(*) AS failures FROM parts
    WHERE severity NOT IN ('low', 'medium', 'high', 'critical')
    UNION ALL SELECT 'policy', 'window is not empty', count(*) FROM parts
    WHERE effective_to <= effective_from
    UNION ALL SELECT 'policy', '(policy_code) is not unique', count(*) FROM (
        SELECT 1 FROM parts GROUP BY policy_code HAVING count(*) > 1)
    UNION ALL SELECT 'data_source', 'env in set', count(*) FROM sources
    WHERE env NOT IN ('dev', 'staging', 'prod')
    UNION ALL SELECT 'data_source', '(name) is not unique', count(*) FROM (
        SELECT 1 FROM sources GROUP BY name HAVING count(*) > 1)
    UNION ALL SELECT 'document_ref', '(data_source_id, external_document_id) is not unique', count(*)
    FROM (SELECT 1 FROM documents_seen GROUP BY data_source_id, external_document_id
          HAVING count(*) > 1)
    UNION ALL SELECT 'scan_run', 'duration is not negative', count(*) FROM runs
    WHERE finished_at < started_at
    UNION ALL SELECT 'scan_run', 'documents_scanned is not negative', count(*) FROM runs
    WHERE documents_scanned < 0
    UNION ALL SELECT 'violation', 'action_taken in set', count(*) FROM findings
    WHERE action_taken NOT IN {_ACTION}
    UNION ALL
    SELECT 'violation', '(scan_run_id, document_ref_id, policy_id) is not unique', count(*) FROM (
        SELECT 1 FROM findings GROUP BY scan_run_id, document_ref_id, policy_id
        HAVING count(*) > 1))
SELECT * FROM found WHERE failures > 0"""

ORACLES["k28_quarantine"] = f"""
WITH {SOURCES}
SELECT *, 'env in set' AS broken FROM sources WHERE env NOT IN ('dev', 'staging', 'prod')"""

ORACLES["k28_quarantine_repeated"] = f"""
WITH {PARTS}
SELECT *, CASE WHEN severity = 'unrated' THEN 'severity in set; ' ELSE '' END
          || CASE WHEN effective_to <= effective_from THEN 'window is not empty; ' ELSE '' END
          || '(policy_code) is not unique' AS broken
FROM parts WHERE policy_code IN (SELECT policy_code FROM parts GROUP BY 1 HAVING count(*) > 1)"""

ORACLES["k31_readiness"] = f"""
WITH {TRADE},
n AS (SELECT (SELECT count(*) FROM parts) AS policy, (SELECT count(*) FROM sources) AS data_source,
             (SELECT count(*) FROM documents_seen) AS document_ref,
             (SELECT count(*) FROM runs) AS scan_run, (SELECT count(*) FROM findings) AS violation)
SELECT CASE WHEN policy = 2000 AND data_source = 25 AND document_ref = 100 AND scan_run = 15000
                 AND violation = 60000 THEN 'ready' ELSE 'degraded' END AS status, *
FROM n"""

ORACLES["a14_documents_with_findings"] = """
SELECT (SELECT count(DISTINCT l_suppkey) FROM lineitem) AS with_findings,
       (SELECT count(*) FROM supplier) AS documents"""

# Maintenance ---------------------------------------------------------------------------------

ORACLES["m1_retract_runs"] = """
SELECT l_suppkey AS document_ref_id, count(*) AS n FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey
                  AND o_orderpriority = '1-URGENT')
GROUP BY 1
UNION ALL
SELECT -1, count(*) FROM orders WHERE o_orderpriority <> '1-URGENT'"""

ORACLES["m2_still_referenced"] = """
SELECT p_partkey AS policy_id, count(*) AS uses
FROM part JOIN lineitem ON l_partkey = p_partkey WHERE p_size = 50 GROUP BY 1"""

ORACLES["m3_supersede_policy"] = f"""
WITH {PARTS}, chosen AS (SELECT min(policy_id) AS id FROM parts WHERE effective_to IS NULL)
SELECT policy_id, 'P' || policy_id AS policy_code, title, severity, effective_from,
       CASE WHEN policy_id = chosen.id THEN TIMESTAMP '1998-01-01' ELSE effective_to END
           AS effective_to
FROM parts, chosen
UNION ALL
SELECT max(policy_id) + 1, 'P-NEW', 'SUCCESSOR', 'high', TIMESTAMP '1998-01-01', NULL FROM parts"""

ORACLES["m4_first_per_grain"] = """
SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) AS rn
    FROM lineitem)
WHERE rn = 1"""

# Request log ---------------------------------------------------------------------------------

LOG = """log AS (
    SELECT '/' || event_type || '?user=' || user_id AS endpoint, '/' || event_type AS route,
           CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status,
           CAST(floor(value * 10) AS BIGINT) AS latency_ms, CAST(ts AS DATE) AS day
    FROM events)"""

ORACLES["l1_requests_by_status"] = f"""
WITH {LOG} SELECT route, status, count(*) AS requests FROM log GROUP BY 1, 2"""

ORACLES["l2_latency_histogram"] = f"""
WITH {LOG},
bounds AS (SELECT * FROM (VALUES
    ('0.005', 0.005), ('0.025', 0.025), ('0.1', 0.1), ('0.25', 0.25), ('0.5', 0.5), ('1.0', 1.0),
    ('2.5', 2.5), ('5.0', 5.0), ('10.0', 10.0), ('+Inf', CAST('Infinity' AS DOUBLE))) b(le, top)),
totals AS (SELECT route, status, count(*) AS requests, CAST(sum(latency_ms) AS BIGINT) AS total_ms
           FROM log GROUP BY 1, 2)
SELECT t.route, t.status, le, requests, total_ms,
       (SELECT count(*) FROM log l WHERE l.route = t.route AND l.status = t.status
        AND l.latency_ms / 1000.0 <= top) AS within
FROM totals t, bounds"""


def _summary(by: str) -> str:
    part = f"PARTITION BY {by}" if by else ""
    columns = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    rank = "least(n_ok - 1, CAST(floor(CAST({} AS DOUBLE) * n_ok) AS BIGINT)) + 1"
    return f"""
WITH {LOG},
ranked AS (
    SELECT *, CASE WHEN status = 200 THEN row_number() OVER (
               {f'PARTITION BY {by}, status' if by else 'PARTITION BY status'}
               ORDER BY latency_ms) END AS rn,
           count(*) FILTER (WHERE status = 200) OVER ({part}) AS n_ok
    FROM log)
SELECT {columns}count(*) AS requests, count(*) FILTER (WHERE status = 200) AS ok,
       count(*) FILTER (WHERE status <> 200) AS non_200,
       coalesce(max(CASE WHEN rn = {rank.format('0.5')} THEN latency_ms END), 0) AS p50_ms,
       coalesce(max(CASE WHEN rn = {rank.format('0.95')} THEN latency_ms END), 0) AS p95_ms,
       max(latency_ms) FILTER (WHERE status = 200) AS max_ms
FROM ranked {group}"""


ORACLES["l3_load_summary"] = _summary("")
ORACLES["l3_load_summary_by_route"] = _summary("day, route")
ORACLES["l5_outages"] = f"""
SELECT * FROM ({_summary('day, endpoint')}) WHERE ok = 0"""

ORACLES["l4_redact_maps_arrays"] = """
SELECT event_id,
       '{"req":{"headers":{"accept":"' || event_type || '"},"user":' || user_id
       || '},"db":[{"name":' || user_id || '}],"pools":{"first":{}}}' AS record
FROM events"""

ORACLES["l4_redact"] = """
SELECT event_id,
       '{"req":{"headers":{"accept":"' || event_type || '"},"user":' || user_id
       || '},"db":{"name":' || user_id || '}}' AS record
FROM events"""

_REPEATED_LOAD = """numbered AS (
    SELECT (date_diff('day', DATE '1970-01-01', l_shipdate::DATE) * 100 + l_linenumber) * 100
               + ascii(l_returnflag) AS violation_id,
           l_orderkey, l_suppkey, l_partkey, l_returnflag, l_linenumber
    FROM lineitem),
everything AS (
    SELECT violation_id, l_orderkey, l_suppkey, l_partkey, l_returnflag, false AS in_batch FROM numbered
    UNION ALL
    SELECT violation_id + CASE WHEN l_linenumber % 2 = 0 THEN 1 ELSE -1 END, l_orderkey, l_suppkey,
           l_partkey, l_returnflag, true
    FROM numbered WHERE l_returnflag = 'R'
    UNION ALL
    SELECT violation_id, -l_orderkey, l_suppkey, l_partkey, l_returnflag, true FROM numbered)"""

ORACLES["m4_add_keep_first"] = f"""
WITH {_REPEATED_LOAD},
ranked AS (
    SELECT *, row_number() OVER (triple ORDER BY violation_id) AS place,
           bool_or(in_batch) OVER triple AS touched
    FROM everything WINDOW triple AS (PARTITION BY l_orderkey, l_suppkey, l_partkey))
SELECT violation_id, l_orderkey, l_suppkey, l_partkey, l_returnflag FROM ranked
WHERE place = 1 OR NOT touched"""

ORACLES["m4_repeated_in_batch"] = f"""
WITH {_REPEATED_LOAD}
SELECT l_orderkey, l_suppkey, l_partkey, count(*) AS n FROM everything
GROUP BY ALL HAVING bool_or(in_batch) AND count(*) > 1"""

# Lookups and named extensions ----------------------------------------------------------------

ORACLES["p11_policies_in_force"] = f"""
WITH {PARTS}
SELECT * FROM parts WHERE effective_from <= TIMESTAMP '1995-11-12'
  AND (effective_to IS NULL OR TIMESTAMP '1995-11-12' < effective_to)"""

ORACLES["p11_policies_by_month"] = f"""
WITH {PARTS},
months AS (SELECT CAST(unnest(generate_series(TIMESTAMP '1994-01-01', TIMESTAMP '1998-12-01',
                                              INTERVAL 1 MONTH)) AS DATE) AS month)
SELECT month, severity, count(*) AS policies
FROM months JOIN parts ON effective_from <= month AND (effective_to IS NULL OR month < effective_to)
GROUP BY 1, 2"""

ORACLES["p11_policies_at_findings"] = f"""
WITH {PARTS},
moments AS (SELECT DISTINCT l_shipdate AS at_time FROM lineitem),
counted AS (
    SELECT at_time, count(policy_id) AS n
    FROM moments LEFT JOIN parts
      ON effective_from <= at_time AND coalesce(effective_to > at_time, true)
    GROUP BY at_time)
SELECT l_orderkey, l_linenumber, n AS in_force FROM lineitem JOIN counted ON l_shipdate = at_time"""

ORACLES["p11_own_policy_in_force"] = f"""
WITH {PARTS}
SELECT l_orderkey AS scan_run_id, l_linenumber AS line, policy_id, severity
FROM lineitem JOIN parts
  ON policy_id = l_partkey AND l_shipdate >= effective_from
 AND coalesce(l_shipdate < effective_to, true)"""

ORACLES["j9_first_run_after"] = """
WITH starts AS (SELECT o_orderdate AS begun, min(o_orderkey) AS id FROM orders GROUP BY 1)
SELECT l_orderkey AS flagged_in, l_linenumber AS line, epoch_us(l_shipdate) AS us,
       id AS scan_run_id, epoch_us(begun) AS run_us, epoch_us(begun) - epoch_us(l_shipdate) AS wait_us
FROM (SELECT * FROM lineitem WHERE l_returnflag = 'R') AS flagged
ASOF LEFT JOIN starts ON l_shipdate < begun"""

ORACLES["j9_eligible_runs"] = f"""
WITH {EVENT_RUNS}
SELECT event_id, ts AS flagged_at,
       (SELECT count(*) FROM runs r WHERE r.started_at > f.ts
        AND r.started_at <= f.ts + INTERVAL 2 DAY) AS eligible
FROM events f WHERE event_type = 'error'"""

ORACLES["e1_daily_orders_spine"] = f"""
WITH counted AS (
    SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1),
days AS (SELECT CAST(unnest(generate_series((SELECT min(day) FROM counted),
                                            (SELECT max(day) FROM counted), INTERVAL 1 DAY))
                     AS DATE) AS day),
daily AS (SELECT day, coalesce(n, 0) AS violations FROM days LEFT JOIN counted USING (day))
SELECT day, violations,
       CAST(sum(violations) OVER (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            AS BIGINT) AS cumulative_violations,
       {half_up('CAST(sum(violations) OVER seven AS BIGINT)', 'count(*) OVER seven')}
           AS trailing_7d_avg
FROM daily WINDOW seven AS (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""

ORACLES["e1_monthly_trend_spine"] = f"""
WITH {SOURCES},
counted AS (
    SELECT p_type AS policy_code, {SEVERITY} AS severity, department,
           CAST(date_trunc('month', l_shipdate) AS DATE) AS month, count(*) AS n
    FROM lineitem
    JOIN part ON p_partkey = l_partkey
    JOIN supplier ON s_suppkey = l_suppkey
    JOIN sources ON data_source_id = s_nationkey
    GROUP BY ALL),
months AS (SELECT CAST(unnest(generate_series((SELECT min(month) FROM counted),
                                              (SELECT max(month) FROM counted), INTERVAL 1 MONTH))
                       AS DATE) AS month),
series AS (SELECT DISTINCT policy_code, severity, department FROM counted),
monthly AS (
    SELECT policy_code, severity, department, month, coalesce(n, 0) AS violations
    FROM series CROSS JOIN months
    LEFT JOIN counted USING (policy_code, severity, department, month)),
moved AS (
    SELECT *, lag(violations) OVER (PARTITION BY policy_code, department ORDER BY month) AS before
    FROM monthly)
SELECT policy_code, severity, department, month, violations,
       violations - before AS mom_delta,
       {half_up('100 * (violations - before)', 'nullif(before, 0)')} AS mom_pct
FROM moved"""

ORACLES["e2_documents_by_month"] = """
WITH seen AS (SELECT o_custkey, min(o_orderdate) AS ts FROM orders GROUP BY 1),
placed AS (
    SELECT CAST(CASE WHEN date_trunc('month', ts) = ts THEN ts
                ELSE date_trunc('month', ts) + INTERVAL 1 MONTH END AS DATE) AS month FROM seen),
months AS (SELECT CAST(unnest(generate_series((SELECT min(month) FROM placed),
                                              (SELECT max(month) FROM placed), INTERVAL 1 MONTH))
                       AS DATE) AS month)
SELECT month, (SELECT count(*) FROM seen WHERE seen.ts <= months.month) AS documents FROM months"""

ORACLES["e3_hit_rate_by_version"] = f"""
WITH {TRADE},
per_run AS (SELECT scan_run_id, count(*) AS n FROM findings GROUP BY 1),
totals AS (
    SELECT agent_version, count(*) AS runs, CAST(coalesce(sum(n), 0) AS BIGINT) AS findings,
           CAST(sum(documents_scanned) AS BIGINT) AS documents_scanned
    FROM runs LEFT JOIN per_run USING (scan_run_id) GROUP BY 1)
SELECT *, {half_up('100 * findings', 'documents_scanned')} AS findings_per_100 FROM totals"""

ORACLES["e4_daily_rollup"] = f"""
WITH {TRADE}
SELECT CAST(detected_at AS DATE) AS day, policy_id, action_taken, count(*) AS violations,
       CAST(date_trunc('month', detected_at) AS DATE) AS month
FROM findings GROUP BY ALL"""

ORACLES["e4_rollup_read"] = f"""
WITH {TRADE}
SELECT CAST(detected_at AS DATE) AS day, policy_id, action_taken, count(*) AS violations,
       CAST(date_trunc('month', detected_at) AS DATE) AS month
FROM findings
WHERE CAST(detected_at AS DATE) BETWEEN DATE '1996-03-10' AND DATE '1997-02-20' GROUP BY ALL"""

ORACLES["e4_rollup_after_changes"] = f"""
WITH {TRADE}
SELECT CAST(detected_at AS DATE) AS day, policy_id, action_taken, count(*) AS violations,
       CAST(date_trunc('month', detected_at) AS DATE) AS month
FROM findings
WHERE scan_run_id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')
GROUP BY ALL"""

ORACLES["q1_from_segments"] = ORACLES["q1_repeat_customers"]

ORACLES["s10_gaps_of_layout"] = """
WITH gaps AS (
    SELECT l_suppkey, epoch_us(l_shipdate) - epoch_us(lag(l_shipdate) OVER (
               PARTITION BY l_suppkey ORDER BY l_shipdate)) AS gap
    FROM lineitem)
SELECT l_suppkey AS document_ref_id, count(gap) AS gaps, CAST(sum(gap) AS BIGINT) AS span_us,
       max(gap) AS longest_us
FROM gaps GROUP BY 1 HAVING count(gap) > 0"""

ORACLES["s9_statistics"] = "\nUNION ALL ".join(
    f"SELECT '{table}' AS name, count(*) AS n_rows, true AS distinct_close FROM {table}"
    for table in ("lineitem", "orders", "part", "events")
)

ORACLES["s3_publish_and_read"] = """
WITH known AS (
    SELECT *, MAP {'R': 'flagged', 'A': 'redacted', 'N': 'ignored'}[l_returnflag] AS action_taken
    FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders) AND l_partkey IN (SELECT p_partkey FROM part)
      AND l_suppkey IN (SELECT s_suppkey FROM supplier)),
first_of_grain AS (
    SELECT * FROM known
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_suppkey, l_partkey
                               ORDER BY l_linenumber, action_taken, l_linestatus, l_shipdate) = 1),
first_of_line AS (
    SELECT * FROM first_of_grain
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_suppkey, l_partkey, action_taken, l_linestatus, l_shipdate) = 1)
SELECT l_suppkey AS document_ref_id, action_taken, count(*) AS n FROM first_of_line GROUP BY 1, 2"""

_MONTHS_95_96 = "l_shipdate >= DATE '1995-01-01' AND l_shipdate < DATE '1997-01-01'"
ORACLES["a14_documents_between"] = f"""
SELECT p_brand AS policy_code, count(DISTINCT l_suppkey) AS documents
FROM lineitem JOIN part ON p_partkey = l_partkey WHERE {_MONTHS_95_96} GROUP BY 1
UNION ALL
SELECT 'all', count(DISTINCT l_suppkey)
FROM lineitem JOIN part ON p_partkey = l_partkey WHERE {_MONTHS_95_96}"""

ORACLES["a8_sketch_ranks"] = f"""
WITH {EVENT_RUNS}
SELECT CAST(extract(hour FROM started_at) AS INTEGER) AS hour_utc, count(*) AS runs,
       true AS median_within, true AS p95_within
FROM runs WHERE finished_at IS NOT NULL GROUP BY 1"""

ORACLES["e4_load_between"] = _running(
    "(SELECT l_shipdate FROM lineitem WHERE CAST(l_shipdate AS DATE)"
    " BETWEEN DATE '1996-03-10' AND DATE '1997-02-20')",
    "l_shipdate",
)

# Streams: the rows a stream has emitted once all given events have arrived ---------------------

ORACLES["t1_live_unresolved"] = f"""
WITH {NEXT_PURCHASE}
SELECT f.event_id, f.user_id, f.ts AS flagged_at
FROM next_purchase AS f, newest
WHERE f.event_type = 'error' AND f.ts + INTERVAL 2 DAY <= newest.ts - INTERVAL 1 HOUR
  AND coalesce(epoch_us(f.bought_at) - epoch_us(f.ts) > 172800000000, true)"""

ORACLES["t2_live_daily_counts"] = """
SELECT CAST(ts AS DATE) AS day, count(*) AS violations FROM events GROUP BY 1
HAVING CAST(ts AS DATE) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR"""

ORACLES["t3_live_rule_counts"] = """
SELECT 'action_taken in set' AS rule, count(*) AS failures FROM events
WHERE event_type NOT IN ('error', 'purchase')
UNION ALL
SELECT 'reason is null', count(*) FROM events WHERE event_type = 'view'
UNION ALL
SELECT '(scan_run_id, document_ref_id, policy_id) is not unique', count(*) FROM (
    SELECT 1 FROM events GROUP BY CAST(ts AS DATE), user_id, event_type HAVING count(*) > 1)"""

ORACLES["t4_live_first_arrivals"] = "SELECT DISTINCT user_id, event_type FROM events"
