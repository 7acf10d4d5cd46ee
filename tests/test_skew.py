"""Plans for oversized groups: same rows as brute force, no group in one task."""

import random
import re

import numpy as np
import pytest
from audit import at, star
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from openloop.functions import sizing
from openloop.functions.clock import DAY_US, MINUTE_US
from openloop.operators.gaps import consecutive_gaps, gaps_of_small
from openloop.operators.open_loops import never_closed
from openloop.operators.percentiles import exact_percentiles
from openloop.plans import reports
from pyspark.sql import Window
from pyspark.sql import functions as F

RELAXED = settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def spread_gaps(df):
    return sorted(
        (r.key, r.gap) for r in df.collect() for _ in range(r.n)
    )


@RELAXED
@given(
    st.lists(
        st.tuples(st.integers(0, 3), st.integers(-3 * MINUTE_US, 9 * MINUTE_US)),
        min_size=1,
        max_size=80,
    )
)
def test_gaps_equal_lag(spark, events):
    events = events + events[:5]
    df = spark.createDataFrame(events, "key bigint, us bigint")
    expected = []
    for key in {k for k, _ in events}:
        times = sorted(us for k, us in events if k == key)
        expected += [(key, b - a) for a, b in zip(times, times[1:])]
    assert spread_gaps(consecutive_gaps(df, "key", "us")) == sorted(expected)
    assert spread_gaps(gaps_of_small(df, "key", "us")) == sorted(expected)


@RELAXED
@given(
    st.lists(st.tuples(st.integers(0, 2), st.integers(-500, 500)), min_size=1, max_size=60),
    st.sampled_from([1, 7, 100, 1_000_000]),
    st.booleans(),
)
def test_percentiles_equal_interpolation(spark, pairs, chunk, few):
    df = spark.createDataFrame(pairs, "key bigint, v bigint")
    shares = {"p50": (1, 2), "p95": (19, 20), "p0": (0, 1), "p100": (1, 1)}
    found = exact_percentiles(df, ["key"], "v", shares, few_distinct=few, chunk=chunk).collect()
    assert len(found) == len({k for k, _ in pairs})
    for row in found:
        values = sorted(v for k, v in pairs if k == row.key)
        for name, (top, bottom) in shares.items():
            low, part = divmod((len(values) - 1) * top, bottom)
            high = min(low + 1, len(values) - 1)
            step = (values[high] - values[low]) * part / bottom
            assert row[name] == values[low] + int(np.rint(step))


def never_closed_by_window(events, keys, us, width_us, opens, closes):
    """The rows of never_closed from a range frame over each key; ``opens`` and ``closes`` name
    boolean columns of ``events``."""
    ahead = Window.partitionBy(*keys).orderBy(us).rangeBetween(Window.currentRow, width_us)
    met = F.max(F.col(closes).cast("int")).over(ahead)
    return events.withColumn("met", met).filter(F.col(opens) & (F.col("met") == 0)).drop("met")


def brute_force(events, width):
    closers = [(k, us) for k, us, kind in events if kind == "close"]
    return sorted(
        (k, us)
        for k, us, kind in events
        if kind == "open" and not any(c == k and us <= t <= us + width for c, t in closers)
    )


@RELAXED
@given(
    st.lists(
        st.tuples(
            st.integers(0, 2),
            st.integers(-4 * DAY_US, 12 * DAY_US) | st.integers(-4, 12).map(lambda d: d * DAY_US),
            st.sampled_from(["open", "close", "none"]),
        ),
        min_size=1,
        max_size=60,
    ),
    st.sampled_from([1, 2, 3]),
)
def test_never_closed_equals_brute_force(spark, events, days):
    df = spark.createDataFrame(events, "key bigint, us bigint, kind string")
    width = days * DAY_US
    opens, closes = F.col("kind") == "open", F.col("kind") == "close"
    slots = never_closed(df.filter(opens), df.filter(closes).select("key", "us"), ["key"], "us", width)
    marked = df.withColumn("opens", opens).withColumn("closes", closes)
    window = never_closed_by_window(marked, ["key"], "us", width, "opens", "closes")
    expected = brute_force(events, width)
    assert sorted((r.key, r.us) for r in slots.collect()) == expected
    assert sorted((r.key, r.us) for r in window.collect()) == expected


@pytest.fixture
def hot_model(spark):
    """One document holds a third of the findings."""
    rng = random.Random(7)
    actions = ("flagged", "redacted", "ignored", "escalated")
    findings = []
    for i in range(360):
        document = 1 if i % 3 == 0 else rng.choice((2, 3))
        when = at(rng.randrange(0, 60) / 2, us=rng.randrange(0, 3))
        findings.append((document, rng.randrange(1, 5), rng.choice(actions), when))
    return star(spark, findings)


def all_rows(model):
    return {
        slug: sorted(map(str, report.run(model).collect()))
        for slug, report in reports.REPORTS.items()
    }


def test_large_plans_give_the_same_reports(spark, hot_model, monkeypatch):
    small = all_rows(hot_model)
    monkeypatch.setattr(sizing, "MOST_BROADCAST_ROWS", 0)
    monkeypatch.setattr(reports, "MOST_BROADCAST_ROWS", 0)
    monkeypatch.setattr(reports, "MOST_ROWS_PER_TASK", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert all_rows(hot_model) == small
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_gaps_are_shuffled_by_instant_and_minute_before_the_key(spark):
    events = spark.range(1000).select(
        (F.col("id") % 3).alias("key"), (F.col("id") * 977_000).alias("us")
    )
    text = plan_of(consecutive_gaps(events, "key", "us"))
    shuffles = re.findall(r"hashpartitioning\(([^)]*), 8\)", text)
    columns = {re.sub(r"#\d+L?", "", shuffle) for shuffle in shuffles}
    assert columns == {"key, us", "key, slot", "key"}
    # Rows are folded before they first move.
    first = text[text.rindex("hashpartitioning"):]
    assert "HashAggregate" in first


def test_report_plan_has_no_cartesian_product(spark, hot_model):
    for report in reports.REPORTS.values():
        text = plan_of(report.run(hot_model))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_oversized_slot_is_split_at_run_time(spark):
    settings_ = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for key, value in settings_.items():
        spark.conf.set(key, value)
    try:
        # Half of all openers fall on one key and slot.
        openers = spark.range(0, 200_000, 1, 16).select(
            F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("key"),
            (F.col("id") % 1000).alias("us"),
            F.col("id").cast("string").alias("note"),
        )
        closers = spark.range(0, 1000).select("id", F.lit(5).cast("bigint").alias("us"))
        closers = closers.withColumnRenamed("id", "key")
        df = never_closed(openers, closers, ["key"], "us", DAY_US)
        # Key 0 closes openers up to 5; odd keys below 1000 have one opener each, at us = key.
        expected = 200_000 - 3 * 200 - 3
        assert df.count() == expected
        df.collect()
        assert "skew=true" in plan_of(df)
    finally:
        for key in settings_:
            spark.conf.unset(key)


def test_sums_of_long_durations_do_not_overflow(spark):
    model = star(
        spark,
        [(1, 1, "ignored", at(0))],
        runs=[(i, at(0), at(365 * 30), "1", 2_000_000_000) for i in range(1, 30)],
    )
    row = reports.REPORTS["scan-throughput"].run(model).first()
    assert row.documents_scanned == 58_000_000_000
    assert row.documents_per_hour == round(2_000_000_000 / (365 * 30 * 24))
