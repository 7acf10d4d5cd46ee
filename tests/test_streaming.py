"""Live forms over findings that arrive in several batches."""

import datetime as dt
import random
from types import SimpleNamespace

import pandas as pd
from audit import START, at, star
from openloop.functions.clock import DAY_US, epoch_micros
from openloop.plans.reports import daily_counts, open_findings
from openloop.schemas import VIOLATION
from openloop.streaming import deadlines, live
from pyspark.sql import functions as F

KEYS = ["document_ref_id", "policy_id"]


def findings():
    actions = ("flagged", "redacted", "ignored", "flagged", "escalated")
    return [
        (1 + i % 3, 1 + i % 2, actions[(i * i + i // 7) % 5], at(i * 0.31)) for i in range(160)
    ]


def arrive(spark, model, path, batches=8):
    """Stores findings as files in time order and streams them one file per batch."""
    rows = model.violation.orderBy("detected_at").collect()
    size = -(-len(rows) // batches)
    for b in range(batches):
        part = spark.createDataFrame(rows[b * size : (b + 1) * size], VIOLATION)
        part.coalesce(1).write.parquet(f"{path}/in/batch={b:02d}")
    stream = (
        spark.readStream.schema(VIOLATION)
        .option("maxFilesPerTrigger", 1)
        .option("recursiveFileLookup", "true")
        .parquet(f"{path}/in")
    )
    return live.with_event_time(stream, "detected_at")


def test_live_flags_equal_the_batch_report(spark, tmp_path):
    """Every flag is there whose two days have passed an hour before the newest event."""
    model = star(spark, findings())
    stream = arrive(spark, model, str(tmp_path), batches=4)
    opens = F.col("action_taken") == "flagged"
    closes = F.col("action_taken").isin("redacted", "escalated")
    facts = model.violation.withColumn("us", epoch_micros(model.violation, "detected_at"))
    newest = facts.agg(F.max("us")).first()[0]
    batch = open_findings(facts, KEYS, "us", 2, opens, closes)
    final = batch.filter(F.col("us") + 2 * DAY_US < newest - 3_600_000_000).select(VIOLATION.names)
    expected = sorted(final.collect())
    assert len(expected) > 10
    for spread in (1, 4):
        place = tmp_path / f"s{spread}"
        live_flags = deadlines.never_closed_live(stream, KEYS, opens, closes, days=2, spread=spread)
        found = live.run_to_end(
            live_flags, str(place / "rows"), str(place / "progress"), 3, deadlines.STATE_STORE
        )
        assert found.columns == stream.columns
        assert sorted(found.select(VIOLATION.names).collect()) == expected


def test_a_flag_waits_for_its_own_deadline_only(spark, tmp_path):
    """Late events, equal instants and null keys; what is emitted after each batch."""
    batches = [
        [(1, "flagged", at(0)), (1, "flagged", at(0)), (2, "flagged", at(0, 1)), (None, "flagged", at(0, 2))],
        [(1, "redacted", at(0, -1)), (2, "redacted", at(2, 1)), (3, "flagged", at(1))],
        [(9, "ignored", at(2, 2))],
        [(4, "flagged", at(2, 1, 500)), (3, "escalated", at(2, 23, 999)), (9, "ignored", at(3, 2))],
        [(9, "ignored", at(6))],
    ]
    due = [[], [], [1, 1], [1, 1, None], [1, 1, None, 4]]
    opens = F.col("action_taken") == "flagged"
    closes = F.col("action_taken").isin("redacted", "escalated")
    schema = "document_ref_id long, action_taken string, detected_at timestamp"
    for k, (rows, expected) in enumerate(zip(batches, due)):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"b={k}"))
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
        flags = deadlines.never_closed_live(
            live.with_event_time(stream, "detected_at"), ["document_ref_id"], opens, closes
        )
        found = live.run_to_end(flags, str(tmp_path / "rows"), str(tmp_path / "p"), 2, deadlines.STATE_STORE)
        assert sorted((r.document_ref_id for r in found.collect()), key=str) == sorted(expected, key=str), k


def test_keys_of_one_group_do_not_meet(spark, tmp_path):
    """Many keys in one state, over several batches."""
    model = star(spark, findings())
    stream = arrive(spark, model, str(tmp_path), batches=4)
    opens, closes = F.col("action_taken") == "flagged", F.col("action_taken").isin("redacted", "escalated")
    rows = []
    for groups in (1, 3, 1 << 14):
        place = tmp_path / f"g{groups}"
        flags = deadlines.never_closed_live(stream, KEYS, opens, closes, spread=2, groups=groups)
        found = live.run_to_end(flags, str(place / "rows"), str(place / "p"), 3, deadlines.STATE_STORE)
        rows.append(sorted(found.select(VIOLATION.names).collect()))
    assert len(rows[0]) > 10 and rows[0] == rows[1] == rows[2]


class CountedState(dict):
    """A state in place of Spark's that counts the calls."""

    def __init__(self):
        self.calls, self.timers = 0, set()

    def getMapState(self, name, key, value):
        return self

    def keys(self):
        self.calls += 1
        return list(super().keys())

    def getValue(self, key):
        self.calls += 1
        return self[key]

    def updateValue(self, key, value):
        self.calls += 1
        self[key] = value

    def removeKey(self, key):
        self.calls += 1
        del self[key]

    def registerTimer(self, ms):
        self.calls += 1
        self.timers.add(ms)


def process(processor, state, rows, watermark):
    """What a batch emits at a watermark in microseconds, and how often it called the state."""
    state.calls, values = 0, SimpleNamespace(getCurrentWatermarkInMs=lambda: watermark // 1000)
    frames = [pd.DataFrame(rows[k : k + 70], columns=["key", "us", "opens", "row"]) for k in range(0, len(rows), 70)]
    found = [*processor.handleInputRows((0,), iter(frames), values)] if rows else []
    for ms in sorted(t for t in state.timers if t <= watermark // 1000):
        found += processor.handleExpiredTimer((0,), values, None)
        state.timers.discard(ms)
    return sorted(row for frame in found for row in frame["row"]), state.calls


def test_a_batch_calls_the_state_by_chunks():
    state, processor = CountedState(), deadlines.Deadlines(1000)
    processor.init(state)
    rows = [("a", us, False, "") for us in range(0, 9000, 3)] + [("a", us, True, str(us)) for us in range(9000, 12000)]
    assert process(processor, state, rows, 0) == ([], state.calls)
    assert state.calls <= 1 + 2 * 3 + 1  # a list, chunks, a timer; 4,001 calls and more before
    assert len(state) == 6 and len(state.timers) == 1
    found, calls = process(processor, state, [], 11_000_000)
    assert found == sorted(map(str, range(9000, 12000))) and calls < 20 and not state


def test_groups_emit_each_flag_at_its_deadline():
    """Late events, equal instants and several keys against a loop over all pairs."""
    rng, width, late = random.Random(4), 40_000, 9_000
    for size in (3, deadlines.CHUNK):
        deadlines.CHUNK, before = size, deadlines.CHUNK
        state, processor = CountedState(), deadlines.Deadlines(width)
        processor.init(state)
        flags, closers, out, newest = [], set(), [], 0
        try:
            for batch in range(40):
                watermark = max(newest - late, 0) // 1000 * 1000
                rows = []
                for _ in range(rng.choice([0, 4, 30])):
                    us = rng.randrange(max(batch * 6_000 - 4_000, watermark), batch * 6_000 + 6_000)
                    rows += [(rng.choice("abc"), us, rng.random() < 0.97, str(len(flags) + len(rows)))] * rng.choice([1, 1, 2])
                closers |= {r[:2] for r in rows if not r[2]}
                flags += [r for r in rows if r[2]]
                newest = max([newest, *(r[1] for r in rows)])
                out += process(processor, state, rows, watermark)[0]
                due = [f for f in flags if f[1] + width < watermark]
                assert sorted(out) == sorted(
                    f[3] for f in due if not any(f[0] == k and f[1] <= us <= f[1] + width for k, us in closers)
                )
            assert 30 < len(out) < len(due) and state.timers
            process(processor, state, [], 10**9)
            assert not state and not state.timers
        finally:
            deadlines.CHUNK = before


def test_live_days_equal_the_batch_counts(spark, tmp_path):
    model = star(spark, findings())
    stream = arrive(spark, model, str(tmp_path))
    found = live.run_to_end(
        live.daily_counts_live(stream), str(tmp_path / "rows"), str(tmp_path / "progress")
    )
    newest = max(when for _, _, _, when in findings()) - dt.timedelta(hours=1)
    expected = {
        r.day: r.violations for r in daily_counts(model).collect() if r.day < newest.date()
    }
    assert {r.day: r.violations for r in found.collect()} == expected
    assert min(expected) == START.date()


def test_repeats_are_dropped_on_arrival(spark, tmp_path):
    model = star(spark, findings()[:20])
    model.violation.write.parquet(str(tmp_path / "in" / "a=1"))
    model.violation.write.parquet(str(tmp_path / "in" / "a=2"))
    stream = (
        spark.readStream.schema(VIOLATION)
        .option("recursiveFileLookup", "true")
        .parquet(str(tmp_path / "in"))
    )
    once = live.first_arrivals(live.with_event_time(stream, "detected_at"))
    found = live.run_to_end(once, str(tmp_path / "rows"), str(tmp_path / "progress"))
    assert found.count() == 20


def test_each_batch_is_checked(spark, tmp_path):
    rows = findings()[:8] + [(1, 1, "deleted", at(60))]
    stream = arrive(spark, star(spark, rows), str(tmp_path), batches=3).drop("event_time")
    sink = str(tmp_path / "checks")
    live.check_each_batch(stream, "violation", sink, str(tmp_path / "p")).awaitTermination()
    found = spark.read.parquet(f"{sink}/rows").collect()
    assert [(r.rule, r.failures, r.batch) for r in found] == [("action_taken in set", 1, 2)]


def test_repeats_are_found_however_batches_are_cut(spark, tmp_path):
    rows = findings()[:40] + findings()[10:30]
    expected = None
    for batches in (1, 2, 8):
        place = tmp_path / str(batches)
        stream = arrive(spark, star(spark, rows), str(place), batches).drop("event_time")
        stream = stream.withColumn("scan_run_id", F.lit(1))
        sink = str(place / "checks")
        live.check_each_batch(stream, "violation", sink, str(place / "p")).awaitTermination()
        found = {tuple(r) for r in live.failures_so_far(spark, "violation", sink).collect()}
        assert any("not unique" in rule for rule, _ in found)
        expected = expected or found
        assert found == expected


def test_a_stream_reads_files_and_folders_alike(spark, tmp_path):
    from openloop.bindings.queries import QUERIES

    source = "/root/testdata/sf0.001/events.parquet"
    spark.read.parquet(source).repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    for name in ("t2_live_daily_counts", "t3_live_rule_counts"):
        one = {tuple(r) for r in QUERIES[name](spark, "/root/testdata/sf0.001").collect()}
        many = {tuple(r) for r in QUERIES[name](spark, str(tmp_path)).collect()}
        assert one and one == many


def test_key_counts_keep_few_runs(spark, tmp_path):
    place = str(tmp_path / "keys")
    assert live.key_counts(spark, ["k"], place) is None
    total = {}
    for number in range(50):
        keys = [k for k in range(12) if (k + number) % 4 == 0]
        for k in keys:
            total[k] = total.get(k, 0) + 1
        batch = spark.createDataFrame([(k,) for k in keys], "k int").coalesce(1)
        live.add_key_counts(batch, ["k"], place, number)
        if number % 9 == 0:  # a batch that is run again
            live.add_key_counts(batch, ["k"], place, number)
        spans = live.covering_runs(live._stored_runs(spark, place))
        assert [b for a, z in spans for b in range(a, z + 1)] == list(range(number + 1))
        assert len(spans) <= 3 * 3
        assert len(live._stored_runs(spark, place)) <= 3 * 3 + 2 * live.FANOUT
    assert {r.k: r.n for r in live.key_counts(spark, ["k"], place).collect()} == total


def test_no_batch_no_row(spark, tmp_path):
    assert live.failures_so_far(spark, "violation", str(tmp_path / "none")).count() == 0
