"""Interchange files, dense keys, records, publishing and layouts."""

import glob
import os

import pytest
from audit import at, frame, star
from openloop import schemas
from openloop.functions.clock import epoch_micros
from openloop.operators.gaps import counts_from_segments, gap_segments, gaps_from_segments, gaps_of_small
from openloop.plans.reports import REPORTS
from openloop.sources import interchange, publish, records
from pyspark.sql import functions as F

POLICY_CSV = (
    "policy_code,title,severity,effective_from,effective_to\n"
    '"A","Names, ""full"" and short","high",2025-01-01T00:00:00.000Z,\n'
    '"B","","low",2025-01-01T00:00:00.000Z,2025-02-01T12:30:00.500Z\n'
)


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_typed_load_in_a_session_outside_utc(spark, tmp_path):
    df = interchange.load_table(spark, write(tmp_path / "policy.csv", POLICY_CSV), "policy")
    assert df.schema["policy_id"].dataType == schemas.INT
    ends = df.withColumn("us", epoch_micros(df, "effective_to")).orderBy("policy_id").collect()
    assert [(r.policy_id, r.policy_code, r.title) for r in ends] == [
        (1, "A", 'Names, "full" and short'),
        (2, "B", ""),
    ]
    assert ends[0].us is None
    assert ends[1].us == 1_738_413_000_500_000


def test_header_decides_the_order(spark, tmp_path):
    text = "env,name,department\n\"dev\",\"logs-a\",\"HR\"\n"
    row = interchange.load_table(spark, write(tmp_path / "s.csv", text), "data_source").first()
    assert row.asDict() == {
        "data_source_id": 1,
        "name": "logs-a",
        "department": "HR",
        "env": "dev",
    }
    with pytest.raises(ValueError, match="header"):
        interchange.read_table(spark, write(tmp_path / "t.csv", "name,env\na,b\n"), "data_source")


def test_bad_row_fails_the_load(spark, tmp_path):
    text = "data_source_id,external_document_id,first_seen_at\n1,\"a\",yesterday\n"
    path = write(tmp_path / "d.csv", text)
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        interchange.load_table(spark, path, "document_ref")


def test_line_breaks_inside_quotes(spark, tmp_path):
    text = 'name,department,env\n"logs\na","HR","dev"\n"logs-b","HR","dev"\n'
    path = write(tmp_path / "m.csv", text)
    rows = interchange.load_table(spark, path, "data_source", multiline=True).orderBy("name")
    assert [(r.data_source_id, r.name) for r in rows.collect()] == [(1, "logs\na"), (2, "logs-b")]


def test_keys_are_dense_in_file_order(spark, tmp_path):
    header = "name,department,env\n"
    count = 0
    for part, size in (("part-0", 40_000), ("part-1", 3), ("part-2", 25_000)):
        lines = [f'"logs-{count + i:06d}","HR","dev"\n' for i in range(size)]
        write(tmp_path / "src" / f"{part}.csv", header + "".join(lines))
        count += size
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100KB")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        loaded = interchange.load_table(spark, str(tmp_path / "src"), "data_source")
        wrong = loaded.filter(
            F.col("data_source_id") != F.substring("name", 6, 6).cast("int") + 1
        )
        assert loaded.count() == count and wrong.count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_export_and_load_round_trip(spark, tmp_path):
    rows = [
        (1, 'A,"1"', " spaced ", "high", at(0), None),
        (2, "B", "", "low", at(0, us=5_000), at(9)),
    ]
    policy = frame(spark, "policy", rows).coalesce(1)
    interchange.write_table(policy, str(tmp_path / "out"), "policy")
    (part,) = glob.glob(str(tmp_path / "out" / "part-*"))
    assert open(part).read().splitlines() == [
        "policy_code,title,severity,effective_from,effective_to",
        '"A,""1"""," spaced ","high",2025-03-01T00:00:00.000Z,',
        '"B","","low",2025-03-01T00:00:00.005Z,2025-03-10T00:00:00.000Z',
    ]
    again = interchange.load_table(spark, str(tmp_path / "out"), "policy")
    assert sorted(again.collect()) == sorted(policy.collect())


def test_natural_keys(spark):
    model = star(spark, [(1, 1, "ignored", at(0))])
    found, unknown = records.resolve_documents(
        spark.createDataFrame(
            [("logs-a", "a:000001", 1), ("logs-b", "a:000001", 2), ("none", "a:000001", 3)],
            "name string, external_document_id string, n int",
        ),
        model.data_source,
        model.document_ref,
    )
    assert [(r.n, r.document_ref_id) for r in found.collect()] == [(1, 1)]
    assert sorted(r.n for r in unknown.collect()) == [2, 3]


def csv_root(tmp_path, model, skip_run=False):
    for name, df in model.tables().items():
        if skip_run and name == "scan_run":
            df = df.filter("scan_run_id < 2")
        interchange.write_table(df.coalesce(1), str(tmp_path / "csv" / f"{name}.csv"), name)
    return str(tmp_path / "csv")


FINDINGS = [(1, 1, "flagged", at(0)), (2, 2, "redacted", at(1)), (3, 3, "ignored", at(9))]
LADDER_POLICIES = [
    (1, "PII-1", "Names", "high", at(-100), None),
    (2, "SEC-1", "Keys", "critical", at(-100), None),
    (3, "RET-1", "Age", "medium", at(-100), None),
]


def test_load_publish_and_read(spark, tmp_path):
    model = star(spark, FINDINGS, policies=LADDER_POLICIES)
    loaded = publish.load_model(spark, csv_root(tmp_path, model), str(tmp_path / "staging"))
    for name, df in model.tables().items():
        assert sorted(loaded.tables()[name].collect()) == sorted(df.collect())
    root = str(tmp_path / "published")
    publish.publish_model(loaded, root, "v001")
    publish.publish_model(
        star(spark, FINDINGS[:1], policies=LADDER_POLICIES), root, "v002"
    )
    assert publish.current_model(spark, root).violation.count() == 1
    with pytest.raises(ValueError, match="not greater"):
        publish.publish_model(loaded, root, "v001")
    with pytest.raises(ValueError, match="not greater"):
        publish.publish_model(loaded, root, "v002")
    odd = star(spark, [(1, 1, "deleted", at(0))], policies=LADDER_POLICIES)
    with pytest.raises(publish.InvalidTable, match="action_taken in set: 1"):
        publish.publish_model(odd, root, "v003")
    assert publish.current_model(spark, root).violation.first().action_taken == "flagged"
    # A version that failed leaves no folder, and its name can be used again.
    assert len(os.listdir(f"{root}/versions")) == 2
    publish.publish_model(loaded, root, "v003")
    assert publish.current_model(spark, root).violation.count() == len(FINDINGS)


def test_of_two_publishers_one_wins(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "published")
    one = star(spark, FINDINGS[:1], policies=LADDER_POLICIES)
    two = star(spark, FINDINGS, policies=LADDER_POLICIES)
    publish.publish_model(one, root, "v1")
    check = publish.require_pass

    def meanwhile(checks):
        """Another writer, which began after the same version, is done first."""
        monkeypatch.setattr(publish, "require_pass", check)
        publish.publish_model(two, root, "v3")
        return check(checks)

    monkeypatch.setattr(publish, "require_pass", meanwhile)
    with pytest.raises(publish.PublishConflict, match="entry 2"):
        publish.publish_model(one, root, "v2")
    assert publish.current_model(spark, root).violation.count() == len(FINDINGS)
    assert len(os.listdir(f"{root}/versions")) == 2
    publish.publish_model(one, root, "v4")
    assert publish.current_model(spark, root).violation.count() == 1
    # An entry that its writer could not fill is told, not read as an older version.
    open(f"{root}/log/{4:012d}.json", "w").close()
    with pytest.raises(publish.PublishConflict, match="entry 4"):
        publish.current_model(spark, root)


def test_load_refuses_missing_parents(spark, tmp_path):
    model = star(spark, FINDINGS, policies=LADDER_POLICIES)
    root = csv_root(tmp_path, model, skip_run=True)
    with pytest.raises(AssertionError, match="violation->scan_run orphans: expected 0, got 2"):
        publish.load_model(spark, root, str(tmp_path / "staging"))


def test_load_refuses_broken_rules(spark, tmp_path):
    model = star(spark, FINDINGS)
    with pytest.raises(publish.InvalidTable, match="severity in set: 1"):
        publish.load_model(spark, csv_root(tmp_path, model), str(tmp_path / "staging"))


def test_layouts(spark, tmp_path):
    model = star(spark, FINDINGS)
    publish.save_by_action(model.violation, str(tmp_path / "by_action"))
    flagged = spark.read.parquet(str(tmp_path / "by_action")).filter("action_taken = 'flagged'")
    assert "PartitionFilters: [isnotnull(action_taken" in flagged._jdf.queryExecution().toString()
    assert flagged.count() == 1


def test_bucketed_table_needs_no_shuffle(spark):
    model = star(spark, FINDINGS)
    spark.sql("CREATE DATABASE IF NOT EXISTS audit")
    for name, df in model.tables().items():
        if name != "violation":
            df.write.mode("overwrite").saveAsTable(f"audit.{name}")
    publish.save_by_document(model.violation, "audit.violation", 4)
    publish.refresh_statistics(spark, "audit.violation")
    stored = type(model).from_catalog(spark, "audit")
    segments = publish.segments_of_layout(spark, "audit.violation")
    assert "Exchange" not in segments._jdf.queryExecution().executedPlan().toString()
    expected = REPORTS["flagged-never-actioned"].run(model).collect()
    assert REPORTS["flagged-never-actioned"].run(stored).collect() == expected
    described = spark.sql("DESCRIBE EXTENDED audit.violation").filter("col_name = 'Statistics'")
    assert "3 rows" in described.first().data_type


def test_a_hot_document_is_spread_over_its_slices(spark):
    rows = [(1, 1, "ignored", at(k % 400, 0, k)) for k in range(3000)] + [(2, 1, "ignored", at(k)) for k in range(40)]
    facts = star(spark, rows).violation
    publish.save_by_document(facts, "hot_findings", 16)
    read = spark.table("hot_findings").filter("document_ref_id = 1").select(F.input_file_name().alias("file"))
    assert read.distinct().count() >= 8
    segments = publish.segments_of_layout(spark, "hot_findings")
    found = gaps_from_segments(segments, "document_ref_id", ["time_slice"])
    us = facts.select("document_ref_id", epoch_micros(facts, "detected_at").alias("us"))
    expected = gaps_of_small(us, "document_ref_id", "us")

    def folded(gaps):
        return {tuple(r) for r in gaps.groupBy("document_ref_id", "gap").agg(F.sum("n")).collect()}

    assert folded(found) == folded(expected)
    spark.sql("DROP TABLE hot_findings")


def test_buckets_grow_with_the_findings(spark, tmp_path, monkeypatch):
    """A task reads a bucket whole, so the rows of a bucket stay the same."""
    from openloop.bindings import star as given
    from openloop.bindings.queries import QUERIES

    lines = spark.range(3000).select(
        (F.col("id") % 700).alias("l_orderkey"), F.col("id").alias("l_partkey"), (F.col("id") % 7).alias("l_suppkey"),
        F.lit("R").alias("l_returnflag"), F.lit("O").alias("l_linestatus"), F.lit(1).alias("l_linenumber"),
        F.timestamp_seconds((F.col("id") * 7919 % 2900) * 86_400).cast("timestamp_ntz").alias("l_shipdate"),
    )
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    sizes, save = [], publish.save_by_document

    def saved(violation, name, buckets, *rest):
        save(violation, name, buckets, *rest)
        files = spark.table(name).groupBy(F.input_file_name()).count()
        sizes.append((buckets, files.agg(F.max("count")).first()[0]))

    monkeypatch.setattr(publish, "save_by_document", saved)
    monkeypatch.setattr(publish, "BUCKET_ROWS", 60)
    found = QUERIES["s10_gaps_of_layout"](spark, str(tmp_path)).collect()
    assert sizes[0][0] == 50 and sizes[0][1] <= 150  # eight buckets of 375 rows and more before
    facts = given.line_findings(spark, str(tmp_path))
    gaps = gaps_of_small(facts.select("document_ref_id", epoch_micros(facts, "detected_at").alias("us")), "document_ref_id", "us")
    expected = gaps.groupBy("document_ref_id").agg(F.sum("n"), F.sum("gap"), F.max("gap")).collect()
    assert sorted(found) == sorted(expected) and len(found) == 7
    assert publish.buckets_for(facts, 8) == 50 and publish.buckets_for(facts.limit(0), 8) == 8


def test_segments_may_be_cut_anywhere(spark):
    times = [0, 0, 0, 5, 5, 9, 30, 30, 31, 100]
    expected = sorted(b - a for a, b in zip(times, times[1:]))
    for cuts in ([], [1], [2, 3], [4], [1, 2, 5, 9], list(range(1, 10))):
        rows = [(7, sum(k >= c for c in cuts), t) for k, t in enumerate(times)]
        events = spark.createDataFrame([*rows, (8, 0, 4), (9, 0, None)], "doc int, seg int, us long")
        segments = gap_segments(events, "doc", "us", ["seg"])
        found = gaps_from_segments(segments, "doc", ["seg"]).collect()
        assert sorted(r.gap for r in found for _ in range(r.n)) == expected and {r.doc for r in found} == {7}
        counts = {tuple(r) for r in counts_from_segments(segments, "doc").collect()}
        assert counts == {(7, 10, 0, 100), (8, 1, 4, 4)}


def test_rows_of_stored_files_are_numbered(spark, tmp_path):
    for k, n in enumerate((5, 0, 7, 1)):
        spark.range(10 * k, 10 * k + n).coalesce(1).write.parquet(str(tmp_path / "in" / f"part={k}"))
    rows = spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / "in")).select(
        "id", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.row_index").alias("row_index")
    )
    found = interchange.number_stored_rows(rows, "key").orderBy("key").collect()
    assert [r.key for r in found] == list(range(1, 14))
    assert [r.id for r in found] == [*range(5), *range(20, 27), 30]
    with pytest.raises(ValueError, match="rows given"):
        interchange.number_stored_rows(rows.filter("id != 22"), "key")


def test_statistics_are_read_back(spark):
    spark.range(30).selectExpr("id % 3 AS k").write.mode("overwrite").saveAsTable("counted")
    assert publish.stored_statistics(spark, "counted", "k") == (None, None)
    publish.refresh_statistics(spark, "counted")
    assert publish.stored_statistics(spark, "counted", "k") == (30, 3)
    spark.sql("DROP TABLE counted")


def test_result_envelope(spark, tmp_path):
    model = star(spark, FINDINGS)
    rows = REPORTS["cumulative-load"].run(model)
    result = publish.report_result("cumulative-load", rows, str(tmp_path / "rows"))
    assert result["slug"] == "cumulative-load" and result["count"] == 3
    assert spark.read.json(result["rows"]).count() == 3
