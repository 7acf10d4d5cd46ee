"""Request counts, latency histogram, nearest-rank summary and redaction."""

from openloop.plans import telemetry
from pyspark.sql import Row
from pyspark.sql import functions as F


def log(spark, rows):
    return spark.createDataFrame(
        [("/x", route, status, ms, None) for route, status, ms in rows], telemetry.REQUEST_LOG
    )


def test_counts_and_histogram(spark):
    df = log(spark, [("/a", 200, 5), ("/a", 200, 6), ("/a", 500, 20_000), ("/b", 200, 100)])
    counts = {(r.route, r.status): r.requests for r in telemetry.requests_by_status(df).collect()}
    assert counts == {("/a", 200): 2, ("/a", 500): 1, ("/b", 200): 1}
    rows = telemetry.latency_histogram(df).collect()
    within = {(r.route, r.status, r.le): r.within for r in rows}
    assert within["/a", 200, "0.005"] == 1 and within["/a", 200, "0.025"] == 2
    assert within["/a", 500, "10.0"] == 0 and within["/a", 500, "+Inf"] == 1
    assert within["/b", 200, "0.1"] == 1
    assert len(rows) == 3 * (len(telemetry.LATENCY_BOUNDS) + 1)
    assert {r.total_ms for r in rows if (r.route, r.status) == ("/a", 200)} == {11}


def test_nearest_rank_summary(spark):
    df = log(spark, [("/a", 200, ms) for ms in range(30)] + [("/a", 503, 999)])
    row = telemetry.load_summary(df).first()
    assert (row.requests, row.ok, row.non_200) == (31, 30, 1)
    assert (row.p50_ms, row.p95_ms, row.max_ms) == (15, 28, 29)


def test_summary_matches_the_rule_for_every_size(spark):
    for n in (1, 2, 3, 19, 20, 21, 60, 100, 140, 180):
        row = telemetry.load_summary(log(spark, [("/a", 200, 7 * ms) for ms in range(n)])).first()
        assert row.p50_ms == 7 * min(n - 1, int(0.5 * n))
        assert row.p95_ms == 7 * min(n - 1, int(0.95 * n))


def test_outage(spark):
    df = log(spark, [("/a", 200, 1), ("/b", 500, 2), ("/b", 503, 3)])
    found = telemetry.outages(df, ["route"]).collect()
    assert [(r.route, r.requests, r.p50_ms, r.max_ms) for r in found] == [("/b", 2, 0, None)]
    assert telemetry.outages(df).count() == 0


def test_redaction(spark):
    df = spark.createDataFrame(
        [
            Row(
                id=1,
                password="p",
                DATABASE_URL="u",
                db=Row(connectionString="c", password="p"),
                pool=Row(size=3, password="p"),
                req=Row(headers=Row(authorization="a", accept="x"), password="p"),
                headers=Row(cookie="c", host="h"),
                deep=Row(inner=Row(password="stays: two parents")),
            )
        ]
    )
    kept = telemetry.redact(df)
    assert sorted(kept.columns) == ["deep", "headers", "id", "pool", "req"]
    row = kept.first().asDict(recursive=True)
    assert row["pool"] == {"size": 3}
    assert row["req"] == {"headers": {"accept": "x"}}
    assert row["headers"] == {"host": "h"}
    assert row["deep"]["inner"]["password"] == "stays: two parents"


def test_redaction_inside_maps_arrays_and_whole_structs(spark):
    df = spark.createDataFrame(
        [(1, {"authorization": "a", "accept": "x"}, [("p", "n")], (("a", "c"),), {"k": ("p", 5)}, None)],
        "id int, headers map<string,string>, db array<struct<password:string,name:string>>,"
        " req struct<headers:struct<authorization:string,cookie:string>>,"
        " pool map<string,struct<password:string,size:int>>, cfg struct<password:string,port:int>",
    )
    kept = telemetry.redact(df, (*telemetry.SENSITIVE_PATHS, "pool.*.password"))
    assert kept.columns == ["id", "headers", "db", "pool", "cfg"]
    row = kept.first().asDict(recursive=True)
    assert row == {
        "id": 1, "headers": {"accept": "x"}, "db": [{"name": "n"}], "pool": {"k": {"size": 5}}, "cfg": None,
    }
    assert kept.schema["cfg"].dataType.simpleString() == "struct<port:int>"


def test_reads_json_lines(spark, tmp_path):
    (tmp_path / "log.json").write_text(
        '{"endpoint":"/a?x=1","route":"/a","status":200,"latency_ms":12,"rows":40}\n'
        '{"endpoint":"/health","route":"/health","status":200,"latency_ms":1}\n'
    )
    df = telemetry.read_request_log(spark, str(tmp_path / "log.json"))
    assert df.agg(F.sum("latency_ms"), F.count("rows")).first()[:] == (13, 1)
