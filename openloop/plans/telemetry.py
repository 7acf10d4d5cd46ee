"""Request-log analytics over records (endpoint, route, status, latency_ms, rows)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

REQUEST_LOG = T.StructType(
    [
        T.StructField("endpoint", T.StringType()),
        T.StructField("route", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("latency_ms", T.LongType()),
        T.StructField("rows", T.LongType()),
    ]
)

# Upper bounds of the latency histogram in seconds.
LATENCY_BOUNDS = (0.005, 0.025, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)

# Field paths that must not leave the log. ``*`` stands for any one parent.
SENSITIVE_PATHS = (
    "req.headers.authorization",
    "req.headers.cookie",
    "headers.authorization",
    "headers.cookie",
    "DATABASE_URL",
    "DATABASE_URL_DIRECT",
    "connectionString",
    "password",
    "*.password",
    "*.connectionString",
)


def read_request_log(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines, one per request."""
    return spark.read.schema(REQUEST_LOG).option("mode", "FAILFAST").json(path)


def requests_by_status(log: DataFrame) -> DataFrame:
    return log.groupBy("route", "status").agg(F.count(F.lit(1)).alias("requests"))


def latency_histogram(log: DataFrame) -> DataFrame:
    """Cumulative histogram per route and status: one row per upper bound and one for +Inf,
    with the total latency and number of requests."""
    seconds = F.col("latency_ms") / 1000
    within = [F.count_if(seconds <= bound).alias(f"b{i}") for i, bound in enumerate(LATENCY_BOUNDS)]
    totals = log.groupBy("route", "status").agg(
        *within,
        F.count(F.lit(1)).alias("requests"),
        F.sum("latency_ms").alias("total_ms"),
    )
    rows = [
        F.struct(F.lit(str(bound)).alias("le"), F.col(f"b{i}").alias("within"))
        for i, bound in enumerate(LATENCY_BOUNDS)
    ]
    rows.append(F.struct(F.lit("+Inf").alias("le"), F.col("requests").alias("within")))
    return totals.select(
        "route", "status", "requests", "total_ms", F.explode(F.array(*rows)).alias("r")
    ).select("route", "status", "r.le", "r.within", "requests", "total_ms")


def _nearest_rank(share: float, total: Column) -> Column:
    """Zero-based rank floor(share x total), the last one at most."""
    return F.least(total - 1, F.floor(F.lit(share).cast("double") * total))


def load_summary(log: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Requests, successes, failures, nearest-rank p50 and p95 and the maximum latency of the
    successes, per group of ``by`` or over the whole log.

    Rows are folded to counts per latency first. A latency is a whole number of milliseconds
    below the request timeout, so few distinct values are left to sort in a group.
    """
    by = by or []
    # A constant key stands in for "the whole log" and is dropped again.
    keys = by or ["all_requests"]
    if not by:
        log = log.withColumn("all_requests", F.lit(True))
    ok = F.col("status") == 200
    folded = log.groupBy(*keys, "latency_ms").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(ok).alias("ok")
    )
    by_latency = Window.partitionBy(*keys).orderBy("latency_ms").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    all_ok = F.sum("ok").over(Window.partitionBy(*keys))
    ranked = folded.select(
        *keys,
        "latency_ms",
        "n",
        "ok",
        all_ok.alias("all_ok"),
        F.sum("ok").over(by_latency).alias("past"),
    )

    def at(share: float) -> Column:
        rank = _nearest_rank(share, F.col("all_ok"))
        here = (F.col("past") - F.col("ok") <= rank) & (rank < F.col("past"))
        return F.coalesce(F.max(F.when(here, F.col("latency_ms"))), F.lit(0).cast("bigint"))

    return ranked.groupBy(*keys).agg(
        F.sum("n").alias("requests"),
        F.sum("ok").alias("ok"),
        (F.sum("n") - F.sum("ok")).alias("non_200"),
        at(0.5).alias("p50_ms"),
        at(0.95).alias("p95_ms"),
        F.max(F.when(F.col("ok") > 0, F.col("latency_ms"))).alias("max_ms"),
    ).select(*by, "requests", "ok", "non_200", "p50_ms", "p95_ms", "max_ms")


def outages(log: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Load summaries without a single success."""
    return load_summary(log, by).filter(F.col("ok") == 0)


def _without(value: Column, kind: T.DataType, paths: list[list[str]]) -> Column | None:
    """``value`` without what ``paths`` (relative to it) name, or None if nothing is left.

    A path steps into structs and maps by name, ``*`` by any name, and into arrays without a
    step. The values of a map have one type, so what is sensitive under one key of it is taken
    out of the values of all keys.
    """
    if isinstance(kind, T.ArrayType):
        if not paths or _without(F.lit(None), kind.elementType, paths) is None:
            return None if paths else value
        return F.transform(value, lambda x: _without(x, kind.elementType, paths))
    if isinstance(kind, T.MapType) and isinstance(kind.keyType, T.StringType):
        named = sorted({p[0] for p in paths if len(p) == 1})
        inner = [p[1:] for p in paths if len(p) > 1]
        if inner and isinstance(kind.valueType, (T.StructType, T.MapType, T.ArrayType)):
            if _without(F.lit(None), kind.valueType, inner) is None:
                return None
            value = F.transform_values(value, lambda k, v: _without(v, kind.valueType, inner))
        return F.map_filter(value, lambda k, v: ~k.isin(named)) if named else value
    if isinstance(kind, T.StructType):
        kept = []
        for f in kind.fields:
            theirs = [p[1:] for p in paths if p[0] in ("*", f.name)]
            if any(p == [f.name] for p in paths):
                continue
            inside = _without(value.getField(f.name), f.dataType, [p for p in theirs if p])
            if inside is not None:
                kept.append(inside.alias(f.name))
        return F.when(value.isNotNull(), F.struct(*kept)) if kept else None
    return value


def redact(log: DataFrame, paths: tuple[str, ...] = SENSITIVE_PATHS) -> DataFrame:
    """``log`` without what ``paths`` name: columns, and inside them fields of structs and keys
    of maps, also within arrays. A column of which nothing would be left is dropped."""
    split = [p.split(".") for p in paths]
    kept = []
    for f in log.schema.fields:
        if [f.name] in split:
            continue
        inner = [p[1:] for p in split if len(p) > 1 and p[0] in ("*", f.name)]
        value = _without(log[f.name], f.dataType, inner) if inner else log[f.name]
        if value is not None:
            kept.append(value.alias(f.name))
    return log.select(*kept)
