"""Gaps between consecutive events of one entity, for entities of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from openloop.functions.clock import MINUTE_US, slot_of


def gaps_of_small(events: DataFrame, key: str, us: str) -> DataFrame:
    """Gaps between neighbouring events for entities known to fit one task each."""
    before = F.lag(us).over(Window.partitionBy(key).orderBy(us))
    return events.select(
        key, (F.col(us) - before).alias("gap"), F.lit(1).cast("bigint").alias("n")
    ).filter(F.col("gap").isNotNull())


def consecutive_gaps(events: DataFrame, key: str, us: str) -> DataFrame:
    """Gaps in microseconds between neighbouring events of each ``key``: ``(key, gap, n)``,
    where ``n`` says how often a row of gaps occurs. An entity with m events has m-1 gaps.

    Same result as ``us - lag(us) over (partition by key order by us)``, without sending one
    entity to one task. Equal instants are folded first, then the lag runs inside each minute
    of an entity, where at most 60 million distinct microseconds fit. Only the first and last
    instant of a minute go on to a lag over the entity, at most two rows per minute of the span.
    """
    instants = (
        events.groupBy(key, us)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("slot", slot_of(F.col(us), MINUTE_US))
    )
    in_minute = Window.partitionBy(key, "slot").orderBy(us)
    near = instants.select(
        key,
        us,
        "n",
        F.lag(us).over(in_minute).alias("earlier"),
        F.lead(us).over(in_minute).alias("later"),
    )
    inside = near.select(
        key,
        F.explode(
            F.array(
                F.struct(F.lit(0).cast("bigint").alias("gap"), (F.col("n") - 1).alias("n")),
                F.struct((F.col(us) - F.col("earlier")).alias("gap"), F.lit(1).cast("bigint").alias("n")),
            )
        ).alias("g"),
    ).select(key, "g.gap", "g.n")
    edges = near.filter(F.col("earlier").isNull() | F.col("later").isNull())
    # Reading n here keeps the columns of both branches alike, so they share one shuffle.
    across = edges.select(
        key,
        F.when(
            F.col("earlier").isNull(),
            F.col(us) - F.lag(us).over(Window.partitionBy(key).orderBy(us)),
        ).alias("gap"),
        F.least("n", F.lit(1).cast("bigint")).alias("n"),
    )
    return inside.unionByName(across).filter(F.col("gap").isNotNull() & (F.col("n") > 0))


def gap_segments(events: DataFrame, key: str, us: str, segment: list[str]) -> DataFrame:
    """A mergeable summary of the events of each ``key`` and ``segment``: (key, segment columns,
    first_us, last_us, n, gaps), where ``gaps`` lists (gap, n), the gaps between neighbours inside
    the segment and how often each occurs.

    Segments must follow one another in time: no event of a later one comes before an event of
    an earlier one (equal instants may be divided). On a table that is bucketed by key and
    segment the events stay where they are.
    """
    inside = Window.partitionBy(key, *segment).orderBy(us)
    near = events.filter(F.col(us).isNotNull()).select(
        key, *segment, us, (F.col(us) - F.lag(us).over(inside)).alias("gap")
    )
    folded = near.groupBy(key, *segment, "gap").agg(
        F.count(F.lit(1)).alias("n"), F.min(us).alias("first_us"), F.max(us).alias("last_us")
    )
    entry = F.when(F.col("gap").isNotNull(), F.struct("gap", "n"))
    return folded.groupBy(key, *segment).agg(
        F.min("first_us").alias("first_us"),
        F.max("last_us").alias("last_us"),
        F.sum("n").alias("n"),
        F.collect_list(entry).alias("gaps"),
    )


def gaps_from_segments(segments: DataFrame, key: str, segment: list[str]) -> DataFrame:
    """The gaps of :func:`consecutive_gaps`, as (key, gap, n), from stored segments: those inside
    them and those across each border, from the last event before it to the first one after."""
    inside = segments.select(key, F.inline("gaps").alias("gap", "n"))
    in_order = Window.partitionBy(key).orderBy("first_us", "last_us", *segment)
    across = segments.select(
        key,
        (F.col("first_us") - F.lag("last_us").over(in_order)).alias("gap"),
        F.lit(1).cast("bigint").alias("n"),
    )
    return inside.unionByName(across.filter(F.col("gap").isNotNull()))


def counts_from_segments(segments: DataFrame, key: str) -> DataFrame:
    """(key, violation_count, first_us, last_us) from stored segments."""
    return segments.groupBy(key).agg(
        F.sum("n").alias("violation_count"),
        F.min("first_us").alias("first_us"),
        F.max("last_us").alias("last_us"),
    )
