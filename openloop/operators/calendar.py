"""Calendar-true series: every day or month present, with zero where nothing happened."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from openloop.functions.durable import staged

# Calendar units and the step each one takes.
STEPS = {"day": "interval 1 day", "month": "interval 1 month"}


def calendar_spine(
    counts: DataFrame, date: str, value: str, unit: str, keys: list[str] | None = None
) -> DataFrame:
    """``counts`` (one row per key and date) with the missing dates of each key added as zero,
    from the first to the last date over all keys. Without ``keys`` it is one series. Counts are
    stored first, since ends, keys and the spine all read them."""
    keys = keys or []
    counts = staged(counts)
    ends = counts.agg(F.min(date).alias("low"), F.max(date).alias("high"))
    low, high = ends.select("low").scalar(), ends.select("high").scalar()
    series = counts.select(*keys).distinct() if keys else ends.select()
    every = F.sequence(low, high, F.expr(STEPS[unit]))
    spine = series.select(*keys, F.explode(every).alias(date))
    return spine.join(counts, [*keys, date], "left").withColumn(
        value, F.coalesce(F.col(value), F.lit(0).cast("bigint"))
    )


def documents_in_existence(document_months: DataFrame, first_seen: str = "month") -> DataFrame:
    """For each month start, how many documents had been first seen at or before it.

    ``document_months`` has one row per document with the first month start at or after its
    first sighting; one row per month is left before the running total.
    """
    appeared = document_months.groupBy(first_seen).agg(F.count(F.lit(1)).alias("appeared"))
    months = calendar_spine(appeared, first_seen, "appeared", "month")
    so_far = Window.orderBy(first_seen).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return months.select(first_seen, F.sum("appeared").over(so_far).alias("documents"))
