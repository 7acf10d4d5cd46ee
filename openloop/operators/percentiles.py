"""Exact interpolated percentiles of integers, for groups of any size.

The built-in ``percentile`` keeps every distinct value of a group in one task's memory. Here a
group is first reduced to counts per distinct value, then to counts per chunk of a million
neighbouring values, then to counts per range of a million neighbouring chunks. Only the chunks
that hold a wanted rank are opened, so a task sorts one chunk, the chunks of one range, or the
ranges of one group, of which the 64 bits of a value allow 18.5 million. None of these grows with
the rows of a group, however sparse its values are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from openloop.functions.clock import slot_of, whole_div

CHUNK = 1_000_000


def _lower_rank(share: tuple[int, int], total: Column) -> Column:
    """Zero-based rank at or below ``share`` of the way through ``total`` sorted values."""
    return whole_div((total - 1) * F.lit(share[0]), share[1])


def _upper_rank(share: tuple[int, int], total: Column) -> Column:
    return whole_div((total - 1) * F.lit(share[0]) + F.lit(share[1] - 1), share[1])


def exact_percentiles(
    values: DataFrame,
    keys: list[str],
    value: str,
    shares: dict[str, tuple[int, int]],
    weight: str | None = None,
    few_distinct: bool = False,
    few_keys: bool = False,
    chunk: int = CHUNK,
) -> DataFrame:
    """One row per key: each output column of ``shares`` is the percentile (numerator,
    denominator) of BIGINT column ``value``, interpolated between neighbouring ranks and
    rounded half to even to a whole unit. ``weight`` counts repeats of a row.

    ``few_distinct`` says that the distinct values of one key are known to fit a task that
    sorts them with spilling (tens of millions); chunks are then left out. ``few_keys`` says
    that the keys come from a small closed set, such as hours of the day, and that their values
    span tens of millions of chunks at most (durations of up to a year do); the chunks to open, two per
    key and share at most, are then broadcast, the counts stay where they are, and ranges are left
    out.
    """
    size = F.sum(weight) if weight else F.count(F.lit(1))
    counts = values.groupBy(*keys, value).agg(size.alias("n")).filter(F.col(value).isNotNull())
    if few_distinct:
        ranked = _ranked_whole(counts, keys, value)
    else:
        ranked = _ranked_in_chunks(counts, keys, value, shares, chunk, few_keys)

    ends = []
    for name, share in shares.items():
        low, high = _lower_rank(share, F.col("total")), _upper_rank(share, F.col("total"))
        ends.append(F.max(F.when(_holds(low, "first", "past"), F.col(value))).alias(f"{name}_lo"))
        ends.append(F.max(F.when(_holds(high, "first", "past"), F.col(value))).alias(f"{name}_hi"))
    found = ranked.groupBy(*keys).agg(F.max("total").alias("total"), *ends)

    def between(name: str, share: tuple[int, int]) -> Column:
        part = F.pmod((F.col("total") - 1) * F.lit(share[0]), F.lit(share[1]))
        step = (F.col(f"{name}_hi") - F.col(f"{name}_lo")) * part
        return (F.col(f"{name}_lo") + F.rint(step / F.lit(share[1])).cast("bigint")).alias(name)

    return found.select(*keys, *[between(name, share) for name, share in shares.items()])


def _holds(rank: Column, start: str, end: str) -> Column:
    return (F.col(start) <= rank) & (rank < F.col(end))


def _ranked_whole(counts: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Distinct values with the half-open range of ranks [first, past) each one takes up."""
    by_value = Window.partitionBy(*keys).orderBy(value).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    upto = F.sum("n").over(by_value)
    return counts.select(
        *keys,
        value,
        F.sum("n").over(Window.partitionBy(*keys)).alias("total"),
        (upto - F.col("n")).alias("first"),
        upto.alias("past"),
    )


def _ranked_in_chunks(
    counts: DataFrame,
    keys: list[str],
    value: str,
    shares: dict[str, tuple[int, int]],
    chunk: int,
    few_keys: bool,
) -> DataFrame:
    """The same, for the chunks that hold a wanted rank only."""
    # The join below would drop empty keys on one side only; dropping them here lets both uses
    # of the counts share one shuffle.
    counts = counts.withColumn("chunk", slot_of(F.col(value), chunk))
    for name in (*keys, "chunk"):
        counts = counts.filter(F.col(name).isNotNull())

    upto_here = (Window.unboundedPreceding, Window.currentRow)
    chunks = counts.groupBy(*keys, "chunk").agg(F.sum("n").alias("n"))
    if few_keys:
        in_order = Window.partitionBy(*keys).orderBy("chunk").rowsBetween(*upto_here)
        upto = F.sum("n").over(in_order)
        total = F.sum("n").over(Window.partitionBy(*keys)).alias("total")
        chunks = chunks.select(*keys, "chunk", (upto - F.col("n")).alias("before"), upto.alias("upto"), total)
        return _opened(counts, chunks, keys, value, shares, few_keys)
    chunks = chunks.withColumn("range", slot_of(F.col("chunk"), chunk))
    by_range = Window.partitionBy(*keys).orderBy("range").rowsBetween(*upto_here)
    ranges = (
        chunks.groupBy(*keys, "range")
        .agg(F.sum("n").alias("in_range"))
        .select(
            *keys,
            "range",
            (F.sum("in_range").over(by_range) - F.col("in_range")).alias("ahead"),
            F.sum("in_range").over(Window.partitionBy(*keys)).alias("total"),
        )
    )
    in_order = Window.partitionBy(*keys, "range").orderBy("chunk").rowsBetween(*upto_here)
    upto = F.col("ahead") + F.sum("n").over(in_order)
    chunks = chunks.join(ranges, [*keys, "range"]).select(
        *keys, "chunk", (upto - F.col("n")).alias("before"), upto.alias("upto"), "total"
    )
    return _opened(counts, chunks, keys, value, shares, few_keys)


def _opened(
    counts: DataFrame,
    chunks: DataFrame,
    keys: list[str],
    value: str,
    shares: dict[str, tuple[int, int]],
    few_keys: bool,
) -> DataFrame:
    wanted = F.lit(False)
    for share in shares.values():
        for rank in (_lower_rank(share, F.col("total")), _upper_rank(share, F.col("total"))):
            wanted = wanted | _holds(rank, "before", "upto")
    opening = chunks.filter(wanted)
    opened = counts.join(F.broadcast(opening) if few_keys else opening, [*keys, "chunk"])

    by_value = Window.partitionBy(*keys, "chunk").orderBy(value).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    upto = F.col("before") + F.sum("n").over(by_value)
    return opened.select(
        *keys, value, "total", (upto - F.col("n")).alias("first"), upto.alias("past")
    )
