"""Bounded absence: openers with no closer of the same key within a time window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from openloop.functions.clock import slot_of


def closing_bounds(closers: DataFrame, keys: list[str], us: str, width_us: int) -> DataFrame:
    """Per key and time slot of ``width_us``: the last closer in the slot and the first closer
    in the slot after it. One row per (key, slot), folded on the map side."""
    slot = slot_of(F.col(us), width_us)
    nothing = F.lit(None).cast("bigint")
    views = closers.select(
        *keys,
        F.explode(
            F.array(
                F.struct(slot.alias("slot"), F.col(us).alias("here"), nothing.alias("next")),
                F.struct((slot - 1).alias("slot"), nothing.alias("here"), F.col(us).alias("next")),
            )
        ).alias("v"),
    )
    return (
        views.select(*keys, "v.slot", "v.here", "v.next")
        .groupBy(*keys, "slot")
        .agg(F.max("here").alias("last_here"), F.min("next").alias("first_next"))
    )


def never_closed(
    openers: DataFrame, closers: DataFrame, keys: list[str], us: str, width_us: int
) -> DataFrame:
    """Openers at t with no closer of the same keys in the closed window [t, t + width].

    Same rows as an anti join on the keys with a range condition, without comparing every
    opener with every closer. Time is cut into slots as wide as the window. A closer in the
    opener's own slot closes it when it is not earlier; a closer of the next slot closes it
    when it is not later than t + width; no other slot reaches the window. So two instants per
    (key, slot) decide, the join meets at most one row per opener, and a key with very many
    rows is spread over its slots. Within a slot an oversized opener partition can be split at
    run time, because the other side holds one row per key.
    """
    bounds = closing_bounds(closers, keys, us, width_us)
    slotted = openers.withColumn("slot", slot_of(F.col(us), width_us))
    closed = (F.coalesce(F.col("last_here") >= F.col(us), F.lit(False))) | (
        F.coalesce(F.col("first_next") <= F.col(us) + F.lit(width_us), F.lit(False))
    )
    return (
        slotted.join(bounds, [*keys, "slot"], "left")
        .filter(~closed)
        .select(*openers.columns)
    )
