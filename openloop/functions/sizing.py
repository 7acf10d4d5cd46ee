"""Broadcasting behind a measured size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from openloop.functions.durable import staged

# A narrow row (a key and a short label) of this many stays near 100 MB when broadcast.
MOST_BROADCAST_ROWS = 1_000_000


def is_small(df: DataFrame) -> bool:
    """Counts ``df``; on a Parquet table this reads file footers only."""
    return df.count() <= MOST_BROADCAST_ROWS


def hinted(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint when its row count allows one, else ``df`` itself, which
    then meets the other side in a shuffle join that AQE splits where a key is oversized."""
    return F.broadcast(df) if is_small(df) else df


def keep_matching(facts: DataFrame, keys: DataFrame, how: str = "left_semi") -> DataFrame:
    """``facts`` whose columns match a row of ``keys`` (or, with ``left_anti``, match none).

    ``keys`` is stored first, so its size is known before the plan is made: a small set is
    broadcast and ``facts`` stay where they are.
    """
    found = staged(keys.distinct())
    return facts.join(hinted(found), found.columns, how).select(*facts.columns)


def attach(facts: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Inner join of ``facts`` with stored ``parents``, broadcast when measured small."""
    return facts.join(hinted(staged(parents)), key)
