"""Exact ratios and the severity ladder."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from openloop.functions.clock import whole_div

# Severity ladder. Any other severity has no rank (NULL).
SEVERITY_RANK = {"critical": 4, "high": 3, "medium": 2, "low": 1}


def ratio(numerator: Column, denominator: Column | int, digits: int) -> Column:
    """``numerator / denominator`` rounded half away from zero, in whole-number arithmetic, so
    that a binary representation error never decides a tie.

    The denominator is positive or zero; zero gives NULL. The numerator may reach 4.6e17 at one
    digit; beyond that ANSI mode reports an overflow.
    """
    scale = 10**digits
    top = numerator.cast("bigint")
    below = denominator if isinstance(denominator, Column) else F.lit(denominator)
    below = F.nullif(below.cast("bigint"), F.lit(0).cast("bigint"))
    size = whole_div(F.abs(top) * F.lit(2 * scale) + below, below * F.lit(2))
    signed = F.when(top < 0, -size).otherwise(size)
    return signed.cast("double") / F.lit(float(scale))


def percent(part: Column, whole: Column) -> Column:
    return ratio(part * F.lit(100), whole, 1)


def severity_rank(severity: Column) -> Column:
    rank = F.lit(None).cast("int")
    for name, value in SEVERITY_RANK.items():
        rank = F.when(severity == name, value).otherwise(rank)
    return rank
