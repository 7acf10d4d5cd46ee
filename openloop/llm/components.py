"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from openloop.functions.durable import staged


def _mark(links: DataFrame) -> tuple:
    """Count and order-free digest of a link set; equal marks mean that a round changed nothing."""
    return tuple(
        links.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo")), F.sum(F.hash("hi", "lo").cast("long")))
        .first()
    )


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root) for every node that ``links`` name: root is the smallest node reachable.

    Alternates the large star (hang larger neighbours on the smallest one) and the small star
    (hang a node and its smaller neighbours on the smallest one) until nothing changes; the
    number of rounds grows with the logarithm of a component's size. Each round is one stored
    table, and minima fold before they move, so a node with many links is no bottleneck.
    """
    pairs = links.where(F.col(left) != F.col(right)).select(
        F.greatest(left, right).alias("hi"), F.least(left, right).alias("lo")
    )
    pairs = staged(pairs.distinct())
    mark = _mark(pairs)
    while True:
        both = pairs.union(pairs.select("lo", "hi").toDF("hi", "lo"))
        smallest = both.groupBy("hi").agg(F.min("lo").alias("m"))
        smallest = smallest.select("hi", F.least("hi", "m").alias("m"))
        large = both.join(smallest, "hi").where("lo > hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        large = large.where("hi != lo").distinct()
        smallest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(smallest, "hi").where("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        pairs = staged(small.union(smallest.select("hi", "m")).distinct())
        was, mark = mark, _mark(pairs)
        if was == mark:
            break
    roots = pairs.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    return pairs.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(roots)
