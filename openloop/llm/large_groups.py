"""Near copies within groups of candidates that are too large for one task.

Jaccard distance is a metric, so a few sets of a group serve as pivots. Every set is compared with
the pivots of its group, in as many tasks as the group has ``room``; what lies within reach of a
pivot hangs on it, which joins nearly all of a group of near copies. Only groups that are not one
piece by then go on: their sets meet in an index of the rarest shingles, of which two near copies
always share one, and of the pairs that meet, those are compared whose labels differ and whose
distances from the pivots allow it. No task holds a group, and the links are those that a
comparison of all pairs would connect.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from openloop.functions.durable import staged
from openloop.llm.components import components

#: Sets of a group that all others are compared with.
PIVOTS = 8
#: Distances are rounded; what the pivots rule out is ruled out by more than this.
ROUNDING = 1e-9


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    """How many numbers two ascending sets share."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    return int(np.count_nonzero(b[np.minimum(at, len(b) - 1)] == a)) if len(a) else 0


def _alike(shared: int, either: int, least: Fraction) -> bool:
    return shared * least.denominator >= least.numerator * either


def _from_pivots(sets: DataFrame, sizes: DataFrame, room: int, least: Fraction) -> DataFrame:
    """(group, mark, n, far, near): how far a set is from each pivot of its group, and the pivots
    that it is a near copy of. A group is dealt out by ``room``, each part with the pivots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, pivots = None, []
        for batch in batches:
            rows = []
            for group, part, member, mark, packed in zip(*(column.to_pylist() for column in batch.columns)):
                own = np.frombuffer(packed, np.uint64)
                if held != (group, part):
                    held, pivots = (group, part), []
                if not member:
                    pivots.append((mark, own))
                    continue
                far, near = [], []
                for other, others in pivots:
                    shared = _shared(own, others)
                    either = len(own) + len(others) - shared
                    far.append(1 - shared / either if either else 0.0)
                    if other != mark and _alike(shared, either, least):
                        near.append(other)
                rows.append((group, mark, len(own), far, near))
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    names = ["group", "mark", "n", "far", "near"]
    types = [pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.binary())]
    parts = sizes.select("group", F.ceil(F.col("size") / room).alias("parts"))
    place = F.row_number().over(Window.partitionBy("group").orderBy("mark"))
    chosen = sets.select("group", "mark").withColumn("place", place).where(F.col("place") <= PIVOTS)
    pivots = chosen.join(sets, ["group", "mark"]).join(parts, "group").select(
        "group", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("member"), "mark", "shingles"
    )
    part = F.pmod(F.xxhash64("mark"), F.col("parts"))
    members = sets.join(parts, "group").select("group", part.alias("part"), F.lit(1).alias("member"), "mark", "shingles")
    dealt = pivots.union(members).repartition("group", "part").sortWithinPartitions("group", "part", "member", "mark")
    return dealt.mapInArrow(run, "group long, mark binary, n long, far array<double>, near array<binary>")


def _spread(sets: DataFrame) -> DataFrame:
    """(group, mark, n, shingle): a row for each shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, packed in enumerate(batch.column(2)):
                own = np.frombuffer(packed.as_py(), np.int64)
                repeated = pa.array(np.zeros(len(own), np.int64))
                same = [column.slice(row, 1).take(repeated) for column in (batch.column(0), batch.column(1))]
                length = pa.array(np.full(len(own), len(own)))
                columns = [*same, length, pa.array(own)]
                yield pa.RecordBatch.from_arrays(columns, names=["group", "mark", "n", "shingle"])

    return sets.select("group", "mark", "shingles").mapInArrow(run, "group long, mark binary, n long, shingle long")


def _index(sets: DataFrame, least: Fraction) -> DataFrame:
    """(group, shingle, mark): each set by its rarest shingles, one more than near copies may lack."""
    rows = _spread(sets)
    held = rows.groupBy("group", "shingle").agg(F.count("*").alias("held"))
    ordered = F.sort_array(F.collect_list(F.struct("held", "shingle")))
    own = rows.join(held, ["group", "shingle"]).groupBy("group", "mark", "n").agg(ordered.alias("own"))
    needed = F.floor((F.col("n") * least.numerator + least.denominator - 1) / least.denominator)
    rarest = F.slice("own", 1, (F.col("n") - needed + 1).cast("int"))
    found = own.select("group", "mark", F.inline(rarest))
    return found.where("held > 1").select("group", "shingle", "mark")


def _pairs(index: DataFrame, known: DataFrame, least: Fraction) -> DataFrame:
    """(a, b) marks of different labels that share an indexed shingle and may be near copies."""
    rows = index.join(known.select("mark", "label", "n", "far"), "mark")
    mixed = rows.groupBy("group", "shingle").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    rows = rows.join(mixed.where("low != high"), ["group", "shingle"], "left_semi")
    reach = float(1 - least) + ROUNDING
    close = F.forall(F.zip_with("x.far", "y.far", lambda p, q: F.abs(p - q)), lambda d: d <= reach)
    smaller, larger = F.least("x.n", "y.n"), F.greatest("x.n", "y.n")
    sized = smaller * least.denominator >= larger * least.numerator
    same = (F.col("x.group") == F.col("y.group")) & (F.col("x.shingle") == F.col("y.shingle"))
    met = rows.alias("x").join(rows.alias("y"), same & (F.col("x.label") < F.col("y.label")) & sized & close)
    return met.select(F.col("x.mark").alias("a"), F.col("y.mark").alias("b")).distinct()


def _compared(pairs: DataFrame, sets: DataFrame, least: Fraction) -> DataFrame:
    """The pairs (a, b) that are near copies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alike = []
            for one, other in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(one.as_py(), np.uint64), np.frombuffer(other.as_py(), np.uint64)
                shared = _shared(x, y)
                alike.append(_alike(shared, len(x) + len(y) - shared, least))
            yield batch.select(["a", "b"]).filter(pa.array(alike, pa.bool_()))

    left = sets.select(F.col("mark").alias("a"), F.col("shingles").alias("one"))
    right = sets.select(F.col("mark").alias("b"), F.col("shingles").alias("other"))
    rows = pairs.join(left, "a").join(right, "b").select("a", "b", "one", "other")
    return rows.mapInArrow(run, "a binary, b binary")


def _labelled(known: DataFrame, links: DataFrame) -> DataFrame:
    """``known`` with a label that all marks have which ``links`` connect."""
    roots = components(links, "a", "b").withColumnRenamed("node", "mark")
    return known.join(roots, "mark", "left").withColumn("label", F.coalesce("root", "mark")).drop("root")


def kept_of_large(sets: DataFrame, sizes: DataFrame, room: int, least: Fraction) -> DataFrame:
    """(group, mark, kept) of different sets (group, mark, first, shingles): the smallest ``first``
    of the near copies of each, null where none has one. ``sizes`` has the shingles (group, size)
    of each group. Equal to what one task finds that compares all sets of a group."""
    known = staged(_from_pivots(sets, sizes, room, least))
    links = staged(known.select(F.col("mark").alias("a"), F.explode("near").alias("b")))
    labelled = staged(_labelled(known.drop("near"), links))
    several = labelled.groupBy("group").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    several = staged(several.where("low != high").select("group"))
    if not several.isEmpty():
        index = staged(_index(sets.join(several, "group", "left_semi"), least))
        pairs = staged(_pairs(index, labelled, least))
        links = staged(links.union(_compared(pairs, sets, least)))
        labelled = _labelled(labelled.drop("label"), links)
    rows = staged(labelled.select("group", "mark", "label").join(sets.select("mark", "first"), "mark"))
    firsts = rows.groupBy("label").agg(F.min("first").alias("kept"))
    return rows.join(firsts, "label").select("group", "mark", "kept")
