"""Line dedup: levelled sorted runs of line hashes, with DataFrame functions only.

A run is a table bucketed and sorted by the 128-bit hash of a line's key; it holds in how many
documents of its batches the key stands. A new batch folds its own keys, takes off those that a
run has already settled by a merge anti-join, and adds the others as a run of its own; as soon as a
level has ``fanout`` runs they are merged into one of the next level. A key's documents are
disjoint between batches, so the counts of its runs add up.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from openloop.functions.durable import staged
from openloop.functions.sizing import MOST_BROADCAST_ROWS
from openloop.llm.texts import ascii_lower, let

HASH = ["h1", "h2"]
WHO = ["nul", "doc", "tie"]
#: Slices of a table that are added one after the other.
BATCHES = 4


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hashes(text: Column, shortest: int) -> Column:
    """The hash of each line's key, null where the key has fewer than ``shortest`` code points. A
    key is the line without ASCII white space at its ends, A-Z lower-cased."""

    def hashed(line: Column) -> Column:
        pair = F.struct(F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(1), line).alias("h2"))
        return F.when(F.length(line) >= shortest, pair)

    keys = F.transform(split_lines(ascii_lower(text)), lambda line: F.btrim(line, F.lit(" \t\n\x0b\f\r")))
    return F.transform(keys, hashed)


def different(hashes: Column) -> Column:
    """The distinct non-null hashes of one document, by sorting."""
    ordered = F.sort_array(F.filter(hashes, lambda h: h.isNotNull()))
    return let(ordered, lambda a: F.filter(a, lambda h, i: (i == 0) | (h != F.get(a, i - 1))))


class LineRuns:
    """An index of line hashes over all batches added so far.

    ``least`` is the number of documents from which a key is settled. Runs are tables of the
    session's catalog, below its warehouse, named after ``name``; an index whose runs are kept
    takes further batches in a later session through ``levels``.
    """

    def __init__(
        self, spark: SparkSession, least: int, name: str | None = None, fanout: int = 2,
        buckets: int | None = None, levels: list[list[str]] | None = None,
    ):
        self.spark, self.least, self.fanout = spark, least, fanout
        self.name = name or f"line_runs_{uuid.uuid4().hex}"
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels = levels or []

    def add(self, lines: DataFrame) -> None:
        """Adds a batch: one row (h1, h2) for each document and different key."""
        own = lines.groupBy(*HASH).agg(F.count("*").alias("n"))
        for run in self._runs():
            own = own.join(run.where(F.col("n") >= self.least), HASH, "left_anti")
        self._write(own, 0)
        level = 0
        while len(self.levels[level]) >= self.fanout:
            merged = [self.spark.table(n) for n in self.levels[level]]
            self._write(self._folded(merged), level + 1)
            self._drop(self.levels[level])
            self.levels[level] = []
            level += 1

    def settled(self) -> DataFrame:
        """(h1, h2, n) of the keys found in ``least`` documents or more. ``n`` stops growing when
        a run has settled the key, so it is a lower bound of the number of documents."""
        runs = self._runs()
        if not runs:
            return self.spark.createDataFrame([], "h1 long, h2 long, n long")
        return self._folded(runs).where(F.col("n") >= self.least)

    def drop(self) -> None:
        self._drop([name for level in self.levels for name in level])
        self.levels = []

    def _runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    @staticmethod
    def _folded(runs: list[DataFrame]) -> DataFrame:
        """One run of several: a key stands once in each, so sorted runs are merged by full joins.
        (A union of bucketed tables is grouped without an exchange by Spark 4.1, with wrong sums.)"""

        def merged(left: DataFrame, right: DataFrame) -> DataFrame:
            both = left.join(right.withColumnRenamed("n", "m"), HASH, "full_outer")
            return both.select(*HASH, (F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))).alias("n"))

        return reduce(merged, runs)

    def _write(self, rows: DataFrame, level: int) -> None:
        name = f"{self.name}_{level}_{uuid.uuid4().hex[:8]}"
        dealt = rows.repartition(self.buckets, *HASH)
        dealt.write.bucketBy(self.buckets, *HASH).sortBy(*HASH).saveAsTable(name, format="parquet")
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)

    def _drop(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def _marked(lines: DataFrame, settled: DataFrame, total: int) -> DataFrame:
    """(nul, doc, tie, at) of the lines (.., at, h1, h2) whose key is settled. The keys that make
    up more than a millionth of all rows each are fewer than a million, so they are broadcast;
    the others, none of which is hot, meet in a shuffle."""
    bar = -(-total // MOST_BROADCAST_ROWS)
    hot = F.broadcast(settled.where(F.col("n") >= bar).select(*HASH))
    found = lines.join(hot, HASH, "left_semi")
    rest = settled.where(F.col("n") < bar).select(*HASH)
    if not rest.isEmpty():
        found = found.union(lines.join(rest, HASH, "left_semi"))
    return found.select(*WHO, "at")


def drop_common_lines(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    least: int = 10, shortest: int = 1, batches: int = BATCHES, fanout: int = 2,
) -> DataFrame:
    """One row per document: id, n_lines, n_dropped, kept (the lines left, joined by newlines).

    Texts are split at newlines; a null or empty text is one empty line. A line goes from every
    document where its key (see :func:`line_hashes`) stands in ``least`` documents or more; how
    often it stands in one of them does not matter. Each row counts as a document, repeated rows
    and rows with a null id too. Shorter keys, blank lines among them, always stay. An empty table
    gives no row; further columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    ident, text = F.col(id_column), F.col(text_column)
    rows = docs.select(ident.alias("id"), F.xxhash64(text).alias("tie"), text.alias("text"))
    kind = docs.schema[id_column].dataType
    # A null id is told apart by a column of its own, so that joins are plain equality.
    blank = F.lit(0 if kind.typeName() in ("byte", "short", "integer", "long") else "").cast(kind)
    rows = rows.select("id", F.col("id").isNull().alias("nul"), F.coalesce("id", blank).alias("doc"), "tie", "text")
    hashed = rows.select(*WHO, line_hashes(F.col("text"), shortest).alias("hashes"))
    hashed = staged(hashed.withColumn("batch", F.pmod(F.xxhash64(*WHO), F.lit(batches)).cast("int")), "batch")
    runs = LineRuns(spark, least, fanout=fanout)
    for batch in range(batches):
        part = hashed.where(F.col("batch") == batch)
        runs.add(part.select(F.explode(different(F.col("hashes"))).alias("h")).select("h.h1", "h.h2"))
    settled = staged(runs.settled())
    total = hashed.agg(F.sum(F.size("hashes"))).first()[0] or 0
    runs.drop()
    lines = hashed.select(*WHO, F.posexplode("hashes").alias("at", "h")).where("h IS NOT NULL")
    marks = _marked(lines.select(*WHO, "at", "h.h1", "h.h2"), settled, total)
    marks = marks.groupBy(*WHO).agg(F.collect_set("at").alias("gone"))
    joined = rows.join(marks, WHO, "left").select("id", "text", "gone")

    def left(lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.coalesce("gone", F.array().cast("array<int>")))
        kept = F.array_join(F.transform(stay, lambda at: F.get(lines, at)), "\n")
        return F.struct(F.size(lines).cast("long").alias("n_lines"), kept.alias("kept"))

    found = joined.select("id", F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
                          let(split_lines(F.col("text")), left).alias("left"))
    return found.select(F.col("id").alias(id_column), "left.n_lines", "n_dropped", "left.kept")
