"""SimHash near-duplicates by deletion-variant signatures.

Two 64-bit fingerprints that differ in at most three bits differ in at most one bit of one of
their two halves. Each half is therefore indexed as it is and with each of its bits masked: an
equality join on a masked half meets every half that differs in just that bit. Where a bucket is
large, the bits that it does not fix are cut into halves again, so buckets stay bounded (a third
cut leaves eight free bits, 512 fingerprints) without losing a link.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from openloop.functions.durable import staged
from openloop.llm.components import components
from openloop.llm.texts import text_bytes

SEED = 42
#: Fingerprints of a bucket that are compared directly; a larger bucket is cut further.
BUCKET = 4096
#: Shingles that are turned into bits at a time.
BLOCK = 1 << 16


def fingerprint(text: bytes, width: int = 3) -> int:
    """The unsigned SimHash of the whole text; zero without words."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < width:
        shingles, n = iter([b" ".join(words)]), 1
    else:
        shingles, n = map(b" ".join, zip(*(words[k:] for k in range(width)))), len(words) - width + 1
    hashes = map(xxhash.xxh64_intdigest, shingles, repeat(SEED))
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, n, BLOCK):
        block = np.fromiter(hashes, np.uint64, min(BLOCK, n - start))
        bits = np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = 3
) -> DataFrame:
    """(id, fp): one row per document; ``fp`` holds the 64 bits as a signed long."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(text, width) for text in batch.column(1).to_pylist()]
            signed = np.array(values, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signed)], names=["id", "fp"])

    rows = docs.select(F.col(id_column).alias("id"), text_bytes(F.col(text_column)).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, fp long")


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _index(members: DataFrame, width: int) -> DataFrame:
    """One row per bucket that a member falls into. ``low`` is the first of the ``width`` bits
    that the member's bucket ``key`` leaves free."""
    half = width // 2
    mask = (1 << half) - 1
    slots = F.explode(
        F.array([
            F.struct(F.lit(h).cast("int").alias("half"), F.lit(b).cast("int").alias("bit"))
            for h in (0, 1) for b in range(-1, half)
        ])
    )
    # Members are few and narrow, their buckets many: they are dealt out before they multiply.
    dealt = members.repartition(_partitions(members), "fp")
    cut = dealt.select("key", "fp", "low", slots.alias("slot")).select(
        "key", "fp", "slot", "low", (F.col("low") + F.col("slot.half") * half).alias("at")
    )
    part = F.expr(f"shiftright(fp, at) & {mask}L")
    cut = cut.withColumn("part", part)
    bit = F.expr("CASE WHEN slot.bit < 0 THEN 0 ELSE shiftright(part, slot.bit) & 1 END")
    masked = F.expr("CASE WHEN slot.bit < 0 THEN part ELSE part & ~shiftleft(1L, slot.bit) END")
    return cut.select(
        F.xxhash64("key", "slot.half", "slot.bit", masked).alias("key"),
        "fp",
        (F.col("low") + (1 - F.col("slot.half")) * half).alias("low"),
        (F.col("slot.bit") >= 0).alias("masked"),
        bit.cast("int").alias("side"),
    )


def _spanning(distance: int):
    """Links of each bucket that join what a bucket's members join, at most one per member."""

    def bucket(fps: np.ndarray, sides: np.ndarray, masked: bool) -> Iterator[tuple[int, int]]:
        waiting = np.arange(len(fps))
        while len(waiting):
            frontier, waiting = [waiting[0]], waiting[1:]
            while frontier and len(waiting):
                at = frontier.pop()
                near = np.bitwise_count(fps[waiting] ^ fps[at]) <= distance
                if masked:  # equal sides meet in the bucket that masks no bit
                    near &= sides[waiting] != sides[at]
                for found in waiting[near]:
                    frontier.append(found)
                    yield fps[at], fps[found]
                waiting = waiting[~near]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        last = object()
        for batch in _with_end(batches, last):
            ends = batch is last
            if not ends:
                table = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in ("key", "fp", "side", "masked")}
                rest = table if rest is None else {n: np.concatenate([rest[n], table[n]]) for n in table}
            if rest is None or not len(rest["key"]):
                continue
            cuts = np.flatnonzero(np.diff(rest["key"])) + 1
            bounds = [0, *cuts.tolist()] + ([len(rest["key"])] if ends else [])
            found = []
            for a, b in zip(bounds, bounds[1:]):
                if b - a > 1:
                    found += bucket(rest["fp"][a:b].view(np.uint64), rest["side"][a:b], bool(rest["masked"][a]))
            rest = {n: v[bounds[-1]:] for n, v in rest.items()}
            if found:
                pairs = np.array(found, dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    return run


def _with_end(batches: Iterator, last: object) -> Iterator:
    yield from batches
    yield last


def links(fps: DataFrame, distance: int = 3, bucket: int = BUCKET) -> DataFrame:
    """(a, b) links that connect what the links between all ``fps`` (distinct, column ``fp``) at
    ``distance`` or less connect. Every link within a bucket is tested; of a bucket's links a
    spanning forest is returned."""
    if distance > 3:
        raise ValueError("two halves with one masked bit find up to three differing bits")
    members = fps.select(F.lit(0).cast("long").alias("key"), "fp", F.lit(0).alias("low"))
    found, width = [], 64
    while True:
        index = _index(members, width)
        last = width == 16
        sizes = index.groupBy("key").agg(
            F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"),
            F.min("side").alias("s0"), F.max("side").alias("s1"), F.first("masked").alias("m"),
        )
        sizes = staged(sizes.where("n > 1 AND (NOT m OR s0 < s1)").drop("s0", "s1", "m"))
        near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
        found.append(sizes.where("n = 2").where(near).select("a", "b"))
        direct = sizes.where("n > 2") if last else sizes.where(f"n > 2 AND n <= {bucket}")
        rows = index.join(direct.select("key"), "key").select("key", "fp", "side", "masked")
        rows = rows.repartition("key").sortWithinPartitions("key")
        found.append(rows.mapInArrow(_spanning(distance), "a long, b long"))
        large = sizes.where(f"n > {bucket}").select("key")
        if last or large.isEmpty():
            return reduce(DataFrame.union, found)
        members, width = staged(index.join(large, "key").select("key", "fp", "low")), width // 2


def simhash_components(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    width: int = 3, distance: int = 3, bucket: int = BUCKET,
) -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component_id.

    Fingerprints of ``width``-word shingles, repeats included, over the whole lower-cased text;
    documents link at ``distance`` or fewer differing bits. A null, empty or blank text has
    fingerprint zero and links like any other. ``component_id`` is the smallest id reachable,
    ignoring null ids (null where no id is known). Repeated rows give repeated rows; an empty
    table gives none; further columns are ignored.
    """
    prints = staged(fingerprints(docs, id_column, text_column, width))
    fps = staged(prints.groupBy("fp").agg(F.min("id").alias("first")))
    roots = components(links(fps.select("fp"), distance, bucket), "a", "b")
    owned = fps.join(roots, fps["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    smallest = owned.groupBy("root").agg(F.min("first").alias("component_id"))
    named = owned.join(smallest, "root").select("fp", "component_id")
    return prints.join(named, "fp").select(
        F.col("id").alias(id_column), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one_per_component(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their near-duplicate group, with all
    their columns. Rows with a null id stay where their whole group has none."""
    found = simhash_components(docs, id_column, text_column, **options)
    kept = found.where(F.col(id_column).eqNullSafe(F.col("component_id"))).select(F.col(id_column).alias("_keep_id"))
    return docs.join(kept.distinct(), docs[id_column].eqNullSafe(kept["_keep_id"]), "left_semi")
