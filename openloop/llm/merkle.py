"""Merkle manifest: one root over all documents, and for each document the witness that leads to it.

The leaves of a group are numbered in order and cut into aligned blocks. A task appends a block's
leaves one after the other to a :class:`Frontier`, the open subtrees of a growing tree; whenever a
sibling is completed, the witnesses of both subtrees grow by the other's digest. Roots of blocks
are appended to blocks of the next level in the same way until each group has one root, and the
roots of groups form the top tree. Witnesses of the upper levels are attached on the way down, so
every join meets at most one block's rows under one key.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from openloop.functions.durable import staged
from openloop.functions.sizing import hinted

#: Levels of a block: 4,096 leaves.
BITS = 12
DIGEST = 32
GROUP = ["known", "grp"]


def joined(*digests: bytes) -> bytes:
    """The digest of an inner node: of its children's digests as hex text."""
    return sha256("".join(d.hex() for d in digests).encode()).digest()


class Frontier:
    """Open subtrees of an aligned block, the largest first, as (level, digest, first leaf).
    ``witnesses`` holds for each leaf the siblings met so far, lowest first."""

    def __init__(self) -> None:
        self.open: list[tuple[int, bytes, int]] = []
        self.witnesses: list[list[bytes]] = []

    def append(self, digest: bytes) -> None:
        self.witnesses.append([])
        self._complete(0, digest, len(self.witnesses) - 1)

    def close(self, height: int) -> bytes:
        """The digest of the node at ``height``; nodes without a sibling are raised alone."""
        while True:
            level, digest, first = self.open.pop()
            if level == height:
                return digest
            self._complete(level + 1, joined(digest), first)

    def _complete(self, level: int, digest: bytes, first: int) -> None:
        while self.open and self.open[-1][0] == level:
            _, left, start = self.open.pop()
            for leaf in range(start, first):
                self.witnesses[leaf].append(digest)
            for leaf in range(first, len(self.witnesses)):
                self.witnesses[leaf].append(left)
            digest, first, level = joined(left, digest), start, level + 1
        self.open.append((level, digest, first))


def fold(digest: bytes, at: int, n: int, siblings: Iterator[bytes]) -> bytes:
    """The root of ``n`` leaves that leaf number ``at`` and its siblings give."""
    while n > 1:
        if at % 2:
            digest = joined(next(siblings), digest)
        elif at + 1 < n:
            digest = joined(digest, next(siblings))
        else:
            digest = joined(digest)
        at, n = at // 2, -(-n // 2)
    return digest


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``at``, the place of a row in its group by ``order``, and ``n``, the group's size.

    Rows are dealt out by ranges of (group, order) and sorted within; the rows a group has in the
    ranges before are added to the place within the range.
    """
    ranges = rows.repartitionByRange(*GROUP, *order).sortWithinPartitions(*GROUP, *order)
    placed = staged(ranges.withColumn("_place", F.monotonically_increasing_id()))
    placed = placed.select("*", F.shiftright("_place", 33).alias("_range"))
    counts = placed.groupBy(*GROUP, "_range").agg(F.min("_place").alias("_first"), F.count("*").alias("_rows"))
    group = Window.partitionBy(*GROUP)
    before = F.sum("_rows").over(group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(
        *GROUP, "_range", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_add"), F.sum("_rows").over(group).alias("n")
    )
    found = placed.join(hinted(staged(counts)), [*GROUP, "_range"])
    return found.withColumn("at", F.col("_place") + F.col("_add")).drop("_place", "_range", "_add")


def _blocks(nodes: DataFrame, bits: int) -> DataFrame:
    """``nodes`` (group, at, n, digest, ..) with ``witness``, the siblings within the block, and
    on the first node of each block its ``root``."""

    def closed(rows: list[tuple[bytes, int, int]]) -> tuple[list[bytes], list[bytes | None]]:
        frontier = Frontier()
        for digest, _, _ in rows:
            frontier.append(digest)
        root = frontier.close(min(bits, (rows[0][2] - 1).bit_length()))
        return list(map(b"".join, frontier.witnesses)), [root] + [None] * (len(rows) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: list[pa.RecordBatch] = []
        held: list[tuple[bytes, int, int]] = []

        def done() -> Iterator[pa.RecordBatch]:
            witnesses, roots = closed(held)
            at = 0
            for piece in pieces:
                own = [pa.array(part[at : at + len(piece)], pa.binary()) for part in (witnesses, roots)]
                yield pa.RecordBatch.from_arrays([*piece.columns, *own], names=[*piece.schema.names, "witness", "root"])
                at += len(piece)
            pieces.clear()
            held.clear()

        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("digest", "at", "n"))))
            cuts = [k for k, row in enumerate(rows) if row[1] & ((1 << bits) - 1) == 0]
            for a, b in zip([0, *cuts], [*cuts, len(rows)]):
                if a < b:
                    if held and rows[a][1] & ((1 << bits) - 1) == 0:
                        yield from done()
                    pieces.append(batch.slice(a, b - a))
                    held.extend(rows[a:b])
        if held:
            yield from done()

    block = F.shiftright("at", bits)
    dealt = nodes.repartition(*GROUP, block).sortWithinPartitions(*GROUP, "at")
    own = [StructField("witness", BinaryType()), StructField("root", BinaryType())]
    return dealt.mapInArrow(run, StructType([*nodes.schema.fields, *own]))


def _climb(nodes: DataFrame, bits: int) -> tuple[list[DataFrame], DataFrame]:
    """The levels of blocks, lowest first, and the one node of each group above them."""
    levels = []
    while not nodes.where("n > 1").isEmpty():
        levels.append(staged(_blocks(nodes, bits)))
        nodes = levels[-1].where("root IS NOT NULL").select(
            *GROUP, F.shiftright("at", bits).alias("at"),
            F.ceil(F.col("n") / (1 << bits)).cast("long").alias("n"), F.col("root").alias("digest"),
        )
    return levels, nodes


def _descend(levels: list[DataFrame], tops: DataFrame, passed: list[str], bits: int) -> DataFrame:
    """The lowest level with its whole witnesses and the columns ``passed`` of its group's top."""
    for level in reversed(levels):
        above = tops.select(*GROUP, F.col("at").alias("_block"), F.col("witness").alias("_above"), *passed)
        met = level.drop("root").withColumn("_block", F.shiftright("at", bits)).join(above, [*GROUP, "_block"])
        tops = met.withColumn("witness", F.concat("witness", "_above")).drop("_block", "_above")
    return tops


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        names = ("given", "at", "n", "top_at", "top_n", "witness")
        for given, at, n, top_at, top_n, witness in zip(*(batch.column(c).to_pylist() for c in names)):
            siblings = iter([witness[k : k + DIGEST] for k in range(0, len(witness), DIGEST)])
            found.append(fold(fold(given, at, n, siblings), top_at, top_n, siblings))
        own = [c for c, name in zip(batch.columns, batch.schema.names) if name not in names]
        keep = [name for name in batch.schema.names if name not in names]
        proof = pa.array([sha256(w.hex().encode()).hexdigest() for w in batch.column("witness").to_pylist()])
        yield pa.RecordBatch.from_arrays([*own, proof, pa.array(found, pa.binary())], names=[*keep, "proof_sha256", "folded"])


def leaf_digest(values: list[Column]) -> Column:
    """The digest of a row: each value as its UTF-8 byte count, a colon and the text, null as -."""
    texts = [v.cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def witnesses(leaves: DataFrame, bits: int = BITS) -> DataFrame:
    """``leaves`` (known, grp, digest, ..) in the order of (doc, digest) with at and n in their
    group, subroot, root, top_at, top_n, and witness: the siblings up to the root, joined."""
    levels, groups = _climb(numbered(leaves, ["doc", "digest"]), bits)
    groups = staged(groups)
    # The top tree is one group, whose nodes are the groups.
    nodes = groups.select(
        F.lit(True).alias("known"), F.lit("").alias("grp"), F.struct(*GROUP).alias("group"), "digest",
    )
    top_levels, top = _climb(numbered(nodes, ["group"]), bits)
    empty = F.lit(b"")
    tops = top.withColumn("witness", empty).withColumn("root", F.col("digest"))
    tops = _descend([lv.drop("root") for lv in top_levels], tops, ["root"], bits)
    tops = staged(tops.select("group.*", F.col("digest").alias("subroot"), "root",
                              F.col("at").alias("top_at"), F.col("n").alias("top_n"), "witness"))
    passed = ["subroot", "root", "top_at", "top_n"]
    return _descend(levels, groups.join(tops, GROUP), passed, bits)


def manifest(
    docs: DataFrame, id_column: str = "doc_id", group_column: str = "lang",
    columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    given: dict[str, Column] | None = None, bits: int = BITS,
) -> DataFrame:
    """One row per document: id, leaf, subroot, root, proof_sha256, folded_root, verified.

    A leaf is the digest of ``columns``. Leaves of equal ``group_column`` form a tree in ascending
    order of the id, null first, ties by leaf; its root is ``subroot``. The roots of the groups,
    ordered by group, null first, form the tree of ``root``. ``proof_sha256`` is the digest of the
    leaf's siblings. ``folded_root`` is what the row as it is now gives with these siblings, where ``given`` says
    which columns differ now; ``verified`` whether that is the root. Nulls count as the value -,
    repeated rows are leaves of their own, and one leaf is its own root. An empty table gives no row;
    further columns are ignored, whatever their names.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    was = leaf_digest([F.col(c) for c in columns])
    now = was
    if given:
        changed = reduce(Column.__or__, (~F.col(c).eqNullSafe(value) for c, value in given.items()))
        now = F.when(changed, leaf_digest([given.get(c, F.col(c)) for c in columns])).otherwise(was)
    leaves = docs.select(
        F.col(group_column).isNotNull().alias("known"), F.coalesce(F.col(group_column).cast("string"), F.lit("")).alias("grp"),
        F.col(id_column).alias("doc"), was.alias("digest"), now.alias("given"),
    )
    found = witnesses(staged(leaves), bits)

    def text(column: str) -> Column:
        return F.lower(F.hex(column)).alias(column)

    rows = found.select("doc", F.col("digest").alias("leaf"), "subroot", "root",
                        "given", "at", "n", "top_at", "top_n", "witness")
    rows = rows.mapInArrow(
        _folded, f"doc {kind}, leaf binary, subroot binary, root binary, proof_sha256 string, folded binary"
    )
    return rows.select(
        F.col("doc").alias(id_column), text("leaf"), text("subroot"), text("root"), "proof_sha256",
        F.lower(F.hex("folded")).alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"),
    )
