"""Near copies by exact Jaccard similarity, found by SimHash deletion variants.

A fingerprint of four words of 64 bits is cut into segments of sixteen bits. Two
fingerprints meet where a segment is equal or differs in one bit: a segment is indexed as it is and
with each of its bits masked. The first bits of a segment say which task it goes to, so only these
are masked before the shuffle, the others within the task. What meets at ``DISTANCE`` or fewer of
256 bits is a candidate. Candidates only decide which texts are brought together; whether two of
them are near copies is decided by their shingles.

Segments widen with the number of fingerprints, so that no more of them meet by chance at larger
sizes. Wider ones agree less often, so the bits are cut again in other orders, until near copies
are expected to meet as often as ``RECALL`` asks (:func:`cut_for`).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from openloop.functions.durable import staged
from openloop.llm.components import components
from openloop.llm.large_groups import kept_of_large
from openloop.llm.texts import text_bytes

WORDS = ["w0", "w1", "w2", "w3"]
BITS, SEGMENT = 256, 16
#: Differing bits of candidates: at Jaccard 0.8 about 39 of 256 are expected, 6 the deviation.
DISTANCE = 60
#: Fingerprints expected in one bucket of equal segments; beyond that segments are wider.
BUCKET = 1 << 12
#: Share of the pairs at Jaccard 0.8 that are expected to meet.
RECALL = 0.99
#: Fingerprints that should meet in one task; more of them are dealt out by more bits.
TOGETHER = 1 << 18
#: Runs of equal masked segments up to here are compared pair by pair, longer ones by search.
RUN = 32
#: Nodes whose sets a task remembers.
FOREST = 500_000
#: Shingles of the different sets of a group that one task compares; larger groups are dealt out.
ROOM = 1 << 20
#: Shingles that are turned into bits at a time.
BLOCK = 1 << 14


def shingles(text: bytes, width: int) -> set[bytes]:
    """The distinct ``width``-word shingles of the lower-cased text; all its words where they are
    fewer, nothing without words."""
    words = text.lower().split()
    if len(words) < width:
        return {b" ".join(words)} if words else set()
    return set(map(b" ".join, zip(*(words[k:] for k in range(width)))))


def fingerprint(found: set[bytes]) -> np.ndarray:
    """The four words of the SimHash of a set of shingles; zero for the empty set."""
    ones, block = np.zeros(256, dtype=np.int64), []

    def count() -> None:
        bits = np.frombuffer(b"".join(block), np.uint8).reshape(-1, 32)
        np.add(ones, np.unpackbits(bits, axis=1, bitorder="little").sum(axis=0, dtype=np.int64), out=ones)
        block.clear()

    for shingle in found:
        block.append(xxhash.xxh3_128_digest(shingle, 1) + xxhash.xxh3_128_digest(shingle, 2))
        if len(block) == BLOCK:
            count()
    if block:
        count()
    return np.packbits(ones * 2 > len(found), bitorder="little").view(np.uint64)


def _nodes(words: np.ndarray) -> np.ndarray:
    """One number for each fingerprint. Two that share one are brought together, no more."""
    mixed = np.zeros(len(words), np.uint64)
    for k in range(words.shape[1]):
        mixed = (mixed ^ words[:, k]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return mixed.view(np.int64)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    columns = [batch.column(w).to_numpy(zero_copy_only=False).view(np.uint64) for w in WORDS]
    return np.stack(columns, axis=1)


@cache
def _order(turn: int) -> np.ndarray:
    """The order in which the bits are cut for the ``turn``-th time; as they stand at first."""
    return np.random.default_rng(turn).permutation(BITS) if turn else np.arange(BITS)


@dataclass(frozen=True)
class Cut:
    """How fingerprints are cut: ``segments`` of ``width`` bits, as many of them in each order of
    the bits as it has room for."""

    width: int = SEGMENT
    segments: int = BITS // SEGMENT

    def bits(self, number: int) -> np.ndarray:
        """The bits of a segment, its lowest first."""
        turn, place = divmod(number, BITS // self.width)
        return _order(turn)[place * self.width : (place + 1) * self.width]


@cache
def _missing(width: int, segments: int) -> list[int]:
    """In how many ways 0, 1, .. differing bits can leave each of ``segments`` segments of one order
    of the bits with two of them or more."""
    two_or_more = [math.comb(width, k) if k > 1 else 0 for k in range(DISTANCE + 1)]
    ways = np.array([math.comb(BITS - segments * width, k) for k in range(DISTANCE + 1)], dtype=object)
    for _ in range(segments):
        ways = np.convolve(ways, np.array(two_or_more, dtype=object))[: DISTANCE + 1]
    return ways.tolist()


def expected_recall(cut: Cut, similarity: float = 0.8) -> float:
    """The share of pairs of this similarity that agree in a segment of ``cut`` but for one bit and
    differ in at most ``DISTANCE`` bits. A bit differs with a chance of angle / pi of the sets."""
    differs = math.acos(2 * similarity / (1 + similarity)) / math.pi
    turns, rest = divmod(cut.segments, BITS // cut.width)
    each, last = _missing(cut.width, BITS // cut.width), _missing(cut.width, rest)
    share = 0.0
    for d in range(DISTANCE + 1):
        ways = math.comb(BITS, d)
        missed = (each[d] / ways) ** turns * (last[d] / ways)
        share += ways * differs**d * (1 - differs) ** (BITS - d) * (1 - missed)
    return share


def cut_for(fingerprints: int, bucket: int = BUCKET) -> Cut:
    """The cut whose buckets are expected to hold at most ``bucket`` of so many fingerprints. The
    shares of :func:`expected_recall` say how many segments it needs."""
    width = max(SEGMENT, (max(0, fingerprints - 1) // bucket).bit_length())
    segments = BITS // SEGMENT
    while expected_recall(Cut(width, segments)) < RECALL:
        segments += 1
    return Cut(width, segments)


def _segment(words: np.ndarray, number: int, cut: Cut = Cut()) -> np.ndarray:
    bits = cut.bits(number).tolist()
    low, high = bits[0], bits[-1]
    if bits == list(range(low, high + 1)) and low // 64 == high // 64:
        return (words[:, low // 64] >> np.uint64(low % 64)).astype(np.int64) & ((1 << cut.width) - 1)
    value = np.zeros(len(words), np.uint64)
    for place, bit in enumerate(bits):
        value |= ((words[:, bit // 64] >> np.uint64(bit % 64)) & np.uint64(1)) << np.uint64(place)
    return value.astype(np.int64)


def _fingerprints(docs: DataFrame, id_column: str, text_column: str, width: int) -> DataFrame:
    """(id, tie, node, w0..w3): one row per document, ``tie`` the hash of its text."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [fingerprint(shingles(t.as_py(), width)) for t in batch.column(2)]
            words = np.array(rows, dtype=np.uint64).reshape(-1, 4)
            signed = [pa.array(np.ascontiguousarray(words[:, k]).view(np.int64)) for k in range(4)]
            found = [batch.column(0), batch.column(1), pa.array(_nodes(words)), *signed]
            yield pa.RecordBatch.from_arrays(found, names=["id", "tie", "node", *WORDS])

    text = F.col(text_column)
    rows = docs.select(F.col(id_column).alias("id"), F.xxhash64(text).alias("tie"), text_bytes(text).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, tie long, node long, w0 long, w1 long, w2 long, w3 long")


def _dealt(first: int, cut: Cut):
    """A row for each segment and each of its ``first`` bits masked, or none. The key holds the
    segment, one more than the masked bit, and the first bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = _matrix(batch)
            for number in range(cut.segments):
                top = _segment(words, number, cut) >> (cut.width - first)
                for bit in range(-1, first):
                    rest = top & ~(1 << bit) if bit >= 0 else top
                    key = pa.array(((number * (cut.width + 1) + bit + 1) << cut.width) | rest)
                    columns = [key, *(batch.column(w) for w in WORDS)]
                    yield pa.RecordBatch.from_arrays(columns, names=["key", *WORDS])

    return run


def _near(words: np.ndarray, a, b) -> np.ndarray:
    return np.bitwise_count(words[a] ^ words[b]).sum(axis=-1, dtype=np.int64) <= DISTANCE


def _search(words: np.ndarray, members: np.ndarray) -> Iterator[tuple[int, int]]:
    """Links that connect what all links between ``members`` connect."""
    waiting = members
    while len(waiting):
        frontier, waiting = [waiting[0]], waiting[1:]
        while frontier and len(waiting):
            at = frontier.pop()
            near = _near(words, waiting, at)
            for found in waiting[near]:
                frontier.append(found)
                yield at, found
            waiting = waiting[~near]


def _met(words: np.ndarray, key: int, first: int, cut: Cut = Cut()) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links between the fingerprints of one key, as arrays of places."""
    number, bit = divmod(key >> cut.width, cut.width + 1)
    value = _segment(words, number, cut)
    low = cut.width - first
    if bit:
        masks = [1 << (low + bit - 1)]
    else:
        masks = [0, *(1 << k for k in range(low))]
    for mask in masks:
        rest = value & ~mask
        order = np.argsort(rest, kind="stable")
        rest, sides = rest[order], (value & mask)[order]
        bounds = np.flatnonzero(np.diff(rest, prepend=-1, append=-1))
        sizes = np.diff(bounds)
        length = np.repeat(sizes, sizes)
        short = length <= RUN
        for step in range(1, min(RUN, int(sizes.max(initial=1)))):
            pair = (rest[:-step] == rest[step:]) & short[:-step]
            if mask:  # equal sides meet where no bit is masked
                pair &= sides[:-step] != sides[step:]
            at = np.flatnonzero(pair)
            if len(at):
                a, b = order[at], order[at + step]
                near = _near(words, a, b)
                yield a[near], b[near]
        for k in np.flatnonzero(sizes > RUN):
            found = np.array(list(_search(words, order[bounds[k]:bounds[k + 1]])), dtype=np.int64).reshape(-1, 2)
            yield found[:, 0], found[:, 1]


def _by_key(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[tuple[object, list[pa.RecordBatch]]]:
    """(key, pieces) of batches that are sorted by the whole-number column ``name``."""
    held, pieces = None, []
    for batch in batches:
        keys = batch.column(name).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                if pieces and keys[a] != held:
                    yield held, pieces
                    pieces = []
                held = keys[a]
                pieces.append(batch.slice(a, b - a))
    if pieces:
        yield held, pieces


class Forest:
    """Sets of nodes that links have joined so far; over ``limit`` nodes it begins anew, after
    which a link may be told again."""

    def __init__(self, limit: int = FOREST) -> None:
        self.above: dict[int, int] = {}
        self.limit = limit

    def _top(self, node: int) -> int:
        top = node
        while (up := self.above.get(top, top)) != top:
            top = up
        while node != top:
            self.above[node], node = top, self.above[node]
        return top

    def joining(self, pairs: Iterator[tuple[int, int]]) -> list[tuple[int, int]]:
        """The pairs that join two sets; of links that connect n nodes, n - 1."""
        if len(self.above) > self.limit:
            self.above.clear()
        new = []
        for a, b in pairs:
            left, right = self._top(a), self._top(b)
            if left != right:
                self.above[left] = self.above[right] = min(left, right)
                new.append((a, b))
        return new


def _links(fps: DataFrame, together: int) -> DataFrame:
    """(a, b) links of nodes that connect all candidates among ``fps``. A task gives out only what
    joins two sets of nodes, over all the keys it has, so at most as many links as nodes."""
    different = fps.count()
    cut = cut_for(different)
    first = min(cut.width, max(2, (different // together).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        for key, pieces in _by_key(batches, "key"):
            words = np.concatenate([_matrix(p) for p in pieces])
            nodes = _nodes(words)
            found = [np.stack([nodes[a], nodes[b]], axis=1) for a, b in _met(words, int(key), first, cut) if len(a)]
            if found:
                pairs = np.unique(np.sort(np.concatenate(found), axis=1), axis=0)
                joining = np.array(forest.joining(pairs.tolist()), dtype=np.int64).reshape(-1, 2)
                if len(joining):
                    columns = [pa.array(np.ascontiguousarray(joining[:, k])) for k in (0, 1)]
                    yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])

    rows = fps.select(*WORDS).mapInArrow(_dealt(first, cut), "key long, w0 long, w1 long, w2 long, w3 long")
    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(run, "a long, b long")


def numbers(found: set[bytes]) -> np.ndarray:
    """A set of shingles as ascending 64-bit hashes."""
    return np.unique(np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found)))


def similar_groups(sets: list[np.ndarray], least: Fraction) -> list[int]:
    """A number for each set (ascending :func:`numbers`), equal where a chain of sets at Jaccard
    ``least`` or more joins them. Empty sets are equal to each other."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    names, members = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(sizes)
    group = np.full(len(sets), -1)
    group[sizes == 0] = len(sets)
    marked = np.zeros(len(names), dtype=bool)
    for seed in range(len(sets)):
        if group[seed] >= 0:
            continue
        group[seed], frontier = seed, [seed]
        while frontier and (group < 0).any():
            at = frontier.pop()
            own = members[ends[at] - sizes[at]:ends[at]]
            marked[own] = True
            shared = np.diff(np.concatenate([[0], np.cumsum(marked[members])])[ends], prepend=0)
            marked[own] = False
            joined = shared * least.denominator >= least.numerator * (sizes + sizes[at] - shared)
            new = np.flatnonzero(joined & (group < 0))
            group[new] = seed
            frontier += new.tolist()
    return group.tolist()


def _sets(rows: DataFrame, kind: str, width: int) -> DataFrame:
    """(group, id, tie, mark, n, shingles) of (group, id, tie, text): the set of a text as packed
    64-bit hashes, its digest and its size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [numbers(shingles(t.as_py(), width)).tobytes() for t in batch.column(3)]
            marks = [xxhash.xxh3_128_digest(p) for p in packed]
            sizes = pa.array([len(p) // 8 for p in packed], pa.int64())
            own = [pa.array(marks, pa.binary()), sizes, pa.array(packed, pa.binary())]
            names = ["group", "id", "tie", "mark", "n", "shingles"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *own], names=names)

    return rows.mapInArrow(run, f"group long, id {kind}, tie long, mark binary, n long, shingles binary")


def _surplus(rows: DataFrame, kind: str, width: int, least: Fraction, room: int) -> DataFrame:
    """(id, tie) of the rows (group, id, tie, text) that are not the first of their near copies.

    Equal sets of a group fold to one row before they move. A task compares the different sets of
    one group where they have at most ``room`` shingles, eight bytes each; of larger groups no
    task holds more than ``room`` and the pivots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, pieces in _by_key(batches, "group"):
            table = pa.Table.from_batches(pieces)
            groups = similar_groups([np.frombuffer(s.as_py(), np.uint64) for s in table["shingles"]], least)
            first: dict[int, object] = {}
            for g, i in zip(groups, table["first"].to_pylist()):
                if i is not None:
                    first[g] = min(first.get(g, i), i)
            kept = pa.array([first.get(g) for g in groups], table.schema.field("first").type)
            found = table.select(["group", "mark"]).append_column("kept", kept)
            yield from found.combine_chunks().to_batches()

    sets = staged(_sets(rows, kind, width))
    folded = sets.groupBy("group", "mark").agg(F.min("id").alias("first"), F.any_value("shingles").alias("shingles"))
    sizes = sets.groupBy("group", "mark").agg(F.any_value("n").alias("n")).groupBy("group").agg(F.sum("n").alias("size"))
    large = staged(sizes.where(F.col("size") > room))
    some = not large.isEmpty()
    whole = folded.join(large, "group", "left_anti") if some else folded
    whole = whole.repartition("group").sortWithinPartitions("group")
    kept = whole.mapInArrow(run, f"group long, mark binary, kept {kind}")
    if some:
        kept = kept.union(kept_of_large(staged(folded.join(large, "group", "left_semi")), large, room, least))
    met = sets.select("group", "mark", "id", "tie").join(kept, ["group", "mark"])
    return met.where(~F.col("id").eqNullSafe(F.col("kept"))).select("id", "tie")


def keep_one_of_similar(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    width: int = 5, least: Fraction = Fraction(4, 5), together: int = TOGETHER,
    room: int = ROOM,
) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their near copies, with all their columns.

    Two texts are near copies where the sets of ``width``-word shingles of the whole lower-cased
    texts have a Jaccard similarity of ``least`` or more, and so are texts that a chain of near
    copies joins. A text of fewer words is one shingle; null, empty and blank texts are equal. Rows
    with a null id stay where no near copy has an id. Rows that share id and text stay or go
    together. Candidates are found by fingerprint, so some near copies can be missed (the README
    gives measured misses); no others are linked.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    prints = staged(_fingerprints(docs, id_column, text_column, width))
    nodes = staged(prints.groupBy("node").agg(F.count("*").alias("n"), *(F.min(w).alias(w) for w in WORDS)))
    roots = components(_links(nodes, together), "a", "b").withColumnRenamed("node", "linked")
    several = nodes.select("node", "n").join(roots, F.col("node") == F.col("linked"), "left")
    several = several.where("n > 1 OR root IS NOT NULL").select("node", F.coalesce("root", "node").alias("group"))
    wanted = staged(prints.join(several, "node").select("id", "tie", "group").distinct())
    text = docs.select(
        F.col(id_column).alias("d"), F.xxhash64(text_column).alias("t"), text_bytes(F.col(text_column)).alias("text")
    )
    same = F.col("d").eqNullSafe(F.col("id")) & (F.col("t") == F.col("tie"))
    surplus = staged(_surplus(wanted.join(text, same).select("group", "id", "tie", "text"), kind, width, least, room))
    gone = surplus.select(F.col("id").alias("_gone_id"), F.col("tie").alias("_gone_tie")).distinct()
    found = docs[id_column].eqNullSafe(gone["_gone_id"]) & (F.xxhash64(docs[text_column]) == gone["_gone_tie"])
    return docs.join(gone, found, "left_anti")
