"""Exact duplicates: compressed radix tries own the texts of a (length, content hash) range.

A first pass folds the texts of each scan task in a trie, so a text with any number of copies
leaves a task once. The second pass gets the folded texts partitioned and sorted by length and
content hash; all strings of one (length, hash) form a subtree that is complete, and released,
when the next one begins. Both tries compare full byte strings; hashes only route.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from openloop.llm.texts import SPACES

#: Bytes of labels that a trie of a scan task holds before it spills its largest subtree.
TRIE_BYTES = 32 << 20

FOLDED = "n_bytes int, text_hash long, normal binary, keep_id {id}, group_size long"


def _shared(left: bytes, right: bytes) -> int:
    """Length of the common prefix, found by halving over slices."""
    high = min(len(left), len(right))
    if left[:high] == right[:high]:
        return high
    low = 0
    while high - low > 1:
        middle = (low + high) // 2
        if left[low:middle] == right[low:middle]:
            low = middle
        else:
            high = middle
    return low


class _Node:
    """``owner`` is None, or [smallest id, rows, hash] of the string that ends here."""

    __slots__ = ("label", "children", "owner")

    def __init__(self, label: bytes, owner: list | None):
        self.label, self.owner, self.children = label, owner, {}


class Trie:
    """A Patricia trie over byte strings. It holds labels only, ``held`` bytes of them: a string
    is put together again when it is taken out."""

    def __init__(self) -> None:
        self.root = _Node(b"", None)
        self.held = 0

    def add(self, text: bytes, ident, rows: int, text_hash: int = 0) -> None:
        node, at = self.root, 0
        while at < len(text):
            child = node.children.get(text[at])
            if child is None:
                node.children[text[at]] = _Node(text[at:], [ident, rows, text_hash])
                self.held += len(text) - at
                return
            if not text.startswith(child.label, at):
                cut = _shared(child.label, text[at : at + len(child.label)])
                upper = _Node(child.label[:cut], None)
                child.label = child.label[cut:]
                upper.children[child.label[0]] = child
                node.children[text[at]] = child = upper
            node, at = child, at + len(child.label)
        if node.owner is None:
            node.owner = [ident, rows, text_hash]
            return
        held = node.owner
        held[1] += rows
        if ident is not None and (held[0] is None or ident < held[0]):
            held[0] = ident

    def pop(self, first: int | None = None) -> Iterator[tuple[bytes, list]]:
        """Takes out all strings, or those of the root's subtree that begins with ``first``."""
        if first is None:
            top, self.root, self.held = self.root, _Node(b"", None), 0
        else:
            top = self.root.children.pop(first)
        stack = [(top, b"")]
        while stack:
            node, before = stack.pop()
            text = before + node.label
            if first is not None:
                self.held -= len(node.label)
            if node.owner is not None:
                yield text, node.owner
            stack.extend((child, text) for child in node.children.values())

    def largest(self) -> int:
        """First byte of the root's subtree with the most bytes of labels."""

        def weight(node: _Node) -> int:
            total, stack = 0, [node]
            while stack:
                node = stack.pop()
                total += len(node.label)
                stack.extend(node.children.values())
            return total

        return max(self.root.children, key=lambda byte: weight(self.root.children[byte]))


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Record batches of a few MB."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[2]) + 64
        if size > 4 << 20:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*held), schema.types)), schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*held), schema.types)), schema=schema)


def _schema(batch: pa.RecordBatch) -> pa.Schema:
    return pa.schema(
        [("n_bytes", pa.int32()), ("text_hash", pa.int64()), ("normal", pa.binary()),
         ("keep_id", batch.schema.field("keep_id").type), ("group_size", pa.int64())]
    )


def _fold_scan(limit: int):
    """Folds equal texts of one task; over ``limit`` the trie spills its largest subtree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, schema = Trie(), None

        def released(pairs):
            for text, (ident, rows, text_hash) in pairs:
                yield len(text), text_hash, text, ident, rows

        for batch in batches:
            schema = _schema(batch)
            columns = (batch.column(n).to_pylist() for n in ("text_hash", "normal", "keep_id"))
            for text_hash, text, ident in zip(*columns):
                trie.add(text, ident, 1, text_hash)
                if trie.held > limit:
                    yield from _batches(released(trie.pop(trie.largest())), schema)
        if schema is not None:
            yield from _batches(released(trie.pop()), schema)

    return run


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Folds what all tasks found; the input is sorted by (length, hash)."""

    schema = None

    def owners():
        nonlocal schema
        trie, at = Trie(), None
        for batch in batches:
            schema = _schema(batch)
            for n, text_hash, text, ident, rows in zip(*(c.to_pylist() for c in batch.columns)):
                if (n, text_hash) != at:
                    yield from ((*at, text, *owner[:2]) for text, owner in trie.pop() if at)
                    at = (n, text_hash)
                trie.add(text, ident, rows)
        yield from ((*at, text, *owner[:2]) for text, owner in trie.pop())

    rows = owners()
    first = next(rows, None)
    if first is not None:
        def every():
            yield first
            yield from rows

        yield from _batches(every(), schema)


def normalised(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, normal, n_bytes, text_hash, text_sha256); a null text counts as empty."""
    text = F.regexp_replace(F.coalesce(F.col(text_column), F.lit("")), SPACES, " ")
    return docs.select(F.col(id_column).alias("keep_id"), text.cast("binary").alias("normal")).select(
        "keep_id",
        "normal",
        F.octet_length("normal").alias("n_bytes"),
        F.xxhash64("normal").alias("text_hash"),
        F.sha2("normal", 256).alias("text_sha256"),
    )


def text_owners(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", limit: int = TRIE_BYTES
) -> DataFrame:
    """One row per different text: n_bytes, text_hash, normal (the normalised bytes), keep_id,
    group_size. ``keep_id`` is the smallest non-null id, null where all ids are null."""
    rows = normalised(docs, id_column, text_column).select("n_bytes", "text_hash", "normal", "keep_id")
    folded = FOLDED.format(id=docs.schema[id_column].dataType.simpleString())
    return (
        rows.mapInArrow(_fold_scan(limit), folded)
        .repartition("n_bytes", "text_hash")
        .sortWithinPartitions("n_bytes", "text_hash")
        .mapInArrow(_own, folded)
    )


def exact_dedup(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", limit: int = TRIE_BYTES
) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after each run of ASCII white space became one space; a null
    text counts as empty. The row with the smallest id stays. Repeated rows that tie for it are
    all kept; a null id stays only if no id of its group is known, and then with its ties. An
    empty table gives no row; further columns of ``docs`` are ignored, whatever their names.
    """
    owners = text_owners(docs, id_column, text_column, limit).select(
        "n_bytes", F.sha2("normal", 256).alias("text_sha256"), "keep_id", "group_size"
    )
    members = normalised(docs, id_column, text_column).select(
        F.col("keep_id").alias("member"), "n_bytes", "text_sha256"
    )
    return members.join(owners, ["n_bytes", "text_sha256"]).select(
        F.col("member").alias(id_column),
        "keep_id",
        "group_size",
        F.col("member").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def keep_first(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`exact_dedup` keeps, with all their columns."""
    kept = (
        exact_dedup(docs, id_column, text_column)
        .where("kept")
        .select(F.col(id_column).alias("_keep_id"), F.col("text_sha256").alias("_keep_text"))
        .distinct()
    )
    digest = F.sha2(
        F.regexp_replace(F.coalesce(docs[text_column], F.lit("")), SPACES, " ").cast("binary"), 256
    )
    same = docs[id_column].eqNullSafe(kept["_keep_id"]) & (digest == kept["_keep_text"])
    return docs.join(kept, same, "left_semi")
