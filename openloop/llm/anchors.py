"""Repeated windows of a corpus by anchors: what the two substring operators share.

A window is a fixed number of consecutive units (bytes, words) of one document. An operator says
which anchor each window chooses, by a rule that looks at the window's own content only; equal
windows then have equal anchors, and nothing else needs to be compared. Consecutive windows with
the same anchor make one record: its key is a hash of the anchor, its context the units its
windows cover.

1. Records with the same key and the same context fold to the earliest one, first within each
   scan task, then by key; all windows of the others are repeats. Only hashes move.
2. Where a key has several contexts, the contexts themselves are fetched and the operator's
   resolver finds the windows that repeat among them.
3. A key with more contexts than HOT is resolved by windows instead: digests of its windows fold
   to the earliest start, so no task ever holds such a group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from openloop.functions.durable import staged
from openloop.llm.texts import text_bytes

#: Bytes of text whose records a scan task folds at a time.
FOLD_BYTES = 8 << 20
#: Contexts of one key that one task resolves.
HOT = 20_000

#: Order of documents: known ids first, then the id, then the hash of the text.
WHO = ["nul", "doc", "th"]
KEYED = "nul boolean, doc long, th long"


@dataclass(frozen=True)
class Kind:
    """``units`` cuts a text; ``anchors(units)`` gives arrays (key, anchor, first, last): the
    windows first..last choose the anchor; ``part(units, a, b)`` is the content of units a..b-1
    as bytes-like; ``resolve`` takes contexts (key, units) in document order and yields for each
    batch (index of the context, first and last of a run of repeated windows)."""

    window: int
    units: Callable[[bytes], object]
    anchors: Callable[[object], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    part: Callable[[object, int, int], object]
    digestible: Callable[[object], object]
    resolve: Callable[[Iterator[tuple]], Iterator[tuple[tuple, int, int]]]


def keyed(docs: DataFrame, id_column: str, text_column: str) -> tuple[DataFrame, DataFrame]:
    """(all rows, different documents) as (nul, doc, th, id, text). ``doc`` orders documents as
    their ids do: it is the id where that is a whole number, else its rank. The hash of the text
    is needed to tell documents apart only where ids repeat or are unknown."""
    ident = F.col(id_column)
    docs = docs.select(ident, F.col(text_column))
    whole = docs.schema[id_column].dataType.typeName() in ("byte", "short", "integer", "long")
    if whole:
        docs = docs.withColumn("_rank", ident.cast("long"))
    else:
        known = docs.select(ident.alias("_id")).where("_id IS NOT NULL").distinct()
        ranked = known.repartitionByRange("_id").sortWithinPartitions("_id")
        ranked = staged(ranked.withColumn("_rank", F.monotonically_increasing_id()))
        docs = docs.join(ranked, ident == F.col("_id"), "left").drop("_id")
    ids = docs.select(ident.alias("id")).groupBy("id").count()
    repeated = not ids.where("count > 1").isEmpty()
    rows = docs.select(
        ident.isNull().alias("nul"), F.coalesce("_rank", F.lit(0).cast("long")).alias("doc"),
        (F.xxhash64(F.col(text_column)) if repeated else F.lit(0).cast("long")).alias("th"),
        ident.alias("id"), text_bytes(F.col(text_column)).alias("text"),
    )
    return rows, rows.dropDuplicates(WHO) if repeated else rows


def _columns(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(n).to_numpy(zero_copy_only=False) for n in names]


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v) for v in columns.values()], names=list(columns))


def _records(kind: Kind, limit: int):
    """Records of a scan task. ``open`` ones are the earliest with their key and context among
    ``limit`` bytes of text; the others are given as spans of repeated units, already merged."""

    def folded(docs: list[tuple], parts: list[tuple]) -> pa.RecordBatch | None:
        if not parts:
            return None
        rank = {who: n for n, who in enumerate(sorted(range(len(docs)), key=docs.__getitem__))}
        of = np.concatenate([np.full(len(p[1]), p[0]) for p in parts])
        key, digest, more, first, last = (np.concatenate([p[k] for p in parts]) for k in (1, 2, 3, 4, 5))
        place = np.array([rank[d] for d in range(len(docs))])[of]
        order = np.lexsort((first, place, more, digest, key))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (np.diff(key[order]) != 0) | (np.diff(digest[order]) != 0) | (np.diff(more[order]) != 0)
        is_open = np.zeros(len(order), dtype=bool)
        is_open[order[new]] = True
        # Spans of a document that follow one another become one; they need no partner, so any key.
        begins = ~is_open
        begins[1:] &= is_open[:-1] | (of[1:] != of[:-1])
        span = np.cumsum(begins)[~is_open]
        ends = last.copy()
        if len(span):
            at = np.flatnonzero(begins)
            tops = np.zeros(len(at), dtype=last.dtype)
            np.maximum.at(tops, span - 1, last[~is_open])
            ends[at] = tops
            names = np.array([d[1] for d in docs], dtype=np.int64)[of[at]]
            key[at] = (names * 0x1E3779B97F4A7C15) ^ (first[at] * 0x52DCE729)
        keep = is_open | begins
        of = of[keep]
        nul, doc, th = (np.array([d[k] for d in docs])[of] for k in range(3))
        return _batch(
            open=is_open[keep], key=key[keep], digest=digest[keep], more=more[keep], nul=nul, doc=doc, th=th,
            first=first[keep].astype(np.int32), last=ends[keep].astype(np.int32),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, parts, size = [], [], 0
        for batch in batches:
            for nul, doc, th, text in zip(*(batch.column(n).to_pylist() for n in (*WHO, "text"))):
                units = kind.units(text)
                if len(units) < kind.window:
                    continue
                key, anchor, first, last = kind.anchors(units)
                held = kind.digestible(units)
                # 128 bits of the whole context, seeded by where the anchor lies in it.
                digest = b"".join([
                    xxhash.xxh3_128_digest(held[a : b + kind.window], p)
                    for a, b, p in zip(first.tolist(), last.tolist(), (anchor - first).tolist())
                ])
                digest = np.frombuffer(digest, np.int64).reshape(-1, 2)
                parts.append((len(docs), key.view(np.int64).copy(), digest[:, 0], digest[:, 1], first, last))
                docs.append((nul, doc, th))
                size += len(text)
                if size >= limit:
                    yield folded(docs, parts)
                    docs, parts, size = [], [], 0
        if parts:
            yield folded(docs, parts)

    return run


def _by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of records sorted by key, context and document order: repeats become spans, the earliest
    of each context stays open if its key has another context. Holds one record between batches."""
    names = ("open", "key", "digest", "more", *WHO, "first", "last")
    last_key = last_digest = last_more = None
    waiting: list[tuple] = []
    for batch in batches:
        cols = dict(zip(names, _columns(batch, *names)))
        key, is_open = cols["key"], cols["open"].astype(bool)
        at = np.flatnonzero(is_open)
        k, d, m = key[at], cols["digest"][at], cols["more"][at]
        owner = np.zeros(len(at), dtype=bool)
        if len(at):
            owner[1:] = (k[1:] != k[:-1]) | (d[1:] != d[:-1]) | (m[1:] != m[:-1])
            owner[0] = (k[0], d[0], m[0]) != (last_key, last_digest, last_more)
        owners = at[owner]
        wanted = np.zeros(len(key), dtype=bool)
        if len(owners):
            ok = key[owners]
            shared = np.zeros(len(owners), dtype=bool)
            shared[1:] |= ok[1:] == ok[:-1]
            shared[:-1] |= ok[1:] == ok[:-1]
            shared[0] |= ok[0] == last_key
            if waiting and ok[0] == last_key:
                yield _batch(**{n: np.array([v]) for n, v in zip(names, waiting[0])}).select(
                    ["open", "key", *WHO, "first", "last"]
                )
            waiting = []
            wanted[owners[shared]] = True
            if not shared[-1]:
                waiting = [tuple(cols[n][owners[-1]] for n in names)]
        if len(at):
            last_key, last_digest, last_more = k[-1], d[-1], m[-1]
        repeats = np.ones(len(key), dtype=bool)
        repeats[owners] = False
        keep = repeats | wanted
        cols["open"] = wanted
        yield _batch(**{n: cols[n][keep] for n in ("open", "key", *WHO, "first", "last")})


def _fetch(kind: Kind):
    """Contexts of a document's open records; of hot keys, the digests of their windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for nul, doc, th, text, wanted in zip(*(batch.column(n).to_pylist() for n in (*WHO, "text", "wanted"))):
                units = kind.units(text)
                held = kind.digestible(units)
                for w in wanted:
                    who, first, last = (w["key"], nul, doc, th), w["first"], w["last"]
                    if w["hot"]:
                        for s in range(first, last + 1):
                            digest = xxhash.xxh3_128_digest(held[s : s + kind.window])
                            out.append((*who, s, s, True, digest))
                    else:
                        out.append((*who, first, last, False, bytes(kind.part(units, first, last + kind.window))))
            for at in range(0, len(out), 20_000):
                columns = list(zip(*out[at : at + 20_000]))
                names = ("key", *WHO, "first", "last", "hot", "content")
                types = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=list(names))

    return run


def _resolve(kind: Kind):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def contexts():
            for batch in batches:
                yield from zip(*(batch.column(n).to_pylist() for n in ("key", *WHO, "first", "content")))

        held: list[tuple] = []
        for who, a, b in kind.resolve(contexts()):
            held.append((*who[1:4], who[4] + a, who[4] + b))
            if len(held) >= 20_000:
                yield packed(held)
                held = []
        if held:
            yield packed(held)

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        types = (pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=[*WHO, "first", "last"]
        )

    return run


def repeated_windows(texts: DataFrame, kind: Kind, hot: int = HOT, fold_bytes: int = FOLD_BYTES) -> DataFrame:
    """(nul, doc, th, first, last): runs of window starts that also start earlier. ``texts`` are
    different documents as :func:`keyed` gives them."""
    record = f"open boolean, key long, digest long, more long, {KEYED}, first int, last int"
    found = texts.select(*WHO, "text").mapInArrow(_records(kind, fold_bytes), record)
    found = found.repartition("key").sortWithinPartitions("key", "digest", "more", *WHO, "first")
    found = staged(found.mapInArrow(_by_key, f"open boolean, key long, {KEYED}, first int, last int"))
    runs = [found.where("NOT open").select(*WHO, "first", "last")]
    asked = found.where("open").drop("open")
    crowded = staged(asked.groupBy("key").count().where(F.col("count") > hot).select("key"))
    some_hot = not crowded.isEmpty()
    if some_hot:
        marks = crowded.withColumn("hot", F.lit(True))
        asked = asked.join(marks, "key", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    else:
        asked = asked.withColumn("hot", F.lit(False))
    asked = asked.groupBy(*WHO).agg(F.collect_list(F.struct("key", "first", "last", "hot")).alias("wanted"))
    content = texts.select(*WHO, "text").join(asked, WHO).mapInArrow(
        _fetch(kind), f"key long, {KEYED}, first int, last int, hot boolean, content binary"
    )
    if some_hot:
        content = staged(content)
        windows = content.where("hot").withColumn("start", F.struct(*WHO, "first"))
        earliest = windows.groupBy("key", "content").agg(F.min("start").alias("earliest"))
        later = windows.join(earliest, ["key", "content"]).where("start > earliest")
        runs.append(later.select(*WHO, "first", "last"))
        content = content.where("NOT hot")
    rows = content.repartition("key").sortWithinPartitions("key", *WHO, "first")
    runs.append(rows.mapInArrow(_resolve(kind), f"{KEYED}, first int, last int"))
    return staged(reduce(DataFrame.union, runs))


def cut_repeats(docs: DataFrame, kind: Kind, join: Callable[[object, np.ndarray], bytes], id_column: str,
                text_column: str, hot: int = HOT, fold_bytes: int = FOLD_BYTES) -> DataFrame:
    """One row per document: id, n_units, n_removed, spans (array of (start, end) of the maximal
    removed runs of units), kept (bytes of what is left, as ``join`` puts it together)."""
    rows, texts = keyed(docs, id_column, text_column)
    runs = repeated_windows(texts, kind, hot, fold_bytes)
    runs = runs.groupBy(*WHO).agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    joined = rows.join(runs, WHO, "left").select("id", "text", "runs")
    schema = pa.struct([("start", pa.int32()), ("end", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, spans, kept = [], [], [], []
            for text, repeats in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist()):
                units = kind.units(text)
                mark = np.zeros(len(units) + 1, dtype=np.int32)
                for r in repeats or ():
                    mark[r["first"]] += 1
                    mark[r["last"] + kind.window] -= 1
                gone = np.cumsum(mark) > 0
                edges = np.flatnonzero(np.diff(np.concatenate([[False], gone[:-1], [False]]))).reshape(-1, 2)
                sizes.append(len(units))
                removed.append(int(gone.sum()))
                spans.append([{"start": a, "end": b} for a, b in edges.tolist()])
                kept.append(join(units, gone[:-1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(spans, pa.list_(schema)), pa.array(kept, pa.binary())],
                names=["id", "n_units", "n_removed", "spans", "kept"],
            )

    kind_of_id = docs.schema[id_column].dataType.simpleString()
    out = joined.mapInArrow(
        run, f"id {kind_of_id}, n_units long, n_removed long, spans array<struct<start:int,end:int>>, kept binary"
    )
    return out.withColumnRenamed("id", id_column)
