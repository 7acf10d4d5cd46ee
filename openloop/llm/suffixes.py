"""Repeated byte strings by suffix arrays.

Windows of 100 bytes choose as anchor the 20 bytes with the smallest hash (the leftmost of equal
ones), so equal windows meet under the same key (see anchors). Where a key has several contexts,
they are sorted by two-stage suffix sorting: suffixes smaller than their successor are sorted
directly, all others are induced by one scan over the buckets of first bytes, and adjacent common
prefixes of at least 100 bytes mark the repeats.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
from pyspark.sql import DataFrame

from openloop.llm.anchors import FOLD_BYTES, HOT, Kind, cut_repeats

WINDOW = 100
GRAM = 20
#: Symbols that one suffix array covers, unless a single key needs more.
ARRAY = 1_500_000
#: Symbols of 9 bits in one 64-bit word.
PACK = 7


def grams(text: bytes) -> np.ndarray:
    """A 64-bit hash of each 20 consecutive bytes."""
    n = len(text) - GRAM + 1
    words = np.ndarray((len(text) - 7,), dtype="<u8", buffer=text, strides=(1,))
    h = words[:n] * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(31)
    h += words[8 : 8 + n] * np.uint64(0xC2B2AE3D27D4EB4F)
    h *= np.uint64(0x165667B19E3779F9)
    h ^= h >> np.uint64(29)
    h += words[12 : 12 + n] * np.uint64(0x27D4EB2F165667C5)
    h *= np.uint64(0x85EBCA77C2B2AE63)
    return h ^ (h >> np.uint64(32))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, by doubling."""
    count, size = len(values) - width + 1, 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[:count], values[width - size : width - size + count])


def chosen(smallest: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first, last): runs of windows that choose the same position, which the low half
    of ``smallest`` holds."""
    at = (smallest & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    last = np.append(first[1:], len(at)) - 1
    return at[first], first, last


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    h = grams(text)
    ordered = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    anchor, first, last = chosen(sliding_min(ordered, WINDOW - GRAM + 1))
    return h[anchor], anchor, first, last


def packed(symbols: np.ndarray) -> np.ndarray:
    """At each position the next seven symbols in one word whose order is theirs."""
    padded = np.concatenate([symbols, np.zeros(WINDOW + 2 * PACK, symbols.dtype)]).astype(np.uint64)
    words = np.zeros(len(symbols) + WINDOW + PACK, dtype=np.uint64)
    for k in range(PACK):
        words = words << np.uint64(9) | padded[k : k + len(words)]
    return words


def smaller_than_next(symbols: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its successor; the last one is."""
    n = len(symbols)
    rises = np.ones(n, dtype=bool)
    rises[:-1] = symbols[:-1] < symbols[1:]
    differs = np.ones(n, dtype=bool)
    differs[:-1] = symbols[:-1] != symbols[1:]
    following = np.where(differs, np.arange(n), n - 1)
    return rises[np.minimum.accumulate(following[::-1])[::-1]]


def _sorted_directly(starts: np.ndarray, words: np.ndarray) -> np.ndarray:
    """``starts`` by their first WINDOW symbols, a word at a time within groups still tied."""
    order = starts.copy()
    tied = np.arange(len(order))
    group = np.zeros(len(order), dtype=np.int64)
    for depth in range(0, WINDOW, PACK):
        word = words[order[tied] + depth]
        by = np.lexsort((word, group))
        order[tied] = order[tied][by]
        word, group = word[by], group[by]
        new = np.ones(len(tied), dtype=bool)
        new[1:] = (word[1:] != word[:-1]) | (group[1:] != group[:-1])
        group = np.cumsum(new)
        alone = new & np.append(new[1:], True)
        tied, group = tied[~alone], group[~alone]
        if not len(tied):
            break
    return order


def suffix_array(symbols: np.ndarray, words: np.ndarray | None = None) -> np.ndarray:
    """All suffixes in the order of their first WINDOW symbols (at least)."""
    words = packed(symbols) if words is None else words
    small = smaller_than_next(symbols)
    direct = _sorted_directly(np.flatnonzero(small), words)
    alphabet = int(symbols.max()) + 1
    bounds = np.searchsorted(symbols[direct], np.arange(alphabet + 1))
    waiting: list[list[np.ndarray]] = [[] for _ in range(alphabet)]
    done = []
    for c in range(alphabet):
        parts = [np.concatenate(waiting[c])] if waiting[c] else []
        while parts and len(parts[-1]):  # a run of c: its longer suffixes follow its shorter ones
            before = parts[-1] - 1
            before = before[before >= 0]
            parts.append(before[symbols[before] == c])
        parts.append(direct[bounds[c] : bounds[c + 1]])
        bucket = np.concatenate(parts)
        done.append(bucket)
        before = bucket - 1
        before = before[before >= 0]
        heads = symbols[before]
        before, heads = before[heads > c], heads[heads > c]
        by = np.argsort(heads, kind="stable")
        before, heads = before[by], heads[by]
        cuts = np.flatnonzero(np.diff(heads)) + 1
        for part in np.split(before, cuts) if len(before) else ():
            waiting[int(symbols[part[0]])].append(part)
    return np.concatenate(done)


def agree(left: np.ndarray, right: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Whether pairs of suffixes have a common prefix of at least WINDOW symbols."""
    same = np.ones(len(left), dtype=bool)
    live = np.arange(len(left))
    for depth in (*range(0, WINDOW - PACK, PACK), WINDOW - PACK):
        equal = words[left[live] + depth] == words[right[live] + depth]
        same[live[~equal]] = False
        live = live[equal]
    return same


def repeats(contexts: list[bytes]) -> Iterator[tuple[int, int, int]]:
    """(context, first, last): runs of windows that also start in an earlier context or earlier
    in the same one; contexts are in document order."""
    sizes = np.array([len(c) for c in contexts])
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    symbols = np.zeros(int(sizes.sum()) + len(sizes), dtype=np.uint16)
    for start, context in zip(starts.tolist(), contexts):
        symbols[start : start + len(context)] = np.frombuffer(context, dtype=np.uint8)
        symbols[start : start + len(context)] += 1
    words = packed(symbols)
    whole = np.zeros(len(symbols) + 1, dtype=np.int64)
    np.add.at(whole, starts, 1)
    np.add.at(whole, starts + np.maximum(sizes - WINDOW + 1, 0), -1)
    ordered = suffix_array(symbols, words)
    ordered = ordered[np.cumsum(whole)[ordered] > 0]
    if not len(ordered):
        return
    new = np.append(True, ~agree(ordered[:-1], ordered[1:], words))
    earliest = np.minimum.reduceat(ordered, np.flatnonzero(new))
    later = np.sort(ordered[ordered != earliest[np.cumsum(new) - 1]])
    if not len(later):
        return
    breaks = np.flatnonzero(np.diff(later) != 1) + 1
    first, last = later[np.append(0, breaks)], later[np.append(breaks - 1, len(later) - 1)]
    of = np.searchsorted(starts, first, side="right") - 1
    yield from zip(of.tolist(), (first - starts[of]).tolist(), (last - starts[of]).tolist())


def resolve(contexts: Iterator[tuple]) -> Iterator[tuple[tuple, int, int]]:
    """Whole keys are gathered until a suffix array is full."""
    held: list[tuple] = []
    size = 0

    def found():
        for index, first, last in repeats([c[-1] for c in held]):
            yield held[index], first, last

    for _, group in groupby(contexts, key=lambda c: c[0]):
        group = list(group)
        weight = sum(len(c[-1]) + 1 for c in group)
        if held and size + weight > ARRAY:
            yield from found()
            held, size = [], 0
        held += group
        size += weight
    if held:
        yield from found()


BYTES = Kind(
    window=WINDOW, units=bytes, anchors=anchors, part=lambda t, a, b: t[a:b], digestible=memoryview, resolve=resolve
)


def _left(text: bytes, gone: np.ndarray) -> bytes:
    return np.frombuffer(text, dtype=np.uint8)[~gone].tobytes() if gone.any() else text


def remove_repeated_bytes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", hot: int = HOT,
                          fold_bytes: int = FOLD_BYTES) -> DataFrame:
    """One row per document: id, n_units (bytes), n_removed, spans, kept (bytes left).

    Each byte goes that a 100-byte string covers which also starts earlier: in a document with a
    smaller id, or earlier in the same one; overlaps count, and strings are judged on the input.
    A null text is empty; texts under 100 bytes lose nothing. Documents with a null id come last,
    documents with equal ids are ordered by the hash of their text, and rows with equal id and
    text are one document that appears as often as it is there. An empty table gives no row;
    further columns are ignored.
    """
    return cut_repeats(docs, BYTES, _left, id_column, text_column, hot, fold_bytes)
