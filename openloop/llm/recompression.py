"""Repeated word passages by recompression.

Words are symbols. Rounds rename them: first words that stand in a run of equal words get a run
name, then two rounds of pairs merge each pair of neighbours whose left symbol is drawn left and
whose right symbol is drawn right in that round. A name is a hash of what it stands for, so every
task of the cluster gives equal runs and pairs the same name without having to ask. Whether two
symbols merge depends on these two alone; each round can therefore blur one symbol at either end
of a passage and its interior symbols are the same in every copy.

Of a window of 20 words the run round blurs one word at each end, the pair rounds one and two
more, so symbols that lie in words 4 to 15 are the window's own. One begins in any four words.
The window chooses among those that begin at words 4 to 12 the longest, then the one with the
smallest name, then the leftmost; its name and the eight words from its start are the key under
which copies meet (see anchors). Records whose whole
contexts have equal keys and digests are repeats without a look at their words; where contexts
under a key differ, windows are verified word by word (hot keys: by digests of the windows).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import xxhash
from pyspark.sql import DataFrame

from openloop.llm.anchors import FOLD_BYTES, HOT, Kind, cut_repeats
from openloop.llm.suffixes import chosen, sliding_min

WINDOW = 20
#: Starts of own symbols in a window, and the words of a key.
FIRST, LAST, KEY = 4, 12, 8
ROUNDS = 2


class Words:
    """Words of a text and their hashes."""

    def __init__(self, text: bytes):
        self.words = text.split()
        self.hashes = np.fromiter(map(xxhash.xxh64_intdigest, self.words, repeat(0)), np.uint64, len(self.words))

    def __len__(self) -> int:
        return len(self.words)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def recompressed(words: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(names, starts, lengths) of the symbols after the run round and ``rounds`` pair rounds."""
    equal = words[1:] == words[:-1]
    in_run = np.append(False, equal) | np.append(equal, False)
    names = np.where(in_run, _mixed(words ^ np.uint64(0xA0761D6478BD642F)), words)
    starts, fixed = np.arange(len(words)), in_run
    for number in range(1, rounds + 1):
        left = (_mixed(names + np.uint64(number)) & np.uint64(1)).astype(bool) & ~fixed
        merges = np.append(left[:-1] & ~left[1:] & ~fixed[1:], False)
        second = np.append(False, merges[:-1])
        paired = _mixed(names * np.uint64(0x9E3779B97F4A7C15) + np.append(names[1:], np.uint64(0)) + np.uint64(number))
        names = np.where(merges, paired, names)[~second]
        starts, fixed = starts[~second], fixed[~second]
    return names, starts, np.diff(np.append(starts, len(words)))


def anchors(units: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    words = units.hashes
    names, starts, lengths = recompressed(words)
    rank = (np.uint64(4) - lengths.astype(np.uint64)) << np.uint64(60)
    rank |= (_mixed(names) >> np.uint64(4)) & np.uint64(0x0FFFFFFF00000000)
    ordered = np.full(len(words), np.uint64(0xFFFFFFFFFFFFFFFF))
    ordered[starts] = rank | starts.astype(np.uint64)
    named = np.zeros(len(words), dtype=np.uint64)
    named[starts] = names
    windows = len(words) - WINDOW + 1
    anchor, first, last = chosen(sliding_min(ordered[FIRST : windows + LAST], LAST - FIRST + 1))
    key = named[anchor]
    for k in range(KEY):
        key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) + words[anchor + k])
    return key, anchor, first, last


def resolve(contexts: Iterator[tuple]) -> Iterator[tuple[tuple, int, int]]:
    """Windows of one key in document order; the first with its words is the earliest."""
    key, seen = None, set()
    for context in contexts:
        if context[0] != key:
            key, seen = context[0], set()
        words = context[-1].split(b" ")
        run = None
        for start in range(len(words) - WINDOW + 1):
            window = b" ".join(words[start : start + WINDOW])
            if window not in seen:
                seen.add(window)
                if run is not None:
                    yield context, run, start - 1
                    run = None
            elif run is None:
                run = start
        if run is not None:
            yield context, run, len(words) - WINDOW


WORDS = Kind(
    window=WINDOW, units=Words, anchors=anchors, part=lambda u, a, b: b" ".join(u.words[a:b]),
    digestible=lambda u: u.hashes, resolve=resolve,
)


def _left(units: Words, gone: np.ndarray) -> bytes:
    return b" ".join(units.words[i] for i in np.flatnonzero(~gone).tolist()) if gone.any() else b" ".join(units.words)


def remove_repeated_passages(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", hot: int = HOT,
                             fold_bytes: int = FOLD_BYTES) -> DataFrame:
    """One row per document: id, n_units (words), n_removed, spans, kept (words left, joined by
    one space).

    Each word goes that a window of 20 words covers whose words also start earlier: in a document
    with a smaller id, or earlier in the same one; windows are judged on the input. A null text
    has no word; texts under 20 words lose nothing. Order and repeated rows are as in
    remove_repeated_bytes: null ids last, equal ids by the hash of the text, rows with equal id
    and text are one document. An empty table gives no row; further columns are ignored.
    """
    return cut_repeats(docs, WORDS, _left, id_column, text_column, hot, fold_bytes)
