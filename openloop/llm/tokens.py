"""Token counts that follow edits.

A document is cut into pre-tokens; runs of 64 of them are the leaves of a segment tree that sums
characters and tokens. An edit walks down to the leaf it touches, cuts pre-tokens anew from the
last boundary that the edit cannot have moved, and stops at the first old leaf boundary behind
the edit that the new cut meets: from there on both cuts are the same, because a pre-token
depends only on the text from its start on. Only the leaves between are encoded again.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Pre-tokens of a leaf.
LEAF = 64
#: Counts of different pre-tokens that a task remembers at a time.
MEMO = 1 << 17

# Fixed value: the pre-token pattern of the byte-level vocabulary. A pre-token looks at most two
# characters beyond its end.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LOOKAHEAD = 2

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"


class _Memo(dict):
    """Token counts by pre-token; starts anew when it is full."""

    def __init__(self, encoding: tiktoken.Encoding):
        super().__init__()
        self.encoding = encoding

    def __missing__(self, piece: str) -> int:
        if len(self) >= MEMO:
            self.clear()
        found = self[piece] = len(self.encoding.encode_ordinary(piece))
        return found


class Counter:
    """Token counts of pre-tokens under a vocabulary given as the lines of its rank file."""

    def __init__(self, ranks: bytes):
        pairs = (line.split() for line in ranks.splitlines() if line)
        merges = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})
        self.cut = regex.compile(PATTERN)
        self.memo = _Memo(self.encoding)
        self.count = self.memo.__getitem__


class TokenTree:
    """Sums of (characters, tokens) over the leaves of one document, as an implicit binary tree:
    node k has children 2k and 2k+1, leaves begin at ``self.width``."""

    def __init__(self, chars: list[int], tokens: list[int]):
        self._plant(chars, tokens)

    def _plant(self, chars: list[int], tokens: list[int]) -> None:
        self.leaves = len(chars)
        self.width = 1 << max(0, (len(chars) - 1).bit_length())
        self.sums = np.zeros((2 * self.width, 2), dtype=np.int64)
        self.sums[self.width : self.width + len(chars)] = np.stack([chars, tokens], axis=1) if chars else 0
        level = self.width
        while level > 1:
            self.sums[level // 2 : level] = self.sums[level : 2 * level].reshape(-1, 2, 2).sum(axis=1)
            level //= 2

    @classmethod
    def of(cls, text: str, counter: Counter) -> TokenTree:
        pieces = counter.cut.findall(text)
        if not pieces:
            return cls([], [])
        pairs = np.array([list(map(len, pieces)), list(map(counter.count, pieces))])
        return cls(*np.add.reduceat(pairs, range(0, len(pieces), LEAF), axis=1).tolist())

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    def leaf_lists(self) -> tuple[list[int], list[int]]:
        part = self.sums[self.width : self.width + self.leaves]
        return part[:, 0].tolist(), part[:, 1].tolist()

    def find(self, place: int) -> tuple[int, int]:
        """(leaf, first character of it) of the leaf that holds character ``place``; the last
        leaf for a place at or behind the end."""
        node, base = 1, 0
        while node < self.width:
            node *= 2
            if place >= base + self.sums[node, 0]:
                base += int(self.sums[node, 0])
                node += 1
        leaf = node - self.width
        if leaf >= self.leaves:
            leaf = max(self.leaves - 1, 0)
            base = int(self.sums[1, 0] - self.sums[self.width + leaf, 0])
        return leaf, base

    def _set(self, first: int, chars: list[int], tokens: list[int], old: int) -> None:
        """Puts leaves in the place of ``old`` leaves from ``first``; as many new ones only touch
        the path to the root, else the tree is planted anew from its leaf sums."""
        if len(chars) != old:
            all_chars, all_tokens = self.leaf_lists()
            all_chars[first : first + old] = chars
            all_tokens[first : first + old] = tokens
            self._plant(all_chars, all_tokens)
            return
        for k, pair in enumerate(zip(chars, tokens)):
            node = self.width + first + k
            change = np.array(pair) - self.sums[node]
            while node:
                self.sums[node] += change
                node //= 2

    def edit(self, text: str, start: int, removed: int, inserted: str, counter: Counter) -> tuple[str, int]:
        """(new text, pre-tokens encoded again) after ``removed`` characters from ``start`` gave
        way to ``inserted``."""
        start = min(max(start, 0), len(text))
        removed = min(max(removed, 0), len(text) - start)
        new = text[:start] + inserted + text[start + removed :]
        if not self.leaves:
            self.__init__(*TokenTree.of(new, counter).leaf_lists())
            return new, sum(1 for _ in counter.cut.finditer(new))
        # A leaf that ends LOOKAHEAD characters before the edit, or earlier, is as it was.
        first, base = self.find(max(start - LOOKAHEAD, 0))
        if base > start - LOOKAHEAD and first:
            first -= 1
            base -= int(self.sums[self.width + first, 0])
        shift = len(inserted) - removed
        last, end = self.find(start + removed)
        end += int(self.sums[self.width + last, 0])  # old end of leaf ``last``
        chars, tokens, n, at, done = [], [], 0, base, False
        for piece in counter.cut.finditer(new, base):
            while last < self.leaves - 1 and end + shift < at:
                last += 1
                end += int(self.sums[self.width + last, 0])
            if at == end + shift and at >= start + len(inserted) and last < self.leaves - 1:
                done = True
                break
            if n % LEAF == 0:
                chars.append(0)
                tokens.append(0)
            chars[-1] += piece.end() - piece.start()
            tokens[-1] += counter.count(piece[0])
            n, at = n + 1, piece.end()
        self._set(first, chars, tokens, (last if done else self.leaves - 1) - first + 1)
        return new, n


def count_tokens(docs: DataFrame, ranks: str = RANKS, text_column: str = "text", edits_column: str | None = None) -> DataFrame:
    """``docs`` with n_tokens and, with edits, n_edits, tokens_after, reencoded, text_after.

    ``edits_column`` holds an array of structs (start, removed, inserted) in characters, applied
    one after the other to the text as the edits before have left it; places outside the text
    are moved to its ends. A null text counts as empty, null edits as none, and a null in an edit
    as 0 or the empty string. ``ranks`` is the path of the rank file, read on the driver and sent
    to the tasks (under a MB). Works row by row: repeated rows give repeated rows, an empty table
    none. Other columns are kept; one that has the name of a result is replaced.
    """
    with open(ranks, "rb") as file:
        held = docs.sparkSession.sparkContext.broadcast(file.read())

    @F.pandas_udf("n_tokens long, n_edits int, tokens_after long, reencoded long, text_after string")
    def counted(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        counter = Counter(held.value)
        for texts, *edits in parts:
            rows = []
            for text, starts, removed, inserted in zip(texts, *edits):
                text = text or ""
                tree = TokenTree.of(text, counter)
                before, again = tree.tokens, 0
                changes = [] if starts is None else list(zip(starts, removed, inserted))
                for start, gone, new in changes:
                    text, n = tree.edit(text, int(start), int(gone), new, counter)
                    again += n
                rows.append((before, len(changes), tree.tokens, again, text if changes else None))
            yield pd.DataFrame(rows, columns=["n_tokens", "n_edits", "tokens_after", "reencoded", "text_after"])

    def part(name: str, kind: str, default) -> Column:
        if edits_column is None:
            return F.lit(None).cast(f"array<{kind}>")
        return F.transform(edits_column, lambda e: F.coalesce(e[name].cast(kind), F.lit(default)))

    edits = (part("start", "long", 0), part("removed", "long", 0), part("inserted", "string", ""))
    held_as = "_counts"
    while held_as in docs.columns:
        held_as += "_"
    out = docs.withColumn(held_as, counted(F.col(text_column), *edits))
    results = {"n_tokens": F.col(f"{held_as}.n_tokens")}
    if edits_column:
        results |= {n: F.col(f"{held_as}.{n}") for n in ("n_edits", "tokens_after", "reencoded")}
        results["text_after"] = F.coalesce(F.col(f"{held_as}.text_after"), F.col(text_column), F.lit(""))
    return out.withColumns(results).drop(held_as)
