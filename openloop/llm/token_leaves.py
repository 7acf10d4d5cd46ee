"""Stored leaves of token trees: counts that follow the edits of a later day.

:func:`token_leaves` encodes documents once and gives the leaves of their segment trees as a column
that is stored with them. :func:`follow_edits` takes text, leaves and edits, plants the trees from
the stored sums without encoding anything, and encodes only what the edits touch.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from openloop.llm.tokens import RANKS, Counter, TokenTree

LEAVES = "array<struct<chars:int,tokens:int>>"


def _rank_bytes(docs: DataFrame, ranks: str):
    with open(ranks, "rb") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def _pairs(tree: TokenTree) -> list[dict[str, int]]:
    return [{"chars": c, "tokens": t} for c, t in zip(*tree.leaf_lists())]


def _unused(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name += "_"
    return name


def token_leaves(docs: DataFrame, ranks: str = RANKS, text_column: str = "text", leaves_column: str = "leaves") -> DataFrame:
    """``docs`` with ``leaves_column``: characters and tokens of each run of 64 pre-tokens, in order.
    A null or empty text has no leaf. Other columns are kept; one of that name is replaced."""
    held = _rank_bytes(docs, ranks)

    @F.pandas_udf(LEAVES)
    def cut(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = Counter(held.value)
        for texts in parts:
            yield pd.Series([_pairs(TokenTree.of(text or "", counter)) for text in texts], dtype=object)

    return docs.withColumn(leaves_column, cut(F.col(text_column)))


def tokens_of(leaves: Column | str) -> Column:
    """The token count of a document from its leaves; 0 for null."""
    sums = F.aggregate(leaves, F.lit(0).cast("long"), lambda total, leaf: total + leaf["tokens"])
    return F.coalesce(sums, F.lit(0).cast("long"))


def follow_edits(
    docs: DataFrame, ranks: str = RANKS, text_column: str = "text", leaves_column: str = "leaves", edits_column: str = "edits"
) -> DataFrame:
    """``docs`` with text and leaves as ``edits_column`` (see :func:`openloop.llm.tokens.count_tokens`)
    leaves them, and ``reencoded``, the pre-tokens encoded on the way.

    A row without edits is passed on as it is. Null leaves, or leaves whose characters do not add
    up to the text's (of another version of the text), are cut from the text first, and count as
    encoded. A null text counts as empty. Other columns are kept; ``reencoded`` is replaced.
    """
    held = _rank_bytes(docs, ranks)

    @F.pandas_udf(f"text string, leaves {LEAVES}, reencoded long")
    def edited(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        counter = Counter(held.value)
        for columns in parts:
            rows = []
            for text, chars, tokens, starts, removed, inserted in zip(*columns):
                text, again = text or "", 0
                if chars is not None and sum(chars) == len(text):
                    tree = TokenTree(list(map(int, chars)), list(map(int, tokens)))
                else:
                    tree = TokenTree.of(text, counter)
                    again = sum(1 for _ in counter.cut.finditer(text))
                for start, gone, new in zip(starts, removed, inserted):
                    text, n = tree.edit(text, int(start), int(gone), new, counter)
                    again += n
                rows.append((text, _pairs(tree), again))
            yield pd.DataFrame(rows, columns=["text", "leaves", "reencoded"])

    def part(name: str, kind: str, default: object) -> Column:
        return F.transform(edits_column, lambda e: F.coalesce(e[name].cast(kind), F.lit(default)))

    some = F.coalesce(F.size(edits_column), F.lit(0)) > 0
    leaves = [F.col(leaves_column)[name] for name in ("chars", "tokens")]
    edits = (part("start", "long", 0), part("removed", "long", 0), part("inserted", "string", ""))
    found = _unused(docs, "_edited")
    touched = docs.where(some).withColumn(found, edited(F.col(text_column), *leaves, *edits)).withColumns({
        text_column: F.col(f"{found}.text"), leaves_column: F.col(f"{found}.leaves"), "reencoded": F.col(f"{found}.reencoded"),
    }).drop(found)
    return docs.where(~some).withColumn("reencoded", F.lit(0).cast("long")).unionByName(touched)
