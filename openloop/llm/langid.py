"""Language identification by partial matching.

Each language has a tree of byte contexts, up to three bytes long, with the counts of the byte
that followed. A byte costs its code length under the longest context that has seen it; leaving a
context costs its escape code. Trees are frozen after learning, so the code lengths of every
n-gram are tabled once, and a text is scored by looking its n-grams up.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from openloop.llm.texts import held_out, text_bytes

ORDER = 3
#: About so many learning documents of each language, by the hash of their id.
SAMPLE = 600
BLOCK = 1 << 20


def _grams(text: bytes, order: int) -> np.ndarray:
    """Codes of the n-grams (``order`` context bytes and the byte itself) of a text; before the
    text stand line feeds."""
    bytes_ = np.frombuffer(b"\n" * order + text, dtype=np.uint8).astype(np.uint32)
    codes = np.zeros(len(text), dtype=np.uint32)
    for k in range(order + 1):
        codes = codes << np.uint32(8) | bytes_[k : k + len(text)]
    return codes


@dataclass
class Trees:
    """``grams[k]`` are the sorted n-grams with ``k`` context bytes that any language has seen,
    ``costs[k]`` their code length in bits per language; ``contexts[k]`` and ``escapes[k]`` the
    contexts of ``k`` bytes and what it costs a language to leave them."""

    languages: list[str]
    grams: list[np.ndarray]
    costs: list[np.ndarray]
    contexts: list[np.ndarray]
    escapes: list[np.ndarray]

    def code_lengths(self, text: bytes) -> np.ndarray:
        """Bits per language of the whole text."""
        total = np.zeros(len(self.languages))
        for start in range(0, len(text), BLOCK):
            head = (b"\n" * ORDER + text[:start])[-ORDER:]
            codes = _grams(head + text[start : start + BLOCK], ORDER)[ORDER:]
            for k in range(ORDER, -1, -1):
                if not len(codes):
                    break
                known = self.grams[k]
                at = np.minimum(np.searchsorted(known, codes), len(known) - 1)
                hit = known[at] == codes
                total += self.costs[k][at[hit]].sum(axis=0, dtype=np.float64)
                codes = codes[~hit]
                left = codes >> np.uint32(8)
                at = np.minimum(np.searchsorted(self.contexts[k], left), len(self.contexts[k]) - 1)
                inside = self.contexts[k][at] == left
                total += self.escapes[k][at[inside]].sum(axis=0, dtype=np.float64)
                codes = codes & np.uint32((1 << 8 * k) - 1)
            total += 8.0 * len(codes)
        return total


def _table(order: int, counts: pd.DataFrame, languages: list[str], lower: tuple | None) -> tuple:
    """(grams, costs, contexts, escapes) of one order from its counts (lang, code, n)."""
    part = counts[counts["k"] == order]
    grams, at = np.unique(part["code"].to_numpy(np.uint32), return_inverse=True)
    seen = np.zeros((len(grams), len(languages)))
    column = part["lang"].map({lang: i for i, lang in enumerate(languages)}).to_numpy()
    np.add.at(seen, (at, column), part["n"].to_numpy(np.float64))
    contexts, of = np.unique(grams >> np.uint32(8), return_inverse=True)
    total = np.zeros((len(contexts), len(languages)))
    kinds = np.zeros_like(total)
    np.add.at(total, of, seen)
    np.add.at(kinds, of, seen > 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        escapes = np.where(total > 0, -np.log2(kinds / (total + kinds)), 0.0)
        own = -np.log2(seen / (total + kinds)[of])
    if lower is None:
        beneath = np.full_like(seen, 8.0)
    else:
        beneath = lower[1][np.searchsorted(lower[0], grams & np.uint32((1 << 8 * order) - 1))]
    costs = np.where(seen > 0, own, escapes[of] + beneath)
    return grams, costs.astype(np.float32), contexts, escapes.astype(np.float32)


def grow(counts: pd.DataFrame) -> Trees | None:
    """Frozen trees from n-gram counts (lang, k, code, n)."""
    languages = sorted(counts["lang"].unique())
    if not languages:
        return None
    tables: list[tuple] = []
    for order in range(ORDER + 1):
        tables.append(_table(order, counts, languages, tables[-1] if tables else None))
    return Trees(languages, *(list(x) for x in zip(*tables)))


def fit(docs: DataFrame, sample: int = SAMPLE) -> Trees | None:
    """Learns from text and non-null lang outside the held-out fold (crc32 of the id modulo 3 is
    1). About ``sample`` documents of a language are learned from, chosen by the hash of their
    id; tasks count their n-grams and only sums reach the driver."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out("doc_id", 3, 1))
    rows = rows.select("lang", F.xxhash64("doc_id", "text").alias("h"), text_bytes(F.col("text")).alias("text"))
    sizes = rows.groupBy("lang").count()
    share = F.least(F.lit(1.0), F.lit(float(sample)) / F.col("count"))
    sizes = sizes.select("lang", (share * float(1 << 40)).cast("long").alias("most"))
    # One row per language, as the trees themselves have: bounded by what a task holds anyway.
    picked = rows.join(F.broadcast(sizes), "lang").where(F.pmod("h", F.lit(1 << 40)) < F.col("most")).select("lang", "text")

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for lang, texts in part.groupby("lang")["text"]:
                for k in range(ORDER + 1):
                    codes, n = np.unique(np.concatenate([_grams(bytes(t), k) for t in texts]), return_counts=True)
                    yield pd.DataFrame({"lang": lang, "k": k, "code": codes.astype(np.int64), "n": n})

    found = picked.mapInPandas(count, "lang string, k int, code long, n long")
    return grow(found.groupBy("lang", "k", "code").agg(F.sum("n").alias("n")).toPandas())


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    ``score`` is the share of the winner when code lengths are read as probabilities. A text that
    is null or has no letter is ``und`` with score 0, and so is every text if nothing could be
    learned; a tie goes to the language first in order. A null id is not held out. Repeated rows
    give repeated rows, an empty table none; further columns are ignored.
    """
    trees = fit(docs, sample)

    @F.pandas_udf("lang string, score double")
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            rows = []
            for text in texts:
                if text is None or trees is None:
                    rows.append(("und", 0.0))
                    continue
                bits = trees.code_lengths(text)
                best = int(bits.argmin())
                rows.append((trees.languages[best], float(1 / np.exp2(np.maximum(bits[best] - bits, -1000)).sum())))
            yield pd.DataFrame(rows, columns=["lang", "score"])

    lettered = F.when(F.col("text").rlike(r"\p{L}"), F.col("text").cast("binary"))
    found = docs.select("doc_id", predict(lettered).alias("found"))
    return found.select(
        "doc_id", held_out("doc_id", 3, 1).alias("held_out"), F.col("found.lang").alias("lang_pred"), "found.score"
    )
