"""Spelling variants: words one edit apart, found by PartEnum signatures of their letters.

The letters of a word are a binary vector over (letter, how many-th one). An inserted or deleted
letter changes one place of it, a replaced one two. The places are cut into ``PARTS`` parts, so
words of one length that are near agree in all parts but two, and words whose lengths differ by
one in all parts but one: every choice of that many parts gives a signature, a hash of exactly the
letters in the parts chosen. An edit also leaves one half of the word alone, and signatures are
made for either half, so that common letters bring few words together. Equal signatures are
joined, and the join itself verifies the edit, so only near words leave it.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from openloop.functions.durable import staged
from openloop.llm.texts import text_bytes

#: Parts of the letter vector.
PARTS = 4
#: Different words that a scan task counts before it gives out what it has.
HELD = 300_000
#: Characters of a text that are cut into words at a time.
STEP = 1 << 20
#: Of this many runs, by hash of document and run, one loses a letter.
ONE_IN = 31
BREAK = re.compile("[^A-Za-zÀ-ÿ]")
TWO = list(combinations(range(PARTS), PARTS - 2))
ONE = list(combinations(range(PARTS), PARTS - 1))
MIX = np.uint64(0x9E3779B97F4A7C15)


def runs_of(text: bytes, shortest: int) -> Counter:
    """The maximal runs of letters with ``shortest`` code points or more, A-Z lower-cased."""
    whole = text.lower().decode("utf-8", "replace")
    found, at = Counter(), 0
    pattern = re.compile("[a-zÀ-ÿ]{%d,}" % max(shortest, 1))
    while at < len(whole):
        stop = BREAK.search(whole, at + STEP)
        end = stop.start() if stop else len(whole)
        found.update(pattern.findall(whole, at, end))
        at = end
    return found


def _counted(shortest: int, held: int):
    """(word, n) of each task's documents, in portions of at most ``held`` different words."""

    def packed(counts: Counter) -> pa.RecordBatch:
        columns = [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for ident, text in zip(batch.column(0), batch.column(1)):
                start = zlib.crc32(f"{ident.as_py() or ''}:".encode())
                for word, n in runs_of(text.as_py(), shortest).items():
                    h = zlib.crc32(word.encode(), start)
                    if h % ONE_IN == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < shortest:
                            continue
                    counts[word] += n
                if len(counts) >= held:
                    yield packed(counts)
                    counts = Counter()
        if counts:
            yield packed(counts)

    return run


def words_of(docs: DataFrame, id_column: str, text_column: str, shortest: int, least: int, held: int = HELD) -> DataFrame:
    """(word, n): the words of ``shortest`` code points or more with ``least`` occurrences or more."""
    rows = docs.select(F.col(id_column).cast("string"), text_bytes(F.col(text_column)))
    counted = rows.mapInArrow(_counted(shortest, held), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _part_hashes(word: str) -> list[int]:
    """A hash of the letters that fall into each part."""
    seen: Counter = Counter()
    parts: list[list[str]] = [[] for _ in range(PARTS)]
    for letter in word:
        seen[letter] += 1
        parts[(ord(letter) + 3 * seen[letter]) % PARTS].append(f"{letter}{seen[letter]}")
    return [xxhash.xxh3_64_intdigest(" ".join(sorted(part))) for part in parts]


def signatures(words: list[str]) -> np.ndarray:
    """A row of signatures for each word: first those that meet words of its own length, then
    those under which it is the shorter word, then those under which it is the longer one."""
    parts = np.array([_part_hashes(w) for w in words], dtype=np.uint64).reshape(-1, PARTS)
    size = np.array([len(w) for w in words], dtype=np.uint64)
    own = [(w[: len(w) // 2], w[len(w) // 2 :]) for w in words]
    longer = [(w[: (len(w) - 1) // 2], w[(len(w) - 1) // 2 + 1 :]) for w in words]
    own, longer = (
        np.array([[xxhash.xxh3_64_intdigest(h, k) for k, h in enumerate(p)] for p in halves], np.uint64).reshape(-1, 2)
        for halves in (own, longer)
    )

    def signed(chosen: tuple[int, ...], half: np.ndarray, length: np.ndarray, family: int) -> np.ndarray:
        mixed = (length + np.uint64(1000 * (1 + family))) * MIX
        for part in (*(parts[:, p] for p in chosen), half):
            mixed = (mixed ^ part) * MIX
            mixed ^= mixed >> np.uint64(29)
        return mixed

    columns = [signed(c, own[:, k], size, f) for f, c in enumerate(TWO) for k in (0, 1)]
    one = len(TWO)
    columns += [signed(c, own[:, k], size, one + f) for f, c in enumerate(ONE) for k in (0, 1)]
    columns += [signed(c, longer[:, k], size - np.uint64(1), one + f) for f, c in enumerate(ONE) for k in (0, 1)]
    return np.stack(columns, axis=1).view(np.int64)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = signatures(batch.column("word").to_pylist())
        ends = pa.array(np.arange(len(found) + 1) * found.shape[1], pa.int32())
        lists = pa.ListArray.from_arrays(ends, pa.array(found.reshape(-1)))
        yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), lists], names=["word", "n", "signatures"])


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n): each two of ``words`` (word, n) that differ by exactly one
    inserted, deleted or replaced code point, once in either order."""
    same, short = 2 * len(TWO), 2 * len(ONE)
    found = words.select("word", "n").mapInArrow(_signed, "word string, n long, signatures array<long>")

    def side(first: int, last: int, word: str, n: str, place: str) -> DataFrame:
        # The own-length signatures and those of one role.
        wanted = F.concat(F.slice("signatures", 1, same), F.slice("signatures", first + 1, last - first))
        rows = found.select(F.col("word").alias(word), F.col("n").alias(n), F.posexplode(wanted).alias(place, "signature"))
        return rows.withColumn(place, F.col(place) < same)

    left = side(same, same + short, "word", "n", "level")
    right = side(same + short, same + 2 * short, "other", "other_n", "_level")
    near = (~F.col("level") | (F.col("word") < F.col("other"))) & (F.levenshtein("word", "other", 1) == 1)
    met = left.join(right, (left["signature"] == right["signature"]) & (F.col("level") == F.col("_level")) & near)
    met = met.select("word", "n", "other", "other_n").distinct()
    both = F.array(F.struct("word", "n", "other", "other_n"),
                   F.struct(F.col("other").alias("word"), F.col("other_n").alias("n"),
                            F.col("word").alias("other"), F.col("n").alias("other_n")))
    return met.select(F.explode(both).alias("pair")).select("pair.*")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form), by doubling. Counts grow at least tenfold from a word to its
    form, so there is no ring and few rounds."""
    known = staged(forms.select("word", F.col("form").alias("root")))
    while True:
        step = known.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = known.join(step, "root", "left").select("word", F.coalesce("further", "root").alias("root"), "further")
        moved = staged(moved)
        known = moved.select("word", "root")
        if moved.where("further IS NOT NULL").isEmpty():
            return known


def spelling_groups(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    shortest: int = 7, least: int = 2, times: int = 10,
) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    Words are the runs of letters of all texts after some have lost a letter by hash of
    document and run, with ``shortest`` code points and ``least`` occurrences or more. A word's form
    is the near word with the most occurrences (ties: the smallest) if it has ``times`` as many,
    else null; its root is where forms lead. A null text has no run; a null id prints as nothing
    before the colon; repeated rows count each time. An empty table gives no row; further columns are
    ignored, whatever their names.
    """
    words = staged(words_of(docs, id_column, text_column, shortest, least))
    best = F.min(F.struct((-F.col("other_n")).alias("minus"), "other"))
    stats = near_pairs(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    found = words.join(stats, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(-F.col("best.minus") >= times * F.col("n"), F.col("best")).alias("best"),
    )
    found = staged(found.select("word", F.col("best.other").alias("form"), "n", "n_near", (-F.col("best.minus")).alias("form_n")))
    roots = _roots(found.where("form IS NOT NULL"))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
