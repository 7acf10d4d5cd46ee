"""Benchmark decontamination by spaced seeds, with DataFrame functions only.

A stretch of ``WINDOW`` tokens of a benchmark item counts as leaked where a document has the same
tokens at the same distances with at most ``SLACK`` substitutions. A mask looks at a span of ten
tokens and ignores two of its four groups, so whichever two tokens are substituted, one mask sees
none of them. Seeds start at every token of an item and at every fourth token of a document: any
window of thirteen tokens holds a whole span that begins at such a token. Seeds are joined by
hash; what they hit is verified token by token around the hit. An item of fewer tokens counts as
leaked where a document has all of them in a row: its one seed is the hash of the whole item.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from openloop.functions.durable import staged
from openloop.functions.sizing import hinted
from openloop.llm.texts import let

WINDOW, SLACK = 13, 2
SPAN, STRIDE = 10, 4
GROUPS = ((0, 1, 2), (3, 4), (5, 6, 7), (8, 9))
MASKS = tuple(sorted(a + b) for a, b in combinations(GROUPS, len(GROUPS) - SLACK))


# Code points of scripts written without spaces between words (Thai and Lao, Burmese,
# Khmer, kana, Han). All of them lie at or above U+0E00.
UNSPACED = (
    r"[\x{E00}-\x{EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}"
    r"\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{323AF}]"
)
MAY_BE_UNSPACED = r"[\x{E00}-\x{10FFFF}]"


def tokens(text: Column) -> Column:
    """Runs of letters and digits, lower-cased; characters of scripts without spaces one by one."""
    lower = F.lower(F.coalesce(text, F.lit("")))
    spaced = F.when(lower.rlike(MAY_BE_UNSPACED), F.regexp_replace(lower, UNSPACED, " $0 ")).otherwise(lower)
    return F.array_remove(F.split(spaced, r"[^\p{L}\p{N}]+"), "")


def _seeded(rows: DataFrame, keys: list[str], text: Column, stride: int) -> DataFrame:
    """(keys, seed, at): one seed per mask for every ``stride``-th start of a span."""

    def seeds(hashes: Column) -> Column:
        def at(start: Column) -> Column:
            return F.array(*(
                F.xxhash64(F.lit(number), *(F.get(hashes, start + k) for k in mask))
                for number, mask in enumerate(MASKS)
            ))

        last = F.size(hashes) - SPAN
        return F.transform(F.when(last >= 0, F.sequence(F.lit(0), last, F.lit(stride))), at)

    all_ = let(F.transform(text, lambda t: F.xxhash64(t)), seeds)
    # The outer form, since Spark would put a filter that computes all seeds before the plain one.
    return rows.select(*keys, F.posexplode_outer(all_).alias("at", "all")).select(
        *keys, (F.col("at") * stride).alias("at"), F.explode("all").alias("seed")
    )


def _verdict() -> Column:
    """(n_matched, enough) of ``item_tok`` laid on ``tok`` at ``shift``."""
    late = F.greatest(-F.col("shift"), F.lit(0))  # the item begins so much before the document
    here = F.slice("tok", F.greatest(F.col("shift"), F.lit(0)) + 1, F.size("item_tok"))
    places = F.sequence(F.lit(0), F.size("item_tok") - 1)

    def total(ones: Column) -> Column:
        return F.aggregate(ones, F.lit(0), lambda a, x: a + x)

    def agreement(near: Column) -> Column:
        def agrees(place: Column) -> Column:
            equal = F.when(place >= late, F.get(near, place - late) == F.get("item_tok", place))
            return F.coalesce(equal, F.lit(False)).cast("int")

        return F.transform(places, agrees)

    def judged(same: Column) -> Column:
        starts = F.when(F.size(same) >= WINDOW, F.sequence(F.lit(1), F.size(same) - WINDOW + 1))
        near = F.exists(starts, lambda s: total(F.slice(same, s, WINDOW)) >= WINDOW - SLACK)
        enough = F.when(F.size(same) < WINDOW, total(same) == F.size(same)).otherwise(near)
        return F.struct(total(same).alias("n_matched"), enough.alias("enough"))

    return let(let(here, agreement), judged)


def _whole(items: DataFrame) -> DataFrame:
    """(mark, n, seed): the hash of all tokens of each item that is shorter than a window."""
    short = items.where(F.size("item_tok") < WINDOW).select("mark", "item_tok").dropDuplicates(["mark"])
    return staged(short.select("mark", F.size("item_tok").alias("n"), F.xxhash64("item_tok").alias("seed")))


def _whole_hits(rows: DataFrame, whole: DataFrame) -> DataFrame:
    """(doc, tie, mark, shift): the first place of a short item in a document. Documents are cut
    into runs of the lengths that such items have, of which there are fewer than WINDOW."""
    lengths = sorted(row.n for row in whole.select("n").distinct().collect())

    def runs(cut: Column) -> Column:
        def of_length(n: int) -> Column:
            starts = F.when(F.size(cut) >= n, F.sequence(F.lit(1), F.size(cut) - n + 1))
            return F.transform(starts, lambda at: F.struct(
                F.lit(n).alias("n"), F.xxhash64(F.slice(cut, at, n)).alias("seed"), (at - 1).alias("at")))

        return F.flatten(F.filter(F.array(*map(of_length, lengths)), lambda a: a.isNotNull()))

    cut = rows.select("doc", "tie", F.explode(let(tokens(F.col("text")), runs)).alias("run"))
    found = cut.select("doc", "tie", "run.*").join(hinted(whole), ["n", "seed"])
    return found.groupBy("doc", "tie", "mark").agg(F.min("at").alias("shift"))


def overlaps(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    item_column: str = "item_id", item_text_column: str = "text",
) -> DataFrame:
    """(doc, tie, item, n_matched, n_tokens, doc_start): leaked items by document, ``tie`` the
    hash of the text. ``n_matched`` counts the item's tokens that the document has in place on
    the best alignment, ``doc_start`` is where the item would begin in the document's tokens."""
    items = benchmark.select(F.col(item_column).alias("item"), tokens(F.col(item_text_column)).alias("item_tok"))
    items = staged(items.where(F.size("item_tok") > 0).withColumn("mark", F.xxhash64("item_tok")).distinct())
    whole = _whole(items)
    long = items.where(F.size("item_tok") >= WINDOW)
    seeds = staged(_seeded(long, ["mark"], F.col("item_tok"), 1).distinct())
    seeds = seeds.select("seed", "mark", F.col("at").alias("item_at"))
    keyed = docs.select(
        F.col(id_column).alias("doc"), F.xxhash64(F.col(text_column)).alias("tie"), F.col(text_column).alias("text")
    )
    hits = _seeded(keyed, ["doc", "tie"], tokens(F.col("text")), STRIDE).join(hinted(seeds), "seed")
    hits = hits.select(
        F.col("doc").alias("d"), F.col("tie").alias("t"), "mark", (F.col("at") - F.col("item_at")).alias("shift")
    )
    hits = hits.distinct()
    if not whole.isEmpty():
        short = _whole_hits(keyed, whole).select(F.col("doc").alias("d"), F.col("tie").alias("t"), "mark", "shift")
        hits = hits.unionByName(short)
    wanted = staged(hits).join(items, "mark").drop("mark")
    same = F.col("doc").eqNullSafe(F.col("d")) & (F.col("tie") == F.col("t"))
    met = keyed.join(wanted, same).select("doc", "tie", "item", "shift", "item_tok", tokens(F.col("text")).alias("tok"))
    met = met.select("doc", "tie", "item", "shift", F.size("item_tok").alias("n_tokens"), _verdict().alias("verdict"))
    found = met.where("verdict.enough").select("doc", "tie", "item", "shift", "n_tokens", "verdict.n_matched")
    best = F.max(F.struct("n_matched", -F.col("shift"), "n_tokens")).alias("best")
    return found.groupBy("doc", "tie", "item").agg(best).select(
        "doc", "tie", "item", F.col("best.n_matched").alias("n_matched"), F.col("best.n_tokens").alias("n_tokens"),
        (-F.col("best.col2")).alias("doc_start"),
    )


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per (doc_id, item_id) with a leak: n_matched, n_tokens, doc_start.

    A null text has no token. An item of fewer than WINDOW tokens is matched as a whole, one
    without a token matches nothing. Equal items are reported under each of their ids, repeated rows of a document
    once; texts that share an id (or have none) are taken together, the best alignment counts. An
    empty table on either side gives no row; further columns are ignored.
    """
    best = F.max(F.struct("n_matched", -F.col("doc_start"), "n_tokens")).alias("best")
    return overlaps(docs, benchmark).groupBy("doc", "item").agg(best).select(
        F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), F.col("best.n_matched").alias("n_matched"),
        F.col("best.n_tokens").alias("n_tokens"), (-F.col("best.col2")).alias("doc_start"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a leak, with all their columns. Null and empty texts have none;
    repeated rows stay or go together; a row whose id is null is judged by its text."""
    found = overlaps(docs, benchmark).select(F.col("doc").alias("_leak_id"), F.col("tie").alias("_leak_tie")).distinct()
    same = docs["doc_id"].eqNullSafe(found["_leak_id"]) & (F.xxhash64(docs["text"]) == found["_leak_tie"])
    return docs.join(found, same, "left_anti")
