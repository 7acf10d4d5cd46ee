"""Mixing sources to target weights, with DataFrame functions only.

The words of a source form one stream, cut into blocks of fixed length. A source needs a known
number of block slots to reach its target: whole passes over its blocks and one partial pass,
whose last slot is cut. Every slot draws an output shard, so the counts of a source over the
shards are multinomial; the slots are numbered through, shard by shard, and a pseudorandom
permutation of the source's block indices, another for each pass, says which block a slot takes.
Slots and blocks then meet in an equality join on (source, block).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from openloop.functions.durable import staged
from openloop.llm.texts import WORD, let, word_count

#: Rounds of a permutation; one index in 2^ROUNDS keeps its place in all of them.
ROUNDS = 16


@dataclass(frozen=True)
class Mix:
    """``weights`` go round the sources in code point order, nulls last; ``share`` of all words
    is mixed; a source gives at most ``most`` times its words. ``block`` is in words, ``shard``
    in slots."""

    weights: tuple[float, ...] = (5, 2, 1)
    share: float = 1.5
    most: float = 2.0
    block: int = 128
    shard: int = 4096
    seed: int = 0


def targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """(rank, src, source_size, target), one row per source.

    Water filling: with sources ordered by the level at which they are full, the level is found
    at the first source that stays below it. Both windows run over one row per source."""
    per = sizes.groupBy("src").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("src").asc_nulls_last())
    ranked = per.select("src", "source_size", F.row_number().over(order).alias("rank"))
    weights = F.array(*(F.lit(float(w)) for w in mix.weights))
    ranked = ranked.withColumn("w", F.get(weights, (F.col("rank") - 1) % len(mix.weights)))
    ranked = ranked.withColumn("most", F.col("source_size") * F.lit(float(mix.most)))
    ranked = ranked.withColumn("full_at", F.col("most") / F.col("w"))
    filling = Window.orderBy("full_at", "rank")
    everything = filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = filling.rowsBetween(Window.unboundedPreceding, -1)

    def ahead(column: str) -> Column:
        return F.coalesce(F.sum(column).over(before), F.lit(0.0))

    wanted = F.sum("source_size").over(everything) * F.lit(float(mix.share))
    level = (wanted - ahead("most")) / (F.sum("w").over(everything) - ahead("w"))
    ranked = ranked.withColumn("level", level)
    reached = F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "rank", "level"))
    ranked = ranked.withColumn("found", F.min(reached).over(everything)["level"])
    target = F.when(F.col("found").isNull() | (F.col("full_at") < F.col("found")), F.col("most"))
    return ranked.select("rank", "src", "source_size", target.otherwise(F.col("w") * F.col("found")).alias("target"))


def permuted(index: Column, blocks: Column, salt: Column) -> Column:
    """Pseudorandom permutation of 0..blocks-1 under the key ``salt``, by swap-or-not rounds: each
    round pairs every index with a partner at a drawn distance and swaps the pair or not, by a
    hash of its larger index, so it is a permutation of any number of blocks. Index 0 goes to the
    last block, the only short one."""
    others = F.greatest(blocks - 1, F.lit(1).cast("long"))

    def swapped(at: Column, number: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(salt, number), others) - at, others)
        swap = F.pmod(F.xxhash64(salt, number, F.greatest(at, partner)), F.lit(2)) == 1
        return F.when(swap, partner).otherwise(at)

    walked = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), (index - 1).cast("long"), swapped)
    return F.when(index == 0, blocks - 1).otherwise(walked)


def _stream(sizes: DataFrame, ranks: DataFrame) -> DataFrame:
    """``sizes`` with the rank of the source and the offset of the document in its stream.

    A two-level prefix sum: documents fall into hashed chunks, chunk totals are summed up per
    source, and a running sum orders the documents of one chunk. With n documents there are as
    many chunks as a chunk has documents, so both windows stay at the square root of n."""
    chunks = max(1, math.isqrt(sizes.count()))
    rows = sizes.join(ranks.select("src", "rank"), sizes["src"].eqNullSafe(ranks["src"])).select(
        "rank", "doc", "tie", "size", F.pmod(F.xxhash64("doc", "tie"), F.lit(chunks)).alias("chunk")
    )
    totals = rows.groupBy("rank", "chunk").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("rank").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        F.col("rank").alias("r"), F.col("chunk").alias("c"), F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("base")
    )
    inside = Window.partitionBy("rank", "chunk").orderBy("doc", "tie", "size")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("ahead", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    same = (F.col("rank") == F.col("r")) & (F.col("chunk") == F.col("c"))
    return rows.join(totals, same).select("rank", "doc", "tie", "size", (F.col("base") + F.col("ahead")).alias("offset"))


def _plan(ranks: DataFrame, mix: Mix) -> DataFrame:
    """Per source: number of blocks, of slots, and the words of the last slot."""
    size, block = F.col("source_size"), mix.block
    rows = ranks.where("source_size > 0").select(
        "rank", "source_size", F.ceil(size / block).alias("blocks"),
        F.floor(F.col("target") / size).alias("passes"), F.floor("target").alias("wanted"),
    )
    rows = rows.withColumn("rest", F.col("wanted") - F.col("passes") * size)
    rows = rows.withColumn("short", F.col("blocks") * block - size)
    partial = F.when(F.col("rest") <= 0, F.lit(0)).otherwise(F.ceil((F.col("rest") + F.col("short")) / block))
    rows = rows.withColumn("partial", partial.cast("long"))
    last = F.when(F.col("partial") == 1, F.col("rest")).otherwise(
        F.col("rest") + F.col("short") - (F.col("partial") - 1) * block
    )
    return rows.select(
        "rank", "blocks", (F.col("passes") * F.col("blocks") + F.col("partial")).alias("slots"),
        F.when(F.col("partial") > 0, last).otherwise(F.lit(block)).cast("long").alias("last_words"),
    )


def _slots(plan: DataFrame, mix: Mix) -> DataFrame:
    """(rank, shard, slot, block, words): every slot of the mix, ``words`` the most it takes."""
    total = plan.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    shards = max(1, -(-total // mix.shard))
    step = 1 << 16
    parts = int(plan.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def counted(rows: DataFrame, column: str) -> DataFrame:
        """A row per number below ``column``, in two steps so that no task makes too many."""
        starts = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"{column} - 1"), F.lit(step).cast("long")))
        rows = rows.where(F.col(column) > 0).withColumn("start", starts)
        rows = rows.repartition(parts, *rows.columns)
        ends = F.least(F.col("start") + step, F.col(column)) - 1
        return rows.withColumn("n", F.explode(F.sequence("start", ends))).drop("start")

    drawn = counted(plan.select("rank", "slots"), "slots").select(
        "rank", F.pmod(F.xxhash64(F.lit(mix.seed), "rank", "n"), F.lit(shards)).alias("shard")
    )
    counts = drawn.groupBy("rank", "shard").agg(F.count("*").alias("count"))
    earlier = Window.partitionBy("rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("first", F.coalesce(F.sum("count").over(earlier), F.lit(0)))
    slots = counted(counts, "count").select("rank", "shard", (F.col("first") + F.col("n")).alias("slot"))
    slots = slots.join(plan, "rank")
    salt = F.xxhash64(F.lit(mix.seed), "rank", F.floor(F.col("slot") / F.col("blocks")))
    words = F.when(F.col("slot") == F.col("slots") - 1, F.col("last_words")).otherwise(F.lit(mix.block))
    return slots.select(
        "rank", "shard", "slot", permuted(F.col("slot") % F.col("blocks"), F.col("blocks"), salt).alias("block"),
        words.cast("long").alias("words"),
    )


def mixture(sizes: DataFrame, ranks: DataFrame, mix: Mix) -> DataFrame:
    """The mix itself: (rank, shard, slot, block, offset, doc, tie, first_word, n_words), a row
    per piece of a document in a slot. ``offset`` is the document's place in its source."""
    placed = _stream(sizes, ranks).where("size > 0")
    touched = F.sequence(
        F.floor(F.col("offset") / mix.block), F.floor((F.col("offset") + F.col("size") - 1) / mix.block)
    )
    pieces = placed.withColumn("block", F.explode(touched)).select(
        "rank", "block", "doc", "tie", "offset",
        F.greatest(F.col("offset") - F.col("block") * mix.block, F.lit(0)).alias("a"),
        F.least(F.col("offset") + F.col("size") - F.col("block") * mix.block, F.lit(mix.block)).alias("b"),
    )
    joined = _slots(_plan(ranks, mix), mix).join(pieces, ["rank", "block"])
    taken = F.least("b", "words") - F.col("a")
    first = F.col("block") * mix.block + F.col("a") - F.col("offset")
    return joined.select(
        "rank", "shard", "slot", "block", "offset", "doc", "tie", first.alias("first_word"), taken.alias("n_words")
    ).where("n_words > 0")


def mixed_blocks(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", mix: Mix = Mix()
) -> DataFrame:
    """The mixed corpus: (shard, slot, source, n_words, text), a row per block slot, its words
    joined by one space. The shards of a slot are drawn, so a shard holds about ``shard`` slots.

    Each document is cut once, whatever number of slots takes pieces of it. Documents without a
    word and sources without one give no row; an empty table none.
    """
    sizes = measured(docs, id_column, text_column, source_column)
    ranks = staged(targets(sizes, mix))
    piece = F.struct("shard", "slot", "rank", "offset", "first_word", "n_words")
    pieces = mixture(sizes, ranks, mix).groupBy("doc", "tie").agg(F.collect_list(piece).alias("pieces"))
    texts = docs.select(
        F.col(id_column).alias("d"), F.xxhash64(F.col(text_column)).alias("t"), F.col(text_column).alias("text")
    ).dropDuplicates(["d", "t"])
    met = pieces.join(texts, F.col("doc").eqNullSafe(F.col("d")) & (F.col("tie") == F.col("t")))

    def cut(words: Column) -> Column:
        return F.transform("pieces", lambda p: F.struct(
            p["shard"].alias("shard"), p["slot"].alias("slot"), p["rank"].alias("rank"), p["n_words"].alias("n"),
            F.struct(p["offset"].alias("offset"), p["first_word"].alias("first"), F.array_join(
                F.slice(words, (p["first_word"] + 1).cast("int"), p["n_words"].cast("int")), " ").alias("words")).alias("part"),
        ))

    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    parts = met.select(F.explode(let(words, cut)).alias("p")).select("p.*")
    joined = F.array_join(F.transform(F.sort_array(F.collect_list("part")), lambda p: p["words"]), " ")
    slots = parts.groupBy("shard", "rank", "slot").agg(F.sum("n").alias("n_words"), joined.alias("text"))
    return slots.join(ranks.select("rank", "src"), "rank").select(
        "shard", "slot", F.col("src").alias("source"), "n_words", "text"
    )


def write_mix(docs: DataFrame, path: str, mix: Mix = Mix(), **columns: str) -> None:
    """Writes :func:`mixed_blocks` as one folder for each shard, slots in order."""
    blocks = mixed_blocks(docs, mix=mix, **columns)
    blocks.repartition("shard").sortWithinPartitions("shard", "slot", "source").write.partitionBy("shard").parquet(path)


def measured(docs: DataFrame, id_column: str, text_column: str, source_column: str) -> DataFrame:
    return staged(
        docs.select(
            F.col(id_column).alias("doc"), F.col(source_column).alias("src"),
            F.xxhash64(F.col(text_column)).alias("tie"), word_count(F.col(text_column)).alias("size"),
        )
    )


def mix_sources(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", mix: Mix = Mix()
) -> DataFrame:
    """One row per document: id, size, source, source_size, target, taken.

    ``taken`` counts the words of the document in the mix, repeats included: at most ``most``
    times its size, since no pass takes a block twice. Each source reaches the whole words of its
    target. A null text has size 0 and nothing taken; a null source is a source of its own; rows
    with the same id and text (or source) are placed one after the other. An empty table gives no
    row. Runs agree because every draw is a hash.
    """
    sizes = measured(docs, id_column, text_column, source_column)
    ranks = staged(targets(sizes, mix))
    taken = mixture(sizes, ranks, mix).groupBy("rank", "offset").agg(F.sum("n_words").alias("taken"))
    taken = taken.select(F.col("rank").alias("r"), F.col("offset").alias("o"), "taken")
    placed = _stream(sizes, ranks)
    same = (F.col("rank") == F.col("r")) & (F.col("offset") == F.col("o")) & (F.col("size") > 0)
    found = placed.join(taken, same, "left").join(ranks, "rank")
    return found.select(
        F.col("doc").alias(id_column), "size", F.col("src").alias("source"), "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
    )
