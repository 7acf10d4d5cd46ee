"""Quality classifier: a byte-level convolutional network, trained and applied in numpy.

Each byte has a learned vector. Learned filters look at chunks of 32 bytes that overlap by half
and together cover the whole document; each filter keeps its largest answer over all chunks, and
a logistic unit combines these into one probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from openloop.llm.texts import held_out, text_bytes

CHUNK, STEP, WIDTH, FILTERS = 32, 16, 4, 24
#: Chunks that are held in memory at a time, of a document of any length.
BLOCK = 1 << 15
#: At most so many learning documents of each class, those with the smallest hash of their id.
SAMPLE = 1000
#: At most so many bytes of learning texts of each class come to the driver.
SAMPLE_BYTES = 256 << 20
STEPS, BATCH, RATE = 1200, 24, 0.01
#: Short pieces of good documents are learned as good as well, this many bytes long.
PIECE = (4, 160)


@dataclass
class Net:
    vectors: np.ndarray  # (256, WIDTH)
    filters: np.ndarray  # (CHUNK * WIDTH, FILTERS)
    shift: np.ndarray  # (FILTERS,)
    weights: np.ndarray  # (FILTERS,)
    bias: float

    def pooled(self, text: bytes, places: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Largest answer of each filter and, if asked for, the byte where its chunk begins."""
        chunks = max(0, -(-(len(text) - CHUNK) // STEP)) + 1
        padded = np.zeros((chunks - 1) * STEP + CHUNK, dtype=np.uint8)
        padded[: len(text)] = np.frombuffer(text, dtype=np.uint8)
        best, where = np.full(FILTERS, -np.inf, np.float32), np.zeros(FILTERS, np.int64)
        for start in range(0, chunks, BLOCK):
            count = min(BLOCK, chunks - start)
            part = self.vectors[padded[start * STEP : (start + count - 1) * STEP + CHUNK]]
            views = np.lib.stride_tricks.as_strided(
                part, (count, CHUNK * WIDTH), (STEP * WIDTH * part.itemsize, part.itemsize), writeable=False
            )
            answers = views @ self.filters
            if not places:
                np.maximum(best, answers.max(axis=0), out=best)
                continue
            top = answers.argmax(axis=0)
            value = answers[top, np.arange(FILTERS)]
            better = value > best
            best[better], where[better] = value[better], (start + top[better]) * STEP
        return best + self.shift, where

    def probability(self, text: bytes) -> float:
        answers = np.maximum(self.pooled(text, places=False)[0], 0)
        return float(1 / (1 + np.exp(-np.clip(answers @ self.weights + self.bias, -30, 30))))


def train(texts: list[bytes], labels: list[int], prior: float, seed: int = 0) -> Net:
    """STEPS steps of Adam on the log loss. ``prior`` is the share of label 1 outside the balanced sample."""
    rng = np.random.default_rng(seed)
    sizes = rng.integers(*PIECE, len(texts))
    places = rng.random(len(texts))
    pieces = [t[int(p * len(t)) :][:n] for t, y, n, p in zip(texts, labels, sizes, places) if y]
    texts, labels = texts + pieces, labels + [1] * len(pieces)
    net = Net(
        rng.normal(0, 0.5, (256, WIDTH)).astype(np.float32),
        rng.normal(0, 0.25, (CHUNK * WIDTH, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32), rng.normal(0, 0.3, FILTERS).astype(np.float32), 0.0,
    )
    names = ("vectors", "filters", "shift", "weights", "bias")
    first = {n: np.zeros_like(getattr(net, n), dtype=np.float64) for n in names}
    second = {n: v.copy() for n, v in first.items()}
    wanted = np.array(labels, dtype=np.float64)
    classes = [np.flatnonzero(wanted == c) for c in (0, 1)]
    for steps in range(1, STEPS + 1):
        batch = np.concatenate([rng.choice(c, BATCH // 2) for c in classes])  # both classes alike
        looks = [net.pooled(texts[index]) for index in batch]
        raw = np.stack([answers for answers, _ in looks])  # (documents, FILTERS)
        seen = np.stack([
            np.frombuffer(texts[index] + bytes(CHUNK), dtype=np.uint8)[where[:, None] + np.arange(CHUNK)]
            for index, (_, where) in zip(batch, looks)
        ])  # the bytes of each filter's chunk: (documents, FILTERS, CHUNK)
        answers = np.maximum(raw, 0)
        chance = 1 / (1 + np.exp(-np.clip(answers @ net.weights + net.bias, -30, 30)))
        slope = (chance - wanted[batch]) / len(batch)
        back = slope[:, None] * net.weights * (raw > 0)
        chunks = net.vectors[seen].reshape(len(batch), FILTERS, CHUNK * WIDTH)
        inner = back[:, :, None] * net.filters.T
        inner = inner.reshape(-1, WIDTH)
        slopes = {
            "bias": slope.sum(),
            "weights": slope @ answers,
            "shift": back.sum(axis=0),
            "filters": np.einsum("df,dfk->kf", back, chunks),
            "vectors": np.stack([np.bincount(seen.ravel(), inner[:, k], 256) for k in range(WIDTH)], axis=1),
        }
        rate = RATE * (0.5 if steps > STEPS * 2 // 3 else 1)
        for n in names:
            first[n] += 0.1 * (slopes[n] - first[n])
            second[n] += 0.001 * (slopes[n] ** 2 - second[n])
            change = rate * (first[n] / (1 - 0.9**steps)) / (np.sqrt(second[n] / (1 - 0.999**steps)) + 1e-8)
            value = getattr(net, n) - change
            setattr(net, n, value.astype(np.float32) if n != "bias" else float(value))
    net.bias += float(np.log(prior / (1 - prior)))
    return net


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE,
        sample_bytes: int = SAMPLE_BYTES) -> Net | float:
    """Learns from labelled documents outside the held-out fold (crc32 of the id modulo 4 is 2).

    The sample is bounded: ``sample`` documents of each class at most, in the order of the hash of
    their ids, as far as their texts have ``sample_bytes`` together; a text of more than a quarter
    of that is not learned from. Class shares are counted over all learning rows. Rows that repeat
    id and text are learned from once. Without texts of both classes the smoothed share of label 1
    is the answer for every document.
    """
    rows = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id", 4, 2))
    rows = rows.select(F.col("doc_id").alias("id"), F.col(label).cast("int").alias("label"))
    rows = rows.join(docs.select(F.col("doc_id").alias("id")), "id", "left_semi")
    counts = dict(rows.groupBy("label").count().collect())
    prior = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
    if len(counts) < 2:
        return prior
    picked = [rows.where(F.col("label") == c).orderBy(F.xxhash64("id"), "id").limit(sample) for c in (0, 1)]
    texts = docs.select(F.col("doc_id").alias("id"), text_bytes(F.col("text")).alias("text"))
    found = texts.join(F.broadcast(picked[0].union(picked[1])), "id").where(F.octet_length("text") <= sample_bytes // 4)
    in_turn = Window.partitionBy("label").orderBy(F.xxhash64("id"), "id", "text")
    held = F.sum(F.octet_length("text")).over(in_turn.rowsBetween(Window.unboundedPreceding, 0))
    found = found.distinct().withColumn("held", held).where(F.col("held") <= sample_bytes)
    learned = sorted((r["id"], r["label"], bytes(r["text"])) for r in found.select("id", "label", "text").collect())
    if len({c for _, c, _ in learned}) < 2:
        return prior
    return train([t for _, _, t in learned], [c for _, c, _ in learned], prior)


def score(net: Net | float, text: Column) -> Column:
    """Probability of label 1 for the whole text; null counts as empty."""
    if not isinstance(net, Net):
        return F.lit(float(net))

    @F.pandas_udf("double")
    def probability(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            yield pd.Series([net.probability(t) for t in part], dtype="float64")

    return probability(text_bytes(text))


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, sample: int = SAMPLE) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    A null or empty text is scored like a text of padding. A null id is not held out and never
    learned from. Repeated rows give repeated rows, an empty table none; columns other than
    doc_id and text are ignored.
    """
    scored = docs.select("doc_id", score(fit(docs, labels, sample=sample), F.col("text")).alias("score"))
    return scored.select(
        "doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, sample: int = SAMPLE) -> DataFrame:
    """The documents that score at least ``threshold``, with all their columns. Each row is judged
    by its text alone, a null or empty one like a text of padding, so repeated rows stay or go
    together."""
    net = fit(docs, labels, sample=sample)
    return docs.where(score(net, F.col("text")) >= threshold)
