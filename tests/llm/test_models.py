"""Trained models: the answers of their queries against plain loops over the same parameters."""

import math
import re
import zlib
from collections import Counter, defaultdict

import __spark_entry__ as entry_points
import pytest

from openloop.llm import langid, quality_net

SF_DIR = "/root/testdata/sf0.01"


def crc(ident, folds):
    return zlib.crc32(str(ident).encode()) % folds


def plain_probability(net, text):
    """One chunk, one filter, one byte after the other."""
    vectors, filters = net.vectors.tolist(), net.filters.T.tolist()
    best = [-math.inf] * quality_net.FILTERS
    starts = range(0, max(1, len(text) - quality_net.CHUNK + quality_net.STEP), quality_net.STEP)
    for start in starts:
        chunk = text[start : start + quality_net.CHUNK].ljust(quality_net.CHUNK, b"\0")
        seen = [x for byte in chunk for x in vectors[byte]]
        for f, weights in enumerate(filters):
            best[f] = max(best[f], sum(map(float.__mul__, seen, weights)))
    total = net.bias + sum(max(0.0, b + s) * w for b, s, w in zip(best, net.shift.tolist(), net.weights.tolist()))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, total))))


def test_quality_query_against_plain_loops(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    net = quality_net.fit(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    found = {r.doc_id: r for r in entry_points.queries()["op2_quality_classifier"](spark, SF_DIR).collect()}
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    assert set(found) == set(texts)
    for ident, r in found.items():
        assert r.held_out == (crc(ident, 4) == 2) and r.predicted == (r.score >= 0.7)
        if len(texts[ident]) < 1500:
            assert r.score == pytest.approx(plain_probability(net, texts[ident]), abs=1e-4)


def test_learning_sample_is_bounded_in_bytes(spark, monkeypatch):
    rows = [(n, "good " * 20 if n % 2 else "bad! " * 20, n % 2) for n in range(60) if crc(n, 4) != 2]
    rows += [(n, "long " * 500, n % 2) for n in range(60, 80) if crc(n, 4) != 2]
    rows += rows[:5]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows[:-5]], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality_net, "train", lambda texts, labels, prior: seen.append(list(zip(texts, labels))))
    quality_net.fit(docs, labels, sample_bytes=1000)  # ten texts of 100 bytes a class, no long one
    quality_net.fit(docs, labels)
    for c in (0, 1):
        assert sorted(len(t) for t, label in seen[0] if label == c) == [100] * 10
        assert len([1 for _, label in seen[1] if label == c]) == len({r[0] for r in rows if r[2] == c})
    share = (sum(r[2] for r in rows[:-5]) + 1) / (len(rows) - 5 + 2)
    counted = quality_net.fit(docs, labels, sample_bytes=0)
    assert counted == pytest.approx(share) and len(seen) == 2


def test_language_query_against_plain_trees(spark):
    order = langid.ORDER
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    learned = defaultdict(list)
    for r in docs:
        if r.lang is not None and r.text is not None and crc(r.doc_id, 3) != 1:
            learned[r.lang].append(b"\n" * order + r.text.encode())
    assert max(map(len, learned.values())) <= langid.SAMPLE  # so every learning document is learned from
    trees = {}
    for lang, texts in learned.items():
        trees[lang] = [defaultdict(Counter) for _ in range(order + 1)]
        for t in texts:
            for i in range(order, len(t)):
                for k in range(order + 1):
                    trees[lang][k][t[i - k : i]][t[i]] += 1
    sizes = {lang: [{c: sum(n.values()) for c, n in level.items()} for level in tree] for lang, tree in trees.items()}

    def bits(text, lang):
        total, text = 0.0, b"\n" * order + text
        for i in range(order, len(text)):
            for k in range(order, -1, -1):
                context = text[i - k : i]
                seen = trees[lang][k].get(context)
                if seen:
                    size = sizes[lang][k][context] + len(seen)
                    if text[i] in seen:
                        total -= math.log2(seen[text[i]] / size)
                        break
                    total -= math.log2(len(seen) / size)
            else:
                total += 8
        return total

    found = {r.doc_id: r for r in entry_points.queries()["op6_language_id"](spark, SF_DIR).collect()}
    looked_at = 0
    for r in docs:
        if r.text is None or not re.search(r"[^\W\d_]", r.text):
            assert (found[r.doc_id].lang_pred, found[r.doc_id].score) == ("und", 0.0)
        elif len(r.text) < 600:
            lengths = {lang: bits(r.text.encode(), lang) for lang in sorted(trees)}
            best = min(lengths, key=lengths.get)
            looked_at += 1
            if sorted(lengths.values())[1] - lengths[best] > 1e-2:
                assert found[r.doc_id].lang_pred == best
            share = 1 / sum(2 ** max(-1000, lengths[best] - b) for b in lengths.values())
            assert found[r.doc_id].score == pytest.approx(share, rel=1e-2)
    assert looked_at > 100
