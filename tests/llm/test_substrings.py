"""Repeated bytes and passages against brute force, and their edge cases."""

import hashlib
import random

import __spark_entry__ as entry_points
import numpy as np
import pytest
from compare import compare, duck
from pyspark.sql import functions as F

from openloop.llm import recompression, suffixes

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, th string, first int"


def order_of(spark, rows):
    """Documents in order, as (id, text): null ids last, equal ids by the hash of the text."""
    ids = [r[0] for r in rows]
    repeated = len(set(ids)) < len(ids)
    df = spark.createDataFrame([(r[0], r[1]) for r in rows], "doc_id long, text string")
    df = df.select("doc_id", "text", F.xxhash64("text").alias("h")).distinct()
    found = [(r.doc_id is None, r.doc_id or 0, r.h if repeated else 0, r.doc_id, r.text) for r in df.collect()]
    return [(d, t) for *_, d, t in sorted(found, key=lambda r: r[:3])]


def cut(ordered, units, window, whole):
    """{(id, text): (units, removed, spans, digest of the rest)} by looking at every window."""
    seen, out = set(), {}
    for ident, text in ordered:
        u = units(text or "")
        gone = np.zeros(len(u) + 1, dtype=bool)
        for s in range(len(u) - window + 1):
            key = hashlib.md5(whole(u[s : s + window])).digest()
            if key in seen:
                gone[s : s + window] = True
            seen.add(key)
        spans = int((gone[:-1] & ~np.append(False, gone[:-2])).sum()) if len(u) else 0
        kept = whole([x for x, g in zip(u, gone) if not g])
        out[ident, text] = (len(u), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def bytes_cut(ordered):
    return cut(ordered, lambda t: t.encode(), 100, bytes)


def words_cut(ordered):
    return cut(ordered, lambda t: t.encode().split(), 20, b" ".join)


def rows():
    rng = random.Random(5)
    words = ["w%d" % n for n in range(40)] + ["é", "the", "the", "the"]

    def text(n):
        return " ".join(rng.choice(words) for _ in range(n))

    common, line = text(60), text(25)
    docs = [(n, f"{text(rng.randrange(30))} {common if n % 2 else line}\n{text(rng.randrange(60))}") for n in range(60)]
    base = text(300)
    for n in range(60, 90):
        cut_ = base.split(" ")
        cut_[rng.randrange(300)] = "edit"
        docs.append((n, " ".join(cut_[rng.randrange(40) :])))
    docs += [(90, "a" * 700), (91, "ab " * 300), (92, "a" * 450 + "b"), (93, "x " * 90), (94, "x " * 30 + "y")]
    docs += [(95, None), (96, ""), (97, " \n"), (98, base), (99, base), (100, f"{base} {base}"), (101, "\0" * 250)]
    docs += [(98, base), (98, common), (None, base), (None, f"{text(10)} {base}"), (None, None), (102, text(9000) + base)]
    return [(d, t, "x", None) for d, t in docs]


@pytest.mark.parametrize("hot, fold", [(2, 0), (20_000, 1500), (20_000, 8 << 20)])
@pytest.mark.parametrize("remove, brute", [
    (suffixes.remove_repeated_bytes, bytes_cut), (recompression.remove_repeated_passages, words_cut),
])
def test_against_every_window(spark, remove, brute, hot, fold):
    given = rows()
    expected = brute(order_of(spark, given))
    docs = spark.createDataFrame(given, SCHEMA).repartition(4)
    found = remove(docs, hot=hot, fold_bytes=fold).collect()
    result = sorted(
        (str(r.doc_id), r.n_units, r.n_removed, len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in found
    )
    assert result == sorted((str(d), *expected[d, t]) for d, t, *_ in given)
    assert all(b - a > 0 for r in found for a, b in r.spans)


@pytest.mark.parametrize("remove", [suffixes.remove_repeated_bytes, recompression.remove_repeated_passages])
def test_empty_table(spark, remove):
    assert remove(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("name, brute, spans", [
    ("op3_suffix_array_dedup", bytes_cut, True), ("op5_substring_dedup", words_cut, False),
])
def test_query_against_every_window(spark, name, brute, spans):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    expected = brute(sorted((r.doc_id, r.text) for r in docs))
    found = entry_points.queries()[name](spark, SF_DIR).collect()
    assert len(found) == len(docs)
    by_id = {d: v for (d, _), v in expected.items()}
    got = {r.doc_id: tuple(r)[1:] for r in found}
    assert got == {d: v if spans else (v[0], v[1], v[3]) for d, v in by_id.items()}


@pytest.mark.parametrize("name", ["op3_suffix_array_dedup", "op5_substring_dedup"])
def test_query_matches_sql(spark, name):
    result = entry_points.queries()[name](spark, SF_DIR)
    assert compare(result, entry_points.oracle_sql()[name], duck(SF_DIR)) == []


@pytest.mark.parametrize("letters, n", [(1, 400), (2, 900), (3, 2000), (250, 3000)])
def test_suffix_array_in_order(letters, n):
    rng = np.random.default_rng(n)
    symbols = rng.integers(1, letters + 1, n).astype(np.uint16)
    symbols[rng.integers(0, n, 9)] = 0
    symbols[-1] = 0
    order = suffixes.suffix_array(symbols).tolist()
    assert sorted(order) == list(range(n))
    data = symbols.tolist()
    heads = [data[i : i + suffixes.WINDOW] for i in order]
    assert all(a <= b for a, b in zip(heads, heads[1:]))


def test_symbols_inside_a_passage_do_not_depend_on_what_surrounds_it():
    rng = np.random.default_rng(2)
    for vocabulary in (2, 5, 500):
        passage = rng.integers(0, vocabulary, 20).astype(np.uint64)
        seen = set()
        for _ in range(60):
            before, after = (rng.integers(0, vocabulary, rng.integers(0, 30)).astype(np.uint64) for _ in range(2))
            names, starts, lengths = recompression.recompressed(np.concatenate([before, passage, after]))
            inside = (starts >= len(before) + 4) & (starts + lengths <= len(before) + 16)
            seen.add(tuple(zip((starts[inside] - len(before)).tolist(), names[inside].tolist())))
        own = set.intersection(*(set(s) for s in seen))
        assert own and all(4 <= at for at, _ in own)
        assert len({tuple(x for x in s if x[0] <= 12) for s in seen}) == 1


@pytest.mark.parametrize("remove, brute", [
    (suffixes.remove_repeated_bytes, bytes_cut), (recompression.remove_repeated_passages, words_cut),
])
def test_ids_order_by_their_own_type(spark, remove, brute):
    """Text ids order as text (10 before 9), dates as dates."""
    rng = random.Random(8)
    base = " ".join(f"v{rng.randrange(10**6)}" for _ in range(60))
    given = [(name, f"{name} {base}" if k % 3 else base) for k, name in enumerate(["9", "10", "a-1", "B", "", "é"])]
    given += [(None, base), ("10", base), ("c", None)]
    docs = spark.createDataFrame(given, "doc_id string, text string")
    # Rows that share an id order by the hash of their text, which Spark knows.
    ranked = docs.withColumn("h", F.xxhash64("text")).distinct().collect()
    order = sorted(ranked, key=lambda r: (r.doc_id is None, (r.doc_id or "").encode(), r.h))
    expected = brute([((r.doc_id, r.text), r.text) for r in order])
    expected = {key[0]: value for key, value in expected.items()}
    found = sorted((str(r.doc_id), r.n_units, r.n_removed) for r in remove(docs).collect())
    assert found == sorted((str(d), *expected[d, t][:2]) for d, t in given)
    days = docs.where("doc_id IN ('9', 'B')").withColumn("doc_id", F.expr("if(doc_id = '9', date'2024-01-02', date'2023-05-06')"))
    assert {str(r.doc_id): r.n_removed > 0 for r in remove(days).collect()} == {"2024-01-02": True, "2023-05-06": False}
