"""Exact and SimHash duplicates against brute force, and their edge cases."""

import hashlib
import random
import re
from collections import defaultdict

import __spark_entry__ as entry_points
import pytest
import xxhash
from compare import compare, duck
from pyspark.sql import functions as F

from openloop.llm import exact, simhash
from openloop.llm.components import components

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, fp string, kept int"
SPACE = re.compile(r"[\x20\x09-\x0D]+")


def grouped(pairs, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def bits(text, width=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    cut = [" ".join(words[k : k + width]) for k in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64(c.encode(), seed=42).intdigest() for c in cut]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


ROWS = [
    (5, "a  b", "x", 1), (3, "a\tb", None, 2), (9, "a b", "x", None), (None, "a b", "x", 1),
    (4, None, None, None), (6, "", "x", 1), (7, " \n", "x", 1), (8, " ", "x", 1),
    (1, "lone", "x", 1), (1, "lone", "x", 1), (None, "known to none", None, None),
    (11, "w " * 200_000, "x", 1), (12, "É b", "x", 1), (13, "É b", "x", 1),
]


def test_exact_matches_sql(spark):
    result = entry_points.queries()["op4_exact_dedup"](spark, SF_DIR)
    assert compare(result, entry_points.oracle_sql()["op4_exact_dedup"], duck(SF_DIR)) == []


@pytest.mark.parametrize("limit", [0, 7, exact.TRIE_BYTES])
def test_exact_edge_cases(spark, limit):
    groups = defaultdict(list)
    for ident, text, *_ in ROWS:
        groups[SPACE.sub(" ", text or "")].append(ident)
    expected = []
    for text, idents in groups.items():
        known = [i for i in idents if i is not None]
        keep = min(known) if known else None
        digest = hashlib.sha256(text.encode()).hexdigest()
        expected += [(i, keep, len(idents), i == keep, digest) for i in idents]
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    found = [tuple(r) for r in exact.exact_dedup(docs, limit=limit).collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)
    assert exact.exact_dedup(docs.where("false")).count() == 0
    kept = exact.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "1", "11", "12", "13", "3", "4", "7", "None"]


def test_trie_holds_strings_with_common_prefixes():
    rng = random.Random(1)
    trie, expected = exact.Trie(), {}
    for n in range(3000):
        text = bytes(rng.choice(b"ab") for _ in range(rng.randrange(9)))
        trie.add(text, n, 1)
        expected.setdefault(text, [n, 0, 0])[1] += 1
    assert dict(trie.pop()) == expected


@pytest.mark.parametrize("bucket", [3, simhash.BUCKET])
def test_links_connect_what_all_pairs_connect(spark, bucket):
    rng = random.Random(7)
    fps = set()
    for _ in range(12):
        seed = rng.getrandbits(64)
        for _ in range(25):
            value = seed
            for b in rng.sample(range(64), rng.randrange(7)):
                value ^= 1 << b
            fps.add(value)
    fps = sorted(v - (1 << 64) if v >> 63 else v for v in fps)
    mask = (1 << 64) - 1
    pairs = [(a, b) for a in fps for b in fps if a < b and ((a ^ b) & mask).bit_count() <= 3]
    found = simhash.links(spark.createDataFrame([(v,) for v in fps], "fp long"), bucket=bucket).collect()
    assert all(((a ^ b) & mask).bit_count() <= 3 for a, b in found)
    assert grouped(found, fps) == grouped(pairs, fps)


def test_components_of_chains_and_stars(spark):
    rng = random.Random(3)
    pairs = [(n, n + 1) for n in range(40)] + [(100, n) for n in range(101, 160)] + [(7, 7)]
    pairs += [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    found = dict(components(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect())
    nodes = {n for a, b in pairs if a != b for n in (a, b)}
    assert found == {n: r for n, r in grouped(pairs, sorted(nodes)).items()}


def test_simhash_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    prints = {r.doc_id: bits(r.text) for r in docs}
    pairs = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    expected = {(d, f"{prints[d]:016x}", c) for d, c in grouped(pairs, sorted(prints)).items()}
    found = entry_points.queries()["op1_simhash_near_dedup"](spark, SF_DIR).collect()
    assert {tuple(r) for r in found} == expected and len(found) == len(docs)


def test_simhash_edge_cases(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    found = simhash.simhash_components(docs).collect()
    assert len(found) == len(ROWS)
    by_id = {r.doc_id: r for r in found}
    assert {by_id[n].fingerprint for n in (4, 6, 7, 8)} == {"0" * 16}
    assert {by_id[n].component_id for n in (4, 6, 7, 8)} == {4}
    assert {by_id[n].component_id for n in (3, 5, 9)} == {3}
    assert {(r.doc_id, r.fingerprint) for r in found} == {(i, f"{bits(t):016x}") for i, t, *_ in ROWS}
    assert simhash.simhash_components(docs.where("false")).count() == 0
    kept = simhash.keep_one_per_component(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.where(F.col("doc_id").isNotNull()).collect()} >= {1, 3, 4, 11}


def test_whole_long_text_counts():
    text = b" ".join(b"w%d" % (n % 977) for n in range(simhash.BLOCK + 500))
    assert simhash.fingerprint(text) == bits(text.decode())


def test_a_scan_task_holds_labels_only():
    """Texts of 1 MB with a common beginning: what is resident follows the labels, and what a spill
    releases goes out text by text."""
    import tracemalloc

    import pyarrow as pa

    prefix, n = b"boilerplate " * 90_000, 40

    def batches():
        for k in range(n):
            columns = [pa.array([k], pa.int64()), pa.array([prefix + b"%d" % k], pa.binary()), pa.array([k], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["text_hash", "normal", "keep_id"])

    for limit in (exact.TRIE_BYTES, 1 << 20):
        tracemalloc.start()
        seen = {}
        for batch in exact._fold_scan(limit)(batches()):
            for row in batch.to_pylist():
                assert row["text_hash"] == row["keep_id"] and row["n_bytes"] == len(row["normal"])
                seen[row["keep_id"]] = row["normal"][len(prefix):]
            del batch, row
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert seen == {k: b"%d" % k for k in range(n)}
        assert peak < 16 << 20 < n * len(prefix) // 2
