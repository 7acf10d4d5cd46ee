"""The near-duplicate stage of the pipeline against Jaccard similarities of all pairs."""

import random
import re
from collections import defaultdict

import corpus_pipeline
import numpy as np
import pytest
from test_dedup import ROWS, SCHEMA, grouped

from openloop.llm import similar

SF_DIR = "/root/testdata/sf0.01"


def five(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return {" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def alike(texts):
    """The pairs of {id: text} whose Jaccard similarity is 0.8 or more."""
    sets, holders, shared = {i: five(t) for i, t in texts.items()}, defaultdict(list), defaultdict(int)
    for i in sorted(sets):
        for shingle in sets[i]:
            for other in holders[shingle]:
                shared[other, i] += 1
            holders[shingle].append(i)
    return [(a, b) for (a, b), n in shared.items() if 5 * n >= 4 * (len(sets[a]) + len(sets[b]) - n)]


def families(rng):
    """Texts of 30 to 300 words with copies in which some words are changed."""
    texts = {}
    for n in range(25):
        words = [f"v{rng.randrange(5000)}" for _ in range(rng.randrange(30, 300))]
        for copy in range(rng.randrange(1, 9)):
            edited = list(words)
            for _ in range(round(len(words) * rng.choice([0.005, 0.01, 0.02, 0.04]))):
                edited[rng.randrange(len(words))] = f"x{rng.randrange(5000)}"
            texts[100 * n + copy] = " ".join(edited)
    return texts


@pytest.mark.parametrize("run, together", [(2, 1), (similar.RUN, 40), (similar.RUN, similar.TOGETHER)])
def test_links_connect_all_candidates(run, together, monkeypatch):
    monkeypatch.setattr(similar, "RUN", run)
    prints = np.array([similar.fingerprint({s.encode() for s in five(t)}) for t in families(random.Random(5)).values()])
    prints = np.unique(prints, axis=0)
    first = min(16, max(2, (len(prints) // together).bit_length()))
    found, expected = [], []
    for number in range(16):
        values = similar._segment(prints, number).tolist()
        for bit in range(-1, first):
            meet = defaultdict(list)
            for place, value in enumerate(values):
                top = value >> (16 - first)
                meet[top & ~(1 << bit) if bit >= 0 else top].append(place)
            for places in meet.values():
                key = (number * 17 + bit + 1) << 16
                for a, b in similar._met(prints[places], key, first):
                    found += [(places[i], places[j]) for i, j in zip(a.tolist(), b.tolist())]
        expected += [
            (a, b) for a in range(len(prints)) for b in range(a)
            if (values[a] ^ values[b]).bit_count() <= 1
            and sum((int(x) ^ int(y)).bit_count() for x, y in zip(prints[a], prints[b])) <= similar.DISTANCE
        ]
    assert expected and grouped(found, range(len(prints))) == grouped(expected, range(len(prints)))


@pytest.mark.parametrize("together, room", [(1, similar.ROOM), (similar.TOGETHER, similar.ROOM), (similar.TOGETHER, 300)])
def test_stage_links_exactly_what_is_similar(spark, together, room):
    texts = families(random.Random(11))
    roots = grouped(alike(texts), sorted(texts))
    assert 25 < len(set(roots.values())) < len(texts)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    kept = sorted(r.doc_id for r in similar.keep_one_of_similar(docs, together=together, room=room).collect())
    assert kept == sorted(set(roots.values()))


def test_pipeline_stage_against_all_pairs(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("trim(text) != ''")
    texts = {r.doc_id: r.text for r in docs.collect()}
    roots = grouped(alike(texts), sorted(texts))
    stage = dict(corpus_pipeline.STAGES)["simhash near-dedup"]
    assert sorted(r.doc_id for r in stage(spark, docs, SF_DIR).collect()) == sorted(set(roots.values()))


@pytest.mark.parametrize("cut, together", [(similar.Cut(20, 30), 1), (similar.Cut(27, 60), 1), (similar.Cut(16, 19), 40)])
def test_other_cuts_link_all_candidates(spark, cut, together, monkeypatch):
    monkeypatch.setattr(similar, "cut_for", lambda fingerprints: cut)
    texts = families(random.Random(5)).values()
    prints = np.unique([similar.fingerprint({s.encode() for s in five(t)}) for t in texts], axis=0)
    bits = np.unpackbits(prints.view(np.uint8), axis=1, bitorder="little")
    apart = [bits[:, cut.bits(number)] for number in range(cut.segments)]
    expected = [
        (a, b) for a in range(len(prints)) for b in range(a)
        if (bits[a] != bits[b]).sum() <= similar.DISTANCE and any((x[a] != x[b]).sum() <= 1 for x in apart)
    ]
    nodes = similar._nodes(prints).tolist()
    fps = spark.createDataFrame(prints.view(np.int64).tolist(), "w0 long, w1 long, w2 long, w3 long")
    found = [(nodes.index(r.a), nodes.index(r.b)) for r in similar._links(fps, together).collect()]
    assert expected and grouped(found, range(len(prints))) == grouped(expected, range(len(prints)))


@pytest.mark.parametrize("count", [0, 1, 2**28, 2**28 + 1, 10**9, 3 * 10**10])
def test_buckets_do_not_grow_and_recall_does_not_fall(count):
    cut = similar.cut_for(count)
    assert count / 2**cut.width <= similar.BUCKET and similar.expected_recall(cut) >= similar.RECALL
    assert cut.segments * (cut.width + 1) << cut.width < 2**63
    used = np.concatenate([cut.bits(number) for number in range(256 // cut.width)])
    assert len(set(used.tolist())) == len(used)


@pytest.mark.parametrize("cut", [similar.Cut(), similar.Cut(16, 8), similar.Cut(20, 12), similar.cut_for(10**9)])
def test_pairs_meet_as_often_as_expected(cut):
    """1,500 pairs of sets at Jaccard 0.8: 180 shared, 22 or 23 of each side's own."""
    rng, met = random.Random(3), 0
    for _ in range(1500):
        both = [rng.randbytes(8) for _ in range(180)]
        pair = [similar.fingerprint({*both, *(rng.randbytes(8) for _ in range(n))}) for n in (22, 23)]
        x, y = (np.unpackbits(p.view(np.uint8), bitorder="little") for p in pair)
        differ = x != y
        met += differ.sum() <= similar.DISTANCE and any(differ[cut.bits(k)].sum() <= 1 for k in range(cut.segments))
    assert abs(met / 1500 - similar.expected_recall(cut)) < 0.03


def test_edge_cases(spark):
    docs = spark.createDataFrame([*ROWS, (15, "one two three four five six", "x", 1), (14, "One two three four five seven", "x", 1)], SCHEMA)
    kept = similar.keep_one_of_similar(docs)
    assert kept.schema == docs.schema
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "1", "11", "12", "13", "14", "15", "3", "4", "None"]
    assert similar.keep_one_of_similar(docs.where("false")).count() == 0


def test_a_task_tells_each_link_once():
    rng = random.Random(1)
    forest, told, pairs = similar.Forest(), [], []
    for _ in range(30):
        some = [(rng.randrange(200), rng.randrange(200)) for _ in range(40)]
        pairs += some
        told += forest.joining(some)
    nodes = sorted({n for pair in pairs for n in pair})
    assert grouped(told, nodes) == grouped(pairs, nodes)
    assert len(told) == len(nodes) - len(set(grouped(pairs, nodes).values()))
    small = similar.Forest(limit=5)
    again = [link for pair in pairs for link in small.joining([pair])]
    assert grouped(again, nodes) == grouped(pairs, nodes)


def test_links_of_a_large_group_are_few(spark):
    base = [f"v{k}" for k in range(400)]
    rng, prints = random.Random(4), []
    for _ in range(600):
        words = list(base)
        words[rng.randrange(400)] = f"x{rng.randrange(10**6)}"
        prints.append(similar.fingerprint(similar.shingles(" ".join(words).encode(), 5)).view("int64").tolist())
    fps = spark.createDataFrame(prints, "w0 long, w1 long, w2 long, w3 long").distinct()
    found = similar._links(fps, similar.TOGETHER)
    tasks = found.rdd.getNumPartitions()
    assert 0 < found.count() <= tasks * (fps.count() - 1)


def test_chain_of_near_copies_is_one_group():
    sets = [similar.numbers({b"%d" % x for x in range(5 * k, 5 * k + 100)}) for k in range(40)]
    assert len(set(similar.similar_groups(sets, similar.Fraction(4, 5)))) == 1
    assert len(set(similar.similar_groups(sets[::9], similar.Fraction(4, 5)))) == len(sets[::9])
    empty = [similar.numbers(set())] * 2
    assert len(set(similar.similar_groups(empty + sets[:1], similar.Fraction(4, 5)))) == 2


def test_large_groups_are_decided_as_in_one_task(spark):
    """A chain whose ends differ, many copies of one text, loose texts, an empty one: one group."""
    rng = random.Random(8)
    sets = [{b"c%d" % x for x in range(6 * k, 6 * k + 100)} for k in range(60)]
    base = [b"b%d" % x for x in range(120)]
    sets += [{*base, *(b"%d" % rng.randrange(10**6) for _ in range(5))} - {rng.choice(base)} for _ in range(500)]
    sets += [{*base[:n], *(b"o%d" % rng.randrange(40) for _ in range(30))} for n in range(70, 120)]
    sets += [{b"l%d" % rng.randrange(300) for _ in range(60)} for _ in range(40)]
    packed = sorted({similar.numbers(s).tobytes() for s in [*sets, set()]})
    groups = similar.similar_groups([np.frombuffer(p, np.uint64) for p in packed], similar.Fraction(4, 5))
    assert 10 < len(set(groups)) < 200
    rows = [(1, b"%016d" % k, None if k % 50 == 0 else k, p) for k, p in enumerate(packed)]
    first = defaultdict(list)
    for g, (*_, k, _) in zip(groups, rows):
        first[g] += [k] if k is not None else []
    expected = {mark: min(first[g], default=None) for g, (_, mark, *_) in zip(groups, rows)}
    table = spark.createDataFrame(rows, "group long, mark binary, first long, shingles binary").repartition(4)
    sizes = table.selectExpr("group", "length(shingles) div 8 AS n").groupBy("group").agg({"n": "sum"}).toDF("group", "size")
    for room in (2000, 10**9):
        kept = similar.kept_of_large(table, sizes, room, similar.Fraction(4, 5)).collect()
        assert {bytes(r.mark): r.kept for r in kept} == expected and len(kept) == len(rows)
    assert similar.kept_of_large(table.where("false"), sizes, 5, similar.Fraction(4, 5)).count() == 0
