"""Manifest, line dedup and spelling variants against SQL and brute force, and their edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import __spark_entry__ as entry_points
import pytest
from compare import compare, duck
from pyspark.sql import functions as F

from openloop.llm import lines, merkle, spelling

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op12_line_dedup", "op13_spelling_variants"])
def test_query_matches_sql(spark, name):
    result = entry_points.queries()[name](spark, SF_DIR)
    assert compare(result, entry_points.oracle_sql()[name], duck(SF_DIR)) == []


# Manifest ------------------------------------------------------------------------------------

DOCS = "doc_id long, text string, lang string, source string, n_chars long, digest string, at int"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, n_chars):
    values = [row[0], row[3], row[2], n_chars, row[1]]
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """The root of ``nodes`` and for each its (siblings, sides) up to the root."""
    above, owners = [([], []) for _ in nodes], [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        new, new_owners = [], []
        for k in range(0, len(nodes), 2):
            pair = nodes[k : k + 2]
            for side in range(len(pair)):
                for leaf in owners[k + side]:
                    above[leaf][0].append("".join(pair[:side] + pair[side + 1 :]))
                    above[leaf][1].append(side)
            new.append(digest("".join(pair)))
            new_owners.append(sum(owners[k : k + 2], []))
        nodes, owners = new, new_owners
    return nodes[0], above


def manifest_by_hand(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append((row[0] is not None, row[0] or 0, leaf_of(row, row[4]), row))
    names = sorted(groups, key=lambda n: (n is not None, (n or "").encode()))
    lower = {name: tree([entry[2] for entry in sorted(groups[name], key=lambda e: e[:3])]) for name in names}
    root, upper = tree([lower[name][0] for name in names])
    out = Counter()
    for k, name in enumerate(names):
        subroot, above = lower[name]
        for (_, _, leaf, row), (siblings, sides) in zip(sorted(groups[name], key=lambda e: e[:3]), above):
            now = leaf
            if row[0] is not None and row[4] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0:
                now = leaf_of(row, row[4] + 1)
            for sibling, side in zip(siblings + upper[k][0], sides + upper[k][1]):
                now = digest(sibling + now if side else now + sibling)
            proof = digest("".join(siblings + upper[k][0]))
            out[row[0], leaf, subroot, root, proof, now, now == root] += 1
    return out


def some_rows(rng, n):
    langs = [None, "", "de", "en", "en", "en", "en", "ü", "x" * 50]
    rows = [
        (rng.choice([None, rng.randrange(n)]) if k % 9 == 0 else k, rng.choice([None, "", "ab", "é\n"]),
         rng.choice(langs), rng.choice([None, "s"]), rng.choice([None, k]), "extra", k)
        for k in range(n)
    ]
    return rows + rows[:3] + [(n + 7, "w " * 300_000, "only", "s", 1, None, None)]


@pytest.mark.parametrize("bits, n", [(1, 40), (2, 173), (3, 90), (merkle.BITS, 60)])
def test_manifest_by_hand(spark, bits, n):
    rows = some_rows(random.Random(n), n)
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    found = merkle.manifest(docs, given={"n_chars": tampered}, bits=bits)
    expected = manifest_by_hand(rows)
    assert Counter(tuple(r) for r in found.collect()) == expected
    assert {key[-1] for key in expected} == {True, False}


def test_manifest_of_few_or_no_rows(spark):
    none = spark.createDataFrame([], DOCS)
    assert merkle.manifest(none).count() == 0
    rows = [(1, "a", None, None, 1, None, 0)]
    (found,) = merkle.manifest(spark.createDataFrame(rows, DOCS)).collect()
    assert found.leaf == found.subroot == found.root == found.folded_root and found.verified
    assert found.proof_sha256 == digest("")
    rows.append((2, "a", "en", None, 1, None, 0))
    assert {tuple(r) for r in merkle.manifest(spark.createDataFrame(rows, DOCS), bits=1).collect()} == set(
        k[:5] + (k[3], True) for k in manifest_by_hand(rows)
    )


def test_frontier_extends_witnesses_as_subtrees_complete():
    for n in range(1, 20):
        nodes = [hashlib.sha256(bytes([k])).digest() for k in range(n)]
        frontier = merkle.Frontier()
        for node in nodes:
            frontier.append(node)
            assert [level for level, _, _ in frontier.open] == sorted({level for level, _, _ in frontier.open}, reverse=True)
        root = frontier.close((n - 1).bit_length())
        for at, node in enumerate(nodes):
            assert merkle.fold(node, at, n, iter(frontier.witnesses[at])) == root


# Lines ---------------------------------------------------------------------------------------


def lines_by_hand(rows, least, shortest):
    holders = Counter()

    def key(line):
        return re.sub("[A-Z]+", lambda m: m[0].lower(), line.strip(" \t\n\x0b\f\r"))

    for _, text in rows:
        holders.update({key(x) for x in (text or "").split("\n")})
    out = Counter()
    for ident, text in rows:
        whole = (text or "").split("\n")
        kept = [x for x in whole if len(key(x)) < shortest or holders[key(x)] < least]
        out[ident, len(whole), len(whole) - len(kept), "\n".join(kept)] += 1
    return out


def line_rows(rng):
    pool = ["Home", " home\t", "HOME ", "É", "é", "", "  ", "x", "a\rb", "menu | login"] + [f"line {k}" for k in range(40)]
    rows = [(k, "\n".join(rng.choice(pool) for _ in range(rng.randrange(9)))) for k in range(120)]
    rows += [(None, None), (None, "Home\nx"), (7, None), (8, ""), (9, "\n"), (3, rows[3][1]), (3, rows[3][1]), (3, "other\nhome")]
    return rows + [(500, "\n".join(f"own {k % 7000}" for k in range(50_000)) + "\nhome"), (501, "home\n" * 40 + "end")]


@pytest.mark.parametrize("least, shortest, batches, fanout", [(10, 1, 4, 2), (3, 2, 1, 2), (12, 1, 7, 3), (1, 1, 3, 2), (10**6, 1, 2, 2)])
def test_lines_by_hand(spark, least, shortest, batches, fanout):
    rows = line_rows(random.Random(least))
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n int, h1 string").repartition(3)
    found = lines.drop_common_lines(docs, least=least, shortest=shortest, batches=batches, fanout=fanout)
    assert Counter(tuple(r) for r in found.collect()) == lines_by_hand(rows, least, shortest)


def test_lines_of_hot_and_other_keys(spark, monkeypatch):
    # With a bound of 20 rows for a broadcast, only keys in a twentieth of all lines are broadcast.
    monkeypatch.setattr(lines, "MOST_BROADCAST_ROWS", 20)
    rows = [(f"d{k}", "\n".join(["everywhere", f"pair {k // 5}", f"own {k}"])) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    found = lines.drop_common_lines(docs, least=5)
    assert Counter(tuple(r) for r in found.collect()) == lines_by_hand(rows, 5, 1)
    assert lines.drop_common_lines(docs.where("false")).count() == 0


def test_runs_are_levelled_and_taken_up_again(spark):
    runs = lines.LineRuns(spark, least=3, fanout=2, buckets=4)
    seen, totals = [], Counter()
    for batch in range(7):
        keys = [k for k in range(30) if (k * 7 + batch) % 5 < 2 or k == 0]
        totals.update(keys)
        runs.add(spark.createDataFrame([(k, -k) for k in keys], "h1 long, h2 long"))
        seen.append([len(level) for level in runs.levels])
        again = lines.LineRuns(spark, least=3, name=runs.name, fanout=2, buckets=4, levels=runs.levels)
        assert {r.h1 for r in again.settled().collect()} == {k for k, n in totals.items() if n >= 3}
    # As the digits of a binary counter: no level keeps two runs.
    assert seen == [[1], [0, 1], [1, 1], [0, 0, 1], [1, 0, 1], [0, 1, 1], [1, 1, 1]]
    # Settled keys are not added again: the last batch's run has none of them.
    newest = spark.table(runs.levels[0][0])
    assert 0 not in {r.h1 for r in newest.collect()}
    plan = newest.join(spark.table(runs.levels[1][0]), lines.HASH, "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan
    names = [n for level in runs.levels for n in level]
    runs.drop()
    assert not any(spark.catalog.tableExists(n) for n in names)


# Words ---------------------------------------------------------------------------------------


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def words_by_hand(rows, shortest, least, times):
    counts = Counter()
    for ident, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]+", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if ident is None else ident}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= shortest and n >= least}
    mates = {w: [o for o in words if near(w, o)] for w in words}
    form = {}
    for w, others in mates.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= times * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, words[w], len(mates[w]), words[form[w]] if form[w] else None))
    return out


def word_rows(rng):
    letters = "abcdeé×ÿ"
    bases = ["".join(rng.choice(letters) for _ in range(rng.randrange(3, 12))) for _ in range(30)]
    bases += ["aaaaaaaa", "aaaaaaab", "abababab", "babababa"]
    out = []
    for k in range(250):
        words = []
        for _ in range(rng.randrange(30)):
            w = rng.choice(bases[: 1 + rng.randrange(len(bases))])
            if rng.random() < 0.2:
                at = rng.randrange(len(w))
                w = w[:at] + rng.choice(["", rng.choice(letters), w[at] + rng.choice(letters)]) + w[at + 1 :]
            words.append(w.upper() if rng.random() < 0.1 else w)
        out.append((k, rng.choice([" ", "1", "\n", "-"]).join(words)))
    return out + [(None, out[0][1]), (3, out[3][1]), (5, None), (6, ""), (7, "日本語 123")]


@pytest.mark.parametrize("shortest, least, times", [(7, 2, 10), (2, 1, 2), (1, 1, 1 + 10**9)])
def test_words_by_hand(spark, shortest, least, times):
    rows = word_rows(random.Random(shortest))
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, n int").repartition(4)
    found = spelling.spelling_groups(docs, shortest=shortest, least=least, times=times)
    expected = words_by_hand(rows, shortest, least, times)
    assert {tuple(r) for r in found.collect()} == expected
    assert max(row[4] for row in expected) > 3
    assert spelling.spelling_groups(docs.where("false")).count() == 0


def test_words_in_portions(spark, monkeypatch):
    monkeypatch.setattr(spelling, "STEP", 5)
    rows = word_rows(random.Random(3))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = spelling.words_of(docs, "doc_id", "text", 7, 2, held=3)
    assert {tuple(r) for r in found.collect()} == {(r[0], r[3]) for r in words_by_hand(rows, 7, 2, 10)}
    assert spelling.runs_of(("Zebra" * 9).encode(), 7) == {"zebra" * 9: 1}


def test_signatures_meet_for_every_edit():
    rng = random.Random(2)
    for _ in range(300):
        word = "".join(rng.choice("abcé") for _ in range(rng.randrange(1, 12)))
        at = rng.randrange(len(word))
        replaced, longer = word[:at] + "z" + word[at + 1 :], word[:at] + rng.choice("abcéz") + word[at:]
        a, b, c = spelling.signatures([word, replaced, longer])
        same, one = 2 * len(spelling.TWO), 2 * len(spelling.ONE)
        assert set(a[:same]) & set(b[:same])
        assert set(a[same : same + one]) & set(c[same + one :])
