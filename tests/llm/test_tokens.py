"""Edit-aware token counts against encoding whole texts."""

import random

import __spark_entry__ as entry_points
import pytest
from pyspark.sql import functions as F

from openloop.llm.token_leaves import follow_edits, token_leaves, tokens_of
from openloop.llm.tokens import RANKS, Counter, TokenTree, count_tokens
from openloop.llm import queries

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def counter():
    with open(RANKS, "rb") as file:
        return Counter(file.read())


def whole(counter, text):
    return len(counter.encoding.encode_ordinary(text))


def test_edits_agree_with_encoding_again(counter):
    rng = random.Random(4)
    parts = ["the", " ", "  ", "\n", "'", "'re", "re", "l", "l'l", "12", "é", "...", "x" * 30, "\t \n", "it's", " of"]
    for size in (0, 1, 5, 60, 900, 5000):
        text = "".join(rng.choice(parts) for _ in range(size))
        tree = TokenTree.of(text, counter)
        for _ in range(60):
            start = rng.randrange(len(text) + 1)
            inserted = "".join(rng.choice(parts) for _ in range(rng.randrange(6)))
            text, again = tree.edit(text, start, rng.choice([0, 0, 1, 3, 40]), inserted, counter)
            assert tree.tokens == whole(counter, text)
            assert tree.leaf_lists()[0] and sum(tree.leaf_lists()[0]) == len(text) or not text
            if size == 5000:
                assert again < 400


def test_query_against_brute_force(spark, counter):
    seen = {r.doc_id: r for r in entry_points.queries()["op7_token_counts"](spark, SF_DIR).collect()}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    assert len(seen) == len(docs)
    for r in docs:
        assert seen[r.doc_id].n_tokens == whole(counter, r.text) and seen[r.doc_id].n_edits == 3
    assert sum(r.reencoded for r in seen.values()) < sum(r.n_tokens for r in seen.values())
    assert "op7_token_counts" in queries.QUERIES


def test_edge_cases(spark, counter):
    edit = "array<struct<start:int,removed:int,inserted:string>>"
    rows = [
        (1, None, [(0, 5, "new text"), (99, -1, "!")], "a"), (2, "", None, "b"), (3, "old", [], None),
        (3, "old", [], None), (None, "what is it's", [(7, 1, None), (None, None, "so ")], "c"),
        (5, "w " * 100_000, [(50_000, 3, "mid"), (-4, 2, "")], "d"), (6, "gone", [(0, 99, "")], "e"),
    ]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, edits {edit}, n_tokens string")
    found = count_tokens(docs, edits_column="edits").collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found}
    assert by_id[1].text_after == "new text!" and by_id[None].text_after == "so what isit's" and by_id[6].text_after == ""
    for r in found:
        assert r.n_tokens == whole(counter, r.text or "")
        assert r.tokens_after == whole(counter, r.text_after)
    assert by_id[5].reencoded < 500
    assert count_tokens(docs.where("false")).count() == 0
    assert count_tokens(docs.drop("edits")).columns == ["doc_id", "text", "n_tokens"]


def test_stored_leaves_follow_the_edits_of_later_days(spark, counter, tmp_path):
    rng = random.Random(6)
    words = ["the", "of", "it's", "12", "é", "...", "stone\n", "  "]
    texts = {k: " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 80, 3000]))) for k in range(40)} | {98: None, 99: ""}
    schema = "doc_id long, text string, _edited string"
    day = token_leaves(spark.createDataFrame([(k, t, "x") for k, t in texts.items()], schema))
    texts = {k: t or "" for k, t in texts.items()}
    for n in range(3):
        day.write.parquet(str(tmp_path / str(n)))
        stored = spark.read.parquet(str(tmp_path / str(n)))
        assert {r.doc_id: r.n for r in stored.select("doc_id", tokens_of("leaves").alias("n")).collect()} == {
            k: whole(counter, t) for k, t in texts.items()
        }
        edits = {
            k: [(rng.randrange(len(t) + 1), rng.choice([0, 2, 9]), rng.choice(["", " new", "'s"])) for _ in range(rng.randrange(3))]
            for k, t in texts.items()
        }
        given = spark.createDataFrame(list(edits.items()), "doc_id long, edits array<struct<start:int,removed:int,inserted:string>>")
        day = follow_edits(stored.join(given, "doc_id"))
        for k, changes in edits.items():
            for start, gone, new in changes:
                texts[k] = texts[k][:start] + new + texts[k][start + gone :]
        found = {r.doc_id: r for r in day.collect()}
        assert {k: r.text or "" for k, r in found.items()} == texts and found[0]._edited == "x"
        for k, r in found.items():
            assert sum(leaf.tokens for leaf in r.leaves) == whole(counter, texts[k])
            assert r.reencoded == 0 if not edits[k] else r.reencoded < 700
        day = day.drop("edits", "reencoded")
    # Leaves of another text are not believed.
    stale = stored.where("doc_id = 99").withColumn("text", F.lit("some other text"))
    stale = stale.withColumn("edits", F.expr("array(named_struct('start', 4, 'removed', 0, 'inserted', ' more'))"))
    (row,) = follow_edits(stale).collect()
    assert row.text == "some more other text" and sum(leaf.tokens for leaf in row.leaves) == whole(counter, row.text)
    assert follow_edits(stale.where("false")).count() == 0
