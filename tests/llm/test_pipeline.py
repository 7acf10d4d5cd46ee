"""The corpus pipeline against the same decisions made one document at a time."""

import re
from collections import defaultdict

import corpus_pipeline
import duckdb
import pandas as pd
import pytest
from test_corpus import check_mix
from test_dedup import grouped
from test_similar import alike

from openloop.llm import quality_net
from openloop.llm.oracles import ORACLES

SF_DIR = "/root/testdata/sf0.01"


def by_hand(spark):
    """The documents that the four filtering stages keep, as {doc_id: row}."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    net = quality_net.fit(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    kept = [r for r in docs.collect() if net.probability((r.text or "").encode()) >= 0.7]
    groups = defaultdict(list)
    for r in kept:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "")].append(r)
    kept = [min(g, key=lambda r: r.doc_id) for g in groups.values()]
    roots = grouped(alike({r.doc_id: r.text for r in kept}), sorted(r.doc_id for r in kept))
    kept = [r for r in kept if roots[r.doc_id] == r.doc_id]
    con = duckdb.connect()
    con.register("documents", pd.DataFrame([(r.doc_id, r.text) for r in kept], columns=["doc_id", "text"]))
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM read_parquet('{SF_DIR}/benchmark.parquet')")
    leaked = {row[0] for row in con.execute(f"SELECT doc_id FROM ({ORACLES['op10_decontamination']})").fetchall()}
    return {r.doc_id: r for r in kept if r.doc_id not in leaked}


def test_pipeline_against_decisions_by_hand(spark):
    assert corpus_pipeline.ORACLE_SQL is None
    expected = by_hand(spark)
    assert 500 < len(expected) < 950
    found = corpus_pipeline.run(spark, SF_DIR).collect()
    check_mix(found, [(r.doc_id, r.text, r.source) for r in expected.values()])


def test_stages_keep_the_columns_of_documents(spark):
    rows = [
        (1, "plain words of an ordinary text", "en", "s", 31), (1, "plain words of an ordinary text", "en", "s", 31),
        (None, None, None, None, None), (2, "", "en", None, 0), (3, "plain words of another text altogether", "en", "t", 9),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for given in (docs, docs.where("false")):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, given, SF_DIR)
            assert kept.schema.simpleString() == docs.schema.simpleString()
            assert kept.count() <= given.count()
        assert corpus_pipeline.STAGES[-1][1](spark, given, SF_DIR).count() == given.count()
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == len(set(names)) == 5


@pytest.mark.parametrize("stage", range(5))
def test_stages_name_their_rule(stage):
    assert corpus_pipeline.STAGES[stage][1].__doc__
