"""The contract, the queries with SQL, and the pipeline against what its operators decide."""

import pytest
from compare import connect, differences

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tidecart.llm import pii
from tidecart.llm.oracles import ORACLES

FOLDER = "/root/testdata/sf0.001"


def test_registered():
    names = list(queries())
    assert [n for n in names if n.startswith("op")][:1] and "pipeline" in names
    for k in range(1, 14):
        assert sum(n.startswith(f"op{k}_") for n in names) == 1
    assert set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    problems, _ = differences(spark, connect(FOLDER), FOLDER, queries()[name], ORACLES[name])
    assert not problems


def test_pipeline(spark, documents):
    docs, sizes = documents.select(*corpus_pipeline.COLUMNS), []
    held = {}
    for name, stage in corpus_pipeline.STAGES:
        sizes.append(docs.count())
        docs = stage(spark, docs, FOLDER)
        if name != "best-fit packing":
            assert docs.columns == corpus_pipeline.COLUMNS
            docs = held[name] = docs.cache()
    rows = docs.collect()
    assert sizes == sorted(sizes, reverse=True) and sizes[1] < sizes[0]
    last = held["personal data"].collect()
    assert not any(s for r in last for s in pii.plain_spans(r["text"] or ""))
    assert sorted({str(r["doc_id"]) for r in rows}) == sorted({str(r["doc_id"]) for r in last})
    kept = [r["doc_id"] for r in held["n-gram jaccard join"].collect()]
    assert len(kept) == len(set(kept))
    words = [r["text"] for r in last if r["text"] and r["text"].split()]
    assert len(words) == len(set(words))
