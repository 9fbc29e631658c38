"""The pipeline's stages and the registered queries with SQL."""

import collections

import pytest

import corpus_pipeline
from compare import database, differences
from kpiloom.llm import queries

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    assert differences(spark, database(SMALL), queries.QUERIES[name], queries.ORACLES[name], SMALL) is None


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES:
        seen.append(stage(spark, seen[-1], SMALL).persist())
    ids = [collections.Counter(r["doc_id"] for r in s.select("doc_id").collect()) for s in seen]
    assert all(s.columns == docs.columns for s in seen[:-1])
    clean = {i for i, t in labels.items() if t == 0}
    assert len(clean - ids[1].keys()) <= 2
    texts = [r["text"] for r in seen[2].collect()]
    assert len(texts) == len(set(texts)) and ids[2].keys() <= ids[1].keys() and ids[3].keys() <= ids[2].keys()
    assert set(ids[4].values()) <= {1, 2} and ids[4].keys() <= ids[3].keys()
    first = collections.Counter(r["doc_id"] for r in seen[5].collect() if r["piece"] == 0)
    assert first == ids[4]
    assert corpus_pipeline.run(spark, SMALL).count() == seen[5].count()


def test_stages_of_nothing(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        assert docs.count() == 0
