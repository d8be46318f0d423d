"""The registered queries against SQL, and the pipeline against its stages' rules."""

from __future__ import annotations

import pytest
from oracle import compare, duck

import corpus_pipeline
from metaingest.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, connection, name):
    assert compare(QUERIES[name](spark, SF_DIR), connection, ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_has_a_row_for_every_document(spark, name):
    out = QUERIES[name](spark, SF_DIR)
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert out.select("doc_id").distinct().count() == documents.count()
    assert out.count() == documents.count() or name.startswith("op8")


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    packed = corpus_pipeline.run(spark, SF_DIR)
    kept = docs
    for _, apply in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, apply(spark, kept, SF_DIR)
        assert kept.columns == docs.columns and kept.schema == docs.schema
        assert kept.join(before, "doc_id", "left_anti").count() == 0
    assert 0 < kept.count() < docs.count()
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {r.doc_id for r in packed.select("doc_id").distinct().collect()}
