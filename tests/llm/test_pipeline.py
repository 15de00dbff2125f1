import os

import pytest

import corpus_pipeline
from pricetide.llm import queries
from pricetide.llm.common import DOCUMENT_COLUMNS
from tests.harness import compare, duck

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


def test_stages_work_on_what_the_one_before_kept(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    counts, ids = [docs.count()], {r.doc_id for r in docs.collect()}
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        now = {r.doc_id for r in docs.select("doc_id").collect()}
        counts.append(docs.count())
        assert now <= ids and len(now) == counts[-1]
        ids = now
        if i < len(corpus_pipeline.STAGES) - 1:
            assert tuple(docs.columns) == DOCUMENT_COLUMNS
    assert counts[1] < counts[0] and counts[3] == counts[2] and counts[5] == counts[4]
    whole = corpus_pipeline.run(spark, FOLDER)
    assert {(r.doc_id, r.ids_sha256) for r in whole.collect()} == {(r.doc_id, r.ids_sha256) for r in docs.collect()}


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, FOLDER), duck(FOLDER), queries.ORACLES[name]) is None
