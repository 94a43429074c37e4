"""The dealt operators' queries against their SQL, where SQL can say the same."""

import pytest
from comparing import database, differences

import corpus_pipeline
from gridmart.llm import queries as catalogue

FOLDER = "/root/testdata/sf0.001"
SQL = catalogue.oracle_sql()


@pytest.fixture(scope="module")
def checking():
    return database(FOLDER)


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in catalogue.queries()) == list(range(1, 14))
    assert set(SQL) <= set(catalogue.queries())


@pytest.mark.parametrize("name", SQL)
def test_query_agrees(spark, checking, name):
    assert differences(catalogue.queries()[name](spark, FOLDER), checking, SQL[name]) == []


def test_pipeline_stages_keep_the_columns(spark):
    docs = corpus_pipeline.read(spark, FOLDER, "documents")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.staged(stage(spark, docs, FOLDER), name)
        assert docs.columns == columns
    assert 0 < docs.count() <= before
    name, stage = corpus_pipeline.STAGES[-1]
    assert stage(spark, docs, FOLDER).select("doc_id").distinct().count() == docs.count()
