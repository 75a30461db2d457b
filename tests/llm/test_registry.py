"""Registered queries against their SQL; the pipeline against its parts."""

import duckdb
import pytest

import corpus_pipeline
from docweave.llm import jaccard, registry
from docweave.llm.common import table
from docweave.session import TABLES
from tests.conftest import SF_SMALL
from tests.llm.test_groups import python_components
from tests.llm.test_rows import python_measures
from tests.test_oracle import _bag


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_matches_sql(spark, duck, name):
    assert _bag(registry.QUERIES[name](spark, SF_SMALL).toPandas()) == _bag(duck.execute(registry.ORACLE_SQL[name]).df())


def test_op2_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.op2_ngram_jaccard_join(spark, SF_SMALL).collect()}
    assert got == python_components(rows)


def test_pipeline_stages(spark):
    docs = table(spark, SF_SMALL, "documents")
    columns = docs.columns
    sizes = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = corpus_pipeline.materialize(stage(spark, docs, SF_SMALL), f"test-{k}")
        sizes.append(docs.count())
        if k < 4:
            assert docs.columns == columns
            assert docs.join(before, "doc_id", "left_anti").count() == 0
        if k == 0:  # the base rules hold for what is left
            for r in docs.collect():
                m = python_measures(r.text)
                assert m[0] >= 50 and 100 * m[4] <= 50 * m[0]
        if k == 1:  # prose is never rejected
            assert sizes[1] == sizes[0]
        if k == 2:
            top = python_components([(r.doc_id, r.text) for r in before.collect()])
            assert {r.doc_id for r in docs.collect()} == {c for _, c in top.values()}
    assert sizes[4] >= sizes[3] > 0


def test_pipeline_on_an_empty_table(spark, make_documents):
    sf = make_documents([], schema="doc_id long, text string, lang string, source string, n_chars long")
    assert corpus_pipeline.run(spark, sf).count() == 0
