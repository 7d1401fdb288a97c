"""The registered queries: SQL where there is SQL, and the pipeline against its parts."""

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from gazette.llm.queries import ORACLE, QUERIES

from .conftest import got

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    res = con.execute(ORACLE[name])
    cols = [c[0] for c in res.description]
    df = QUERIES[name](spark, SF)
    assert sorted(cols) == sorted(df.columns)
    clean = lambda rs: sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rs), key=repr)
    assert clean(df.select(*cols).collect()) == clean(res.fetchall())


def test_entry_has_all_operators_and_the_pipeline():
    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in E.queries() and len(corpus_pipeline.STAGES) == 5


def test_pipeline_stages_chain(spark, docs, no_docs):
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SF)
        assert kept.dtypes == docs.dtypes
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, SF).count() == 0


def test_pipeline_keeps_clean_documents(spark):
    out = got(corpus_pipeline.run(spark, SF).select("doc_id"))
    assert len({r[0] for r in out}) >= 150
