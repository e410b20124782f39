import os

import duckdb
import pytest

import corpus_pipeline
from check import TABLES, compare
from chronoloom.llm import queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, con, name):
    verdict = compare(queries.QUERIES[name](spark, FOLDER).toPandas(), con.execute(queries.ORACLES[name]).df())
    assert verdict.startswith("ok"), verdict


def test_stages(spark):
    """Each stage works on all that is left; columns stay until the last."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, last = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        from chronoloom.llm.common import written
        docs = written(stage(spark, docs, FOLDER), name)
        rows = docs.collect()
        assert docs.columns == columns
        assert all(last[r.doc_id] == r.text for r in rows), name
        assert 0 < len({r.doc_id for r in rows}) <= len(last)
        last = {r.doc_id: r.text for r in rows}
    final = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert sorted(r.doc_id for r in final.collect()) == sorted(r.doc_id for r in docs.collect())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mixing", "encoding"]
    clash = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        clash = stage(spark, clash, FOLDER)
        assert clash.count() == 0
