"""The registered queries on the smallest driver tables: contracts, and DuckDB where SQL can say it."""
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import __spark_entry__ as E  # noqa: E402
import corpus_pipeline  # noqa: E402
from marketlens.llm.queries import ORACLE, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


def test_entry_lists_all_queries():
    names = E.queries()
    assert set(QUERIES) <= set(names) and "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_duckdb(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    res = con.execute(ORACLE[name])
    columns = [d[0] for d in res.description]
    want = sorted(map(repr, res.fetchall()))
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(repr(tuple(r)) for r in got.select(*columns).collect()) == want


def test_pipeline_stages_keep_the_columns_and_place_every_document_left(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    left, sizes = docs, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        from marketlens.llm import common
        left = common.materialize(spark, stage(spark, left, SF))
        assert left.columns == docs.columns and left.dtypes == docs.dtypes
        sizes.append(left.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0
    placed = corpus_pipeline.STAGES[-1][1](spark, left, SF)
    assert {r[0] for r in placed.select("doc_id").distinct().collect()} == {r[0] for r in left.select("doc_id").collect()}
    assert corpus_pipeline.run(spark, SF).count() == placed.count()


def test_pipeline_of_an_empty_table(spark, tmp_path):
    for t in ("documents", "labels"):
        spark.read.parquet(f"{SF}/{t}.parquet").where("false").write.parquet(str(tmp_path / f"{t}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
