"""Exact top-k against brute force and DuckDB."""
import random

import duckdb
import pytest

from marketlens.llm import topk_search


def code(v, dims):
    return [(x is not None and x >= 0) for x in list(v) + [None] * (dims - len(v))]


def brute(rows, k, every):
    rows = [(i, v) for i, v in rows if i is not None and v is not None]
    dims = max((len(v) for _, v in rows), default=0)
    codes = [(i, code(v, dims)) for i, v in rows]
    out = set()
    for q in {i for i, _ in codes if i % every == 0}:
        own = [c for i, c in codes if i == q]
        assert len(own) == 1
        best = sorted((sum(a != b for a, b in zip(own[0], c)), i) for i, c in codes)[:k]
        out |= {(q, i, d, r + 1) for r, (d, i) in enumerate(best)}
    return out


@pytest.mark.parametrize("dims,n", [(64, 300), (20, 150), (3, 40)])
def test_equals_brute_force(spark, dims, n):
    rnd = random.Random(dims)
    base = [[rnd.uniform(-1, 1) for _ in range(dims)] for _ in range(n // 3)]
    rows = [(i, list(rnd.choice(base)) if rnd.random() < 0.5 else [rnd.uniform(-1, 1) for _ in range(dims)]) for i in range(n)]
    rows += [(n + i, base[0]) for i in range(60)] + [(n + 70, None), (None, base[0]), (n + 71, base[1][:2]), (n + 72, [None, 0.0, -0.0]), (n + 73, [])]
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, distance string, code_id int")
    got = topk_search.search(spark, frame, frame.where("vec_id % 7 = 0"), k=8)
    assert {tuple(r) for r in got.collect()} == brute(rows, 8, 7)


def test_fewer_rows_than_k_and_empty(spark):
    rows = [(0, [1.0] * 12), (1, [-1.0] * 12)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert {tuple(r) for r in topk_search.search(spark, frame, frame, k=5).collect()} == brute(rows, 5, 1)
    none = frame.where("vec_id < 0")
    assert topk_search.search(spark, none, none).count() == 0
    assert topk_search.search(spark, frame, none).count() == 0


def test_equals_duckdb(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{sf}/embeddings.parquet'")
    rows = spark.read.parquet(f"{sf}/embeddings.parquet")
    got = topk_search.search(spark, rows, rows.where("vec_id % 100 = 0"))
    assert sorted(tuple(r) for r in got.collect()) == sorted(con.execute(topk_search.SQL).fetchall())
