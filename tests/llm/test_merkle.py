"""The manifest against a tree built in memory; only every third level is stored."""
import hashlib
import os
import zlib

import pytest
from pyspark.sql import functions as F

from marketlens.llm import merkle
from marketlens.llm.queries import QUERIES

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, key string, pos int, digest string, path string, n int, sub int, root string"
SF = "/root/testdata/sf0.001"


def H(x):
    return hashlib.sha256(x.encode()).hexdigest()


def climb(nodes):
    """The root of ``nodes`` and every node's siblings (before, after) level by level."""
    paths, members = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, joined = [], []
        for a in range(0, len(nodes), 3):
            run = nodes[a:a + 3]
            for k in range(len(run)):
                for i in members[a + k]:
                    paths[i].append(("".join(run[:k]), "".join(run[k + 1:])))
            up.append(H("".join(run)))
            joined.append([i for m in members[a:a + 3] for i in m])
        nodes, members = up, joined
    return nodes[0], paths


def brute(rows):
    def leaf(r, text):
        return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*r[:4], text)))
    by = {}
    for r in rows:
        even = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
        by.setdefault(r[1], []).append((r[0], leaf(r, r[4]), leaf(r, r[4].replace("\n", "") if even and r[4] is not None else r[4])))
    keys = sorted(by, key=lambda k: (k is not None, (k or "").encode()))
    trees = {}
    for k in keys:
        by[k].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[k] = climb([x[1] for x in by[k]])
    root, upper = climb([trees[k][0] for k in keys]) if keys else ("", [])
    out = []
    for k, above in zip(keys, upper):
        for (doc_id, own, altered), path in zip(by[k], trees[k][1]):
            node = altered
            for before, after in path + above:
                node = H(before + node + after)
            out.append((doc_id, own, trees[k][0], root, H("".join(b + a for b, a in path + above)), node, node == root))
    return sorted(map(repr, out))


def check(spark, rows):
    docs = spark.createDataFrame([(*r, "k", 1, "d", "p", 2, 3, "r") for r in rows], SCHEMA).repartition(3)
    got = merkle.verify(merkle.manifest(spark, docs))
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute(rows)


@pytest.mark.parametrize("n", [1, 3, 4, 27, 28, 82, 250])
def test_sources_of_many_sizes(spark, n):
    rows = [(i, "hot", "en", i, f"line {i}\nmore") for i in range(n)]
    check(spark, rows + [(1000 + i, f"s{i % 4}", None, None, "a\nb") for i in range(9)])


def test_nulls_empty_and_long_texts_repeated_rows_and_clashing_columns(spark):
    rows = [(1, None, "en", 3, "a\nb"), (2, "", None, None, ""), (3, "", "x", 0, None), (None, "", "x", 0, "a\nb"), (4, "é", "x", 1, "\n" * 10), (4, "é", "x", 1, "\n" * 10),
            (4, "é", "x", 2, "other"), (5, "z", "", -7, "w\n" * 200_000), (6, "Z", "e", 5, "é\r\n"), (7, None, None, None, None), (-9, "z", "e", 1, "\n")]
    check(spark, rows)


def test_many_sources_and_an_empty_table(spark):
    check(spark, [(i, f"source {i % 90}", "en", i, f"t\n{i}") for i in range(200)])
    check(spark, [])


def test_only_every_third_level_is_stored(spark, tmp_path):
    docs = spark.createDataFrame([(i, "s", "en", 1, f"t{i}") for i in range(800)], "doc_id long, source string, lang string, n_chars long, text string")
    rows = merkle.manifest(spark, docs, str(tmp_path / "m"))
    assert sorted(x for x in os.listdir(tmp_path / "m/sources") if x.startswith("level")) == ["level=0", "level=3", "level=6", "level=9"]
    assert rows.select(F.size("path").alias("k")).distinct().collect() == [(7,)]
    assert [r["n"] for r in spark.read.parquet(str(tmp_path / "m/sources/level=3")).select(F.size("nodes").alias("n")).orderBy("n").collect()] == [3, 27]


def test_registered_query_equals_brute_force(spark, tmp_path):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = QUERIES["op13_merkle_manifest"](spark, SF)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute(rows)
    spark.read.parquet(f"{SF}/documents.parquet").where("false").write.parquet(str(tmp_path / "documents.parquet"))
    assert QUERIES["op13_merkle_manifest"](spark, str(tmp_path)).count() == 0
