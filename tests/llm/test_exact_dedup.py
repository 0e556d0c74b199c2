"""Counting quotient filters keep every fingerprint and count; groups are those of equal bytes."""
import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketlens.llm import exact_dedup as X
from marketlens.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, fp string, sha int, row int, n string, hot string, salt string, keep string"


def arrays(counter):
    keys = np.array(sorted(counter), np.uint64)
    return keys, np.array([counter[int(k)] for k in keys], np.uint64)


@settings(max_examples=80, deadline=None)
@given(st.integers(8, 64), st.lists(st.tuples(st.integers(0, 2**64 - 1), st.integers(1, 10**12)), max_size=60), st.booleans())
def test_a_filter_gives_back_keys_and_counts(bits, rows, near):
    counter = Counter()
    for key, n in rows:
        counter[(key % 50 if near else key) % (1 << bits)] += n
    keys, counts = arrays(counter)
    back = X.unpack(X.pack(keys, counts, bits))
    assert back[0].tolist() == keys.tolist() and back[1].tolist() == counts.tolist()


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**20), max_size=80), min_size=1, max_size=5))
def test_merging_adds_counts(parts):
    blobs = [X.pack(*arrays(Counter(p)), 24) for p in parts]
    keys, counts = X.unpack(X.merge(blobs, 24))
    assert dict(zip(keys.tolist(), counts.tolist())) == Counter(x for p in parts for x in p)


def test_a_filter_is_smaller_than_its_fingerprints():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**64 - 1, 1 << 16, dtype=np.uint64))
    assert len(X.pack(keys, np.ones(len(keys), np.uint64), 64)) < 0.9 * keys.nbytes


@pytest.mark.parametrize("top", [0, 3])
def test_filters_of_tasks_merge_losslessly(spark, top):
    prints = spark.range(5000).repartition(7).select(F.xxhash64((F.col("id") * F.col("id")) % 900).alias("fp"))
    merged = X.merge_filters(X.build_filters(prints, top), top)
    want = Counter(r["fp"] for r in prints.collect())
    assert {(r["fp"], r["n"]) for r in X.repeated(merged, top, least=1).collect()} == set(want.items())
    assert {(r["fp"], r["n"]) for r in X.repeated(merged, top).collect()} == {x for x in want.items() if x[1] > 1}
    twice = X.merge_filters(merged.union(X.build_filters(prints, top)), top)
    assert {(r["fp"], r["n"]) for r in X.repeated(twice, top).collect()} == {(f, 2 * n) for f, n in want.items()}


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = []
    for text, ids in groups.items():
        ids.sort(key=lambda i: (i is not None, i))
        for place, i in enumerate(ids):
            out.append((i, ids[-1], len(ids), place == len(ids) - 1, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(map(repr, out))


def check(spark, rows):
    docs = spark.createDataFrame([(i, t, "x", 1, 2, "y", "z", "s", "k") for i, t in rows], SCHEMA).repartition(5)
    assert sorted(repr(tuple(r)) for r in X.dedup(spark, docs).collect()) == brute(rows)


def test_nulls_ties_repeated_rows_long_texts_and_clashing_columns(spark):
    check(spark, [(1, "a"), (2, "a"), (3, "a "), (4, "A"), (5, None), (6, ""), (None, "a"), (None, None), (7, "é"), (8, "é"),
                  (9, "b"), (9, "b"), (9, "b"), (3, "a "), (10, "x" * 400_000), (11, "x" * 400_000), (12, "x" * 399_999 + "y"), (13, "a\n"), (14, "a\r\n")])


def test_a_hot_group_and_an_empty_table(spark):
    check(spark, [(i, "same" if i % 3 == 0 else f"t{i % 997}") for i in range(6000)])
    check(spark, [])


def test_equal_fingerprints_of_different_texts_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(X.F, "xxhash64", lambda *c: F.lit(7).cast("long") + F.length(*c))
    check(spark, [(1, "ab"), (2, "cd"), (3, "ab"), (4, "x"), (5, "yy"), (6, "z")])


def test_registered_query_on_an_empty_table(spark, tmp_path):
    spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("false").write.parquet(str(tmp_path / "documents.parquet"))
    assert QUERIES["op11_exact_dedup"](spark, str(tmp_path)).count() == 0
