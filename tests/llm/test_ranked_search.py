"""Best positions give exactly the top k of scoring every document."""
import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marketlens.llm import ranked_search as R
from marketlens.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, item_id string, score int, n int, shard string, query string, row string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=50):
    counted = [(d, Counter(t)) for d, text in docs if (t := terms(text))]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    df, out = Counter(t for _, c in counted for t in c), []
    for item, text in items:
        scored = []
        for d, c in counted:
            m = 50 + (50 * sum(c.values()) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if c[t])
            if score > 0:
                scored.append((-score, d is not None, d or 0, d))
        out += [(item, r + 1, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(map(repr, out))


def check(spark, docs, items, k=50):
    d = spark.createDataFrame([(*r, "x", 1, 2, "s", "q", "r") for r in docs], SCHEMA).repartition(4)
    i = spark.createDataFrame([(*r, 1, "u") for r in items], "item_id long, text string, doc_id int, rank string")
    got = R.search(spark, d, i, k)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute(docs, items, k)


def words(rng, n, vocabulary):
    return " ".join(f"w{int(x)}" for x in rng.zipf(1.3, n) % vocabulary)


def test_whole_search_on_many_documents(spark):
    rng = np.random.default_rng(5)
    docs = [(i, words(rng, int(rng.integers(1, 60)), 300)) for i in range(1500)]
    check(spark, docs, [(j, words(rng, 12, 300)) for j in range(15)], 50)


def test_nulls_ties_repeated_rows_and_long_texts(spark):
    docs = [(5, "Alpha beta"), (3, "alpha BETA"), (None, "alpha beta"), (3, "alpha BETA"), (1, None), (2, ""), (4, "-- ..\n"), (6, "été Été alpha_2 x y"),
            (7, "gamma " * 300_000 + "alpha"), (8, "\x00delta\x7fDELTA"), (9, "zeta")]
    items = [(1, "alpha, beta; beta"), (1, "alpha, beta; beta"), (2, None), (3, "!!"), (None, "Été 2 x y"), (4, "missing"), (5, "delta gamma")]
    check(spark, docs, items, 50)
    check(spark, docs, items, 2)


def test_empty_tables(spark):
    check(spark, [], [(1, "a")])
    check(spark, [(1, "a")], [])
    check(spark, [(1, None), (2, " ")], [(1, "a")])


def test_blocks_of_queries_answer_alike(spark, monkeypatch):
    rng = np.random.default_rng(6)
    docs = [(i, words(rng, 20, 40)) for i in range(200)]
    monkeypatch.setattr(R, "BLOCK_ITEMS", 2)
    check(spark, docs, [(j, words(rng, 5, 40)) for j in range(5)], 7)


def test_pieces_of_a_text_hold_the_same_terms(monkeypatch):
    text = ("ab c  dé " * 50).encode()
    whole = [w for words in R.terms_of(text) for w in words]
    for size in (1, 3, 7, 10_000):
        monkeypatch.setattr(R, "PIECE", size)
        assert [w for words in R.terms_of(text) for w in words] == whole


@settings(max_examples=60, deadline=None)
@given(st.lists(st.dictionaries(st.integers(0, 5), st.integers(1, 9), min_size=1), min_size=1, max_size=120), st.sets(st.integers(0, 5), min_size=1),
       st.integers(1, 8), st.integers(1, 3))
def test_a_shard_stops_late_enough(docs, query, k, step):
    lengths = np.array([sum(d.values()) for d in docs])
    flat = [(t, n) for d in docs for t, n in d.items()]
    shard = R.Shard(lengths, np.r_[0, np.cumsum([len(d) for d in docs])], np.array([t for t, _ in flat]), np.array([n for _, n in flat]),
                    np.array([700, 500, 300, 90, 7, 0]), len(docs), int(lengths.sum()))
    ids = np.random.default_rng(len(docs)).permutation(len(docs))
    scores = np.zeros(len(docs), np.int64)
    for t, s, d in zip(shard.term, shard.impact, np.repeat(np.arange(len(docs)), np.diff(shard.doc_start))):
        scores[d] += s if t in query else 0
    order = [d for d in np.lexsort((ids, -scores)) if scores[d] > 0][:k]
    old, R.STEP = R.STEP, step
    try:
        for floor in (1, int(scores[order[-1]]) if len(order) == k else 1):
            for _ in range(2):  # marks are wiped between queries
                got, found = shard.top(np.array(sorted(query)), ids, k, floor)
                assert got[found > 0].tolist() == order and found[found > 0].tolist() == scores[order].tolist()
    finally:
        R.STEP = old


def test_reading_stops_before_the_lists_end():
    n = 20_000
    rng = np.random.default_rng(3)
    lengths, tfs = rng.integers(2, 500, n), np.ones(2 * n, np.int64)
    shard = R.Shard(lengths, np.arange(0, 2 * n + 1, 2), np.tile([0, 1], n), tfs, np.array([500, 400]), n, int(lengths.sum()))
    seen = []
    direct = shard._direct
    shard._direct = lambda docs: seen.append(len(docs)) or direct(docs)
    shard.top(np.array([0, 1]), np.arange(n), 50, 1)
    assert sum(seen) < n // 10


def test_registered_query_on_empty_tables(spark, tmp_path):
    for t in ("documents", "benchmark"):
        spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").where("false").write.parquet(str(tmp_path / f"{t}.parquet"))
    assert QUERIES["op12_ranked_search"](spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("n_docs,df", [(1, 1), (10, 3), (10**9, 1)])
def test_weights(n_docs, df):
    assert R.weight(n_docs, df) == math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
