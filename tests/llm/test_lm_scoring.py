"""Language-model scoring: base scores by brute force, proper distributions, held-out gain."""
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from marketlens.llm import lm_scoring as lm


def brute_tokens(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x20\x09-\x0D]+", low) + ["\n"]


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2


def corpus(n=260):
    rnd = random.Random(3)
    langs = [["the", "of", "and", "thing", "word", "ther"], ["le", "de", "eau", "étre", "mot", "leur"]]
    rows = []
    for i in range(n):
        words = langs[i % 2]
        rows.append((i, " ".join(rnd.choice(words) + rnd.choice(["", "", "s", f"{rnd.randrange(50)}"]) for _ in range(rnd.randint(0, 60))).capitalize()))
    return rows + [(900, None), (901, ""), (902, "Unseen wörds only zzz"), (None, "null id here"), (5, "the Of\x0bAND"), (903, "the " * 30000)]


@pytest.mark.parametrize("head", [0, 20, 1 << 18])
def test_base_scores_by_brute_force(spark, head):
    rows = corpus()
    docs = spark.createDataFrame([(a, b, "x", 0.5) for a, b in rows], "doc_id long, text string, row string, score double")
    model = lm.fit(spark, docs, head=head)
    out = lm.scored(spark, docs, model).collect()
    counts = Counter(w for i, t in rows if not held(i) for w in brute_tokens(t))
    n, v = sum(counts.values()), len(counts)
    want = sorted((str(i), len(ws := brute_tokens(t)), sum(w in counts for w in ws), round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), 6)) for i, t in rows)
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in out) == want
    assert {r["train_tokens"] for r in out} == {n}


def test_model_is_a_distribution_and_beats_the_base_on_held_out_texts(spark):
    rows = corpus(700)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = [r for r in lm.lm_scores(spark, docs).collect()]
    assert out[0].__fields__ == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    test = [r for r in out if r["held_out"]]
    assert all(r["held_out"] == held(r["doc_id"]) for r in out) and len(test) > 60
    assert sum(r["score"] for r in test) > sum(r["base_score"] for r in test)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in out)
    # class factor sums to one for any history; the word factor sums to one within a class by its definition
    model = lm.fit(spark, docs)
    z = lm.log_softmax(model.weights, np.random.default_rng(0).integers(0, lm.ROWS, (50, 3)))
    assert np.allclose(np.exp(z).sum(axis=1), 1, atol=1e-4)
    shares = Counter()
    known = {bytes(r["word"]): r["c"] for r in model.counts.collect()}
    for w, c in known.items():
        k = model.classes[lm.bucket(w)]
        shares[k] += (c + 1) / 10 ** model.log_size[k]
    for k, s in shares.items():
        assert s + 1 / 10 ** model.log_size[k] == pytest.approx(1)


def test_training_never_reads_held_out_texts(spark):
    rows = corpus()
    other = [(i, "changed beyond recognition" if held(i) else t) for i, t in rows]
    a, b = (lm.fit(spark, spark.createDataFrame(x, "doc_id long, text string").coalesce(1)) for x in (rows, other))
    assert (a.train_tokens, a.vocabulary) == (b.train_tokens, b.vocabulary)
    assert (a.classes == b.classes).all() and (a.log_size == b.log_size).all()


def test_training_texts_are_read_once_into_counts_and_buckets(spark):
    """A lexicon that overflows twice in a task loses no count; training needs no text again."""
    texts = [" ".join(f"w{k % 3 * 1000000 + i}" for i in range(150_000)) + " The the" for k in range(5)] + ["", "a b a"]
    texts[4] = " ".join(f"v{i}" for i in range(lm.REMEMBER + 5))
    rows = lm.coded_texts(spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)).collect()
    counts = Counter()
    for r in rows:
        if r["word"] is not None:
            counts[bytes(r["word"])] += r["c"]
    assert counts == Counter(w.encode() for t in texts for w in brute_tokens(t))
    got = [np.frombuffer(r["text"], "<u2").tolist() for r in rows if r["text"] is not None]
    assert sorted(got) == sorted([lm.bucket(w.encode()) for w in brute_tokens(t)] for t in texts)


def test_gradient_step_equals_the_softmax_derivative():
    rng = np.random.default_rng(2)
    w = rng.normal(0, 0.1, (lm.ROWS, lm.CLASSES)).astype("f4")
    rows = rng.integers(0, 50, (64, 3)) + np.arange(3) * 100
    target = rng.integers(0, lm.CLASSES, 64)
    before = w.copy()
    squares, used = np.zeros(lm.ROWS, "f4"), np.zeros(lm.ROWS, "f4")
    lm.train_rows(w, squares, used, rows, target)
    grad = np.zeros((lm.ROWS, lm.CLASSES))
    p = np.exp(before[rows].sum(axis=1) + before[lm.BIAS])
    p /= p.sum(axis=1, keepdims=True)
    p[np.arange(64), target] -= 1
    for i in range(64):
        for r in [*rows[i], lm.BIAS]:
            grad[r] += p[i]
    assert np.allclose(w - before, -lm.RATE * grad / np.sqrt((grad ** 2).sum(axis=1, keepdims=True) + lm.DAMPING), atol=1e-4)
    assert used[lm.BIAS] == 64 and used.sum() == 64 * 4


def test_the_word_three_back_is_learnt():
    rng = np.random.default_rng(5)
    classes = np.arange(lm.BUCKETS, dtype="i4") % lm.CLASSES
    words = rng.integers(0, 2, 6000).astype("i4")
    for i in range(3, len(words)):  # repeats the third one back, or is noise
        words[i] = words[i - 3] if rng.random() < 0.95 else rng.integers(0, 2)
    flat, back = lm.contexts([words])
    rows, target = lm.feature_rows(back, classes), classes[flat]
    assert rows.shape[1] == 4 and len(np.unique(rows // lm.BUCKETS)) == 4
    w = np.zeros((lm.ROWS, lm.CLASSES), "f4")
    squares, used = np.zeros(lm.ROWS, "f4"), np.zeros(lm.ROWS, "f4")
    for i in range(0, 5000, 50):
        lm.train_rows(w, squares, used, rows[i:i + 50], target[i:i + 50])
    z = lm.log_softmax(w, rows[5000:])
    assert z[np.arange(len(z)), target[5000:]].mean() > -0.5  # a fair coin is -0.69


def test_run_sums_equal_plain_sums():
    rng = np.random.default_rng(6)
    keys = np.sort(np.r_[rng.integers(0, 60, 90), np.full(40, 61), np.arange(100, 120)])
    order = rng.permutation(len(keys))
    grad = rng.normal(size=(len(keys), 5))
    starts = np.nonzero(np.r_[True, keys[1:] != keys[:-1]])[0]
    got = lm.run_sums(grad, order, starts, np.diff(np.r_[starts, len(keys)]))
    assert np.allclose(got, [grad[order][keys == k].sum(axis=0) for k in np.unique(keys)])


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert lm.lm_scores(spark, docs).count() == 0
    only_held = next(i for i in range(100) if held(i))
    r = lm.lm_scores(spark, spark.createDataFrame([(only_held, "a b")], "doc_id long, text string")).first()
    assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) == (3, 0, 0, 0.0)
    assert r["score"] == pytest.approx(-3 * math.log10(lm.CLASSES), abs=1e-3)
