"""Quality rules: base statistics and the robust estimates against plain Python and numpy."""
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from marketlens.llm import quality

SPACE = "[\x20\x09-\x0D]+"


def brute(text):
    text = text or ""
    words = [w for w in re.split(SPACE, text) if w]
    seen = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if seen[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines = [ln for ln in text.split("\n") if re.search("[^\x20\x09-\x0D]", ln)]
    return (len(words), sum(map(len, words)), sum(sum(c in "#*$%&|<>" for c in w) for w in words), len(lines) - len(set(lines)), len(covered))


def texts(rnd, n):
    vocab = ["".join(rnd.choices("abcdefgé", k=rnd.randint(1, 9))) for _ in range(300)]
    return ["\n".join(" ".join(rnd.choices(vocab, k=rnd.randint(5, 20))) for _ in range(rnd.randint(3, 12))) for _ in range(n)]


def test_base_statistics(spark):
    rnd = random.Random(1)
    rows = [None, "", " \t\n\x0b", "a", "a b", "a b c a b c", "x x x x x", "1 2 3 4 1 2 3 9 2 3 4", "l\nl\n \n\nl\nk", "#*$%&|<> 日本 é b", "w " * 30000] + texts(rnd, 20)
    docs = spark.createDataFrame([(i, t, None, "s", 5, "x") for i, t in enumerate(rows)], "doc_id long, text string, lang string, source string, n_words int, measures string")
    got = {r["doc_id"]: r for r in quality.statistics(docs, ["doc_id"]).collect()}
    for i, t in enumerate(rows):
        want = brute(t)
        assert tuple(got[i][c] for c in quality.BASE) == want, (i, t)
        assert got[i]["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])


def test_chi_square():
    assert quality.chi2_cdf(7.8408, 6) == pytest.approx(0.75, abs=1e-4)
    assert quality.chi2_quantile(0.999, 6) == pytest.approx(22.458, abs=1e-3)
    assert quality.truncation_factor(0.75, 6) > 1


def brute_mcd(x, floors, steps, subset):
    grid = np.sort(np.round(x * quality.GRID), axis=0)
    at = lambda s: grid[math.ceil(len(x) * s) - 1]
    mu, sd = at(0.5) / quality.GRID, np.sqrt(((at(0.75) - at(0.25)) / (quality.GRID * 1.349)) ** 2 + floors ** 2)
    inv, factor = np.diag(1 / sd ** 2), quality.truncation_factor(subset, x.shape[1])
    for _ in range(steps):
        d = np.einsum("ni,ij,nj->n", x - mu, inv, x - mu)
        b = np.round(np.log1p(d) * quality.DISTANCE_GRID)
        close = x[b <= np.sort(b)[math.ceil(len(x) * subset) - 1]]
        mu = close.mean(axis=0)
        inv = np.linalg.inv(np.cov(close.T, bias=True) * factor + np.diag(floors ** 2))
    return mu, inv


def test_estimates_equal_numpy(spark):
    rng = np.random.default_rng(4)
    floors = {"u": 0.01, "v": 0.02, "w": 0.5}
    data = {g: np.r_[rng.multivariate_normal([g, 1, 0], [[1, .6, 0], [.6, 1, 0], [0, 0, 0]], 400), rng.normal(20, 1, (60, 3))] for g in (0, 1)}
    rows = spark.createDataFrame([(str(g), *map(float, r)) for g, x in data.items() for r in x], "grp string, u double, v double, w double")
    for r in quality.estimates(spark, rows, floors).collect():
        mu, inv = brute_mcd(data[int(r["grp"])], np.array(list(floors.values())), quality.STEPS, quality.SUBSET)
        low = np.array([[r[f"l_{i}_{j}"] if j <= i else 0.0 for j in range(3)] for i in range(3)])
        assert np.allclose([r[f"mu_{i}"] for i in range(3)], mu, atol=1e-8)
        assert np.allclose(low.T @ low, inv, rtol=1e-6, atol=1e-8)


def test_outliers_go_and_clean_texts_stay(spark):
    rnd = random.Random(2)
    clean = [t for t in texts(rnd, 260)]
    rows = [(i, t, "en", "a" if i % 3 else None) for i, t in enumerate(clean)]
    junk = ["".join(f"{w}*** " for w in clean[0].split() * 2), clean[1].upper().replace(" ", "!! ") + " AB!! " * 3]
    rows += [(1000 + i, t, "en", "a") for i, t in enumerate(junk)] + [(0, clean[0], "en", None), (2000, None, None, None), (2001, "", "zz", "q"), (2002, "a b c " * 100, "en", "a")]
    docs = spark.createDataFrame([(*r, "k", 1.0) for r in rows], "doc_id long, text string, lang string, source string, kept string, grp double")
    out = quality.quality(spark, docs)
    got = {r["doc_id"]: r for r in out.collect()}
    assert out.columns == ["doc_id", *quality.BASE, "base_failed", "kept"] and out.count() == len(rows)
    lost = [i for i, t, *_ in rows if i < 1000 and not got[i]["kept"] and not got[i]["base_failed"]]
    assert not lost and not any(got[i]["kept"] for i in (1000, 1001, 2000, 2001, 2002))
    kept = quality.keep_good(spark, docs)
    assert kept.schema.names == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r["doc_id"] for r in out.where("kept").collect())


def vectors(rng, lang, source, centre, n, first):
    return [(first + i, lang, source, False, *map(float, r)) for i, r in enumerate(rng.normal(centre, 0.1, (n, len(quality.FLOORS))))]


VECTORS = "doc_id long, lang string, source string, base_failed boolean, " + ", ".join(f"{n} double" for n in quality.FLOORS)


def test_a_small_group_is_judged_by_its_own_centre(spark):
    rng = np.random.default_rng(7)
    rows = vectors(rng, "en", "a", 0, 600, 0) + vectors(rng, "fr", "a", 3, 60, 1000) + vectors(rng, "en", "b", 3, 30, 2000) + vectors(rng, "fr", "a", 0, 1, 3000)
    kept = {r["doc_id"]: r["kept"] for r in quality.judged(spark, spark.createDataFrame(rows, VECTORS), ["doc_id"]).collect()}
    assert len(kept) == len(rows) and not kept.pop(3000)
    assert all(kept.values())


def test_estimates_are_drawn_toward_the_wider_group_by_size(spark):
    rng = np.random.default_rng(8)
    rows = spark.createDataFrame(vectors(rng, "en", "a", 0, 300, 0) + vectors(rng, "en", None, 1, 20, 1000) + vectors(rng, None, "a", 2, 1, 2000), VECTORS)
    p = len(quality.FLOORS)
    keyed = rows.select(quality.F.explode(quality.F.array(*quality._keys())).alias("grp"), *quality.FLOORS)
    plain = {r["grp"]: r for r in quality.estimates(spark, keyed, quality.FLOORS).collect()}
    vector = lambda r: np.array([r[f"mu_{i}"] for i in range(p)])
    matrix = lambda r: np.array([[r[f"c_{min(i, j)}_{max(i, j)}"] for j in range(p)] for i in range(p)])

    def wanted(*keys):
        mu, cov = vector(plain["0"]), matrix(plain["0"])
        for k in keys:
            r = plain[k]
            mu = (r["n"] * vector(r) + quality.CENTRE_PRIOR * mu) / (r["n"] + quality.CENTRE_PRIOR)
            cov = (r["n"] * matrix(r) + quality.SPREAD_PRIOR * cov) / (r["n"] + quality.SPREAD_PRIOR)
        return mu, cov

    got = {r["name"]: r for r in quality.group_estimates(spark, rows).collect()}
    for name, keys in {'2{"lang":"en","source":"a"}': ['1{"lang":"en"}'], '2{"lang":"en"}': ['1{"lang":"en"}'], '2{"source":"a"}': ["1{}"]}.items():
        mu, cov = wanted(*keys, name)
        low = np.array([[got[name][f"l_{i}_{j}"] if j <= i else 0.0 for j in range(p)] for i in range(p)])
        assert np.allclose(vector(got[name]), mu) and np.allclose(low.T @ low, np.linalg.inv(cov), rtol=1e-6)
    assert len(got) == 3


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert quality.quality(spark, docs).count() == 0


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a", "b", "c")], "doc_id long, text string, lang string, source string")
    plan = quality.quality(spark, docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
