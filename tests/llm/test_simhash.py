"""SimHash near-duplicates against brute force on all pairs."""
import random

import numpy as np
import pytest
import xxhash

from marketlens.llm import common, simhash


def brute_fp(text):
    words = [w for w in __import__("re").split("[\\x20\\x09-\\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    if not words:
        return 0
    sh = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps):
    """{index: smallest index reachable} over links at 2 or fewer bits."""
    low = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i in range(len(fps)):
            for j in range(len(fps)):
                if (fps[i] ^ fps[j]).bit_count() <= 2 and low[j] < low[i]:
                    low[i], changed = low[j], True
    return low


def signed(x):
    return x - 2 ** 64 if x >= 2 ** 63 else x


def clustered(rnd, n):
    out = []
    for _ in range(n):
        x = rnd.choice(out) if out and rnd.random() < 0.7 else rnd.getrandbits(64)
        for _ in range(rnd.choice([0, 1, 2, 3])):
            x ^= 1 << rnd.randrange(64)
        out.append(x)
    return out


def test_carry_save_counts():
    rng = np.random.default_rng(1)
    a, b = rng.integers(-2 ** 62, 2 ** 62, 500), rng.integers(-2 ** 62, 2 ** 62, 500)
    b[:200] = a[:200] ^ np.array([signed(sum(1 << int(p) for p in rng.choice(64, k, replace=False))) for k in rng.integers(0, 6, 200)])
    want = np.array([(int(x) & (2 ** 64 - 1)).bit_count() for x in a ^ b])
    for radius in (0, 1, 2, 3, 5):
        assert (simhash.pairs_within(a ^ b, radius, block=64) == (want <= radius)).all()


def test_masks_cover_every_pair_within_the_radius():
    rnd = random.Random(5)
    for agreed in [0, simhash.refined_masks(0, 2)[3], simhash.refined_masks(simhash.refined_masks(0, 2)[3], 2)[1]]:
        free = [b for b in range(64) if not agreed >> b & 1]
        for _ in range(300):
            d = sum(1 << b for b in rnd.sample(free, 2))
            assert any(not d & m for m in simhash.refined_masks(agreed, 2))


def test_fingerprint_by_definition():
    for t in ["", None, "One", "one TWO", "one two three", "É A b\x0bc\x0c d e a b c", "x " * 500, "a b c d e"]:
        assert simhash.fingerprint(t) == signed(brute_fp(t)), t


@pytest.mark.parametrize("block", [2048, 6])
def test_links_reach_what_brute_force_reaches(spark, block):
    rnd = random.Random(7)
    fps = sorted({signed(x) for x in clustered(rnd, 250)} | {signed(simhash.refined_masks(0, 2)[0] ^ i) for i in range(70)})
    frame = spark.createDataFrame([(x,) for x in fps], "fp long")
    labels = {r["node"]: r["label"] for r in common.components(spark, simhash.links(spark, frame, block=block)).collect()}
    want = brute_components([x & (2 ** 64 - 1) for x in fps])
    assert [labels.get(x, x) for x in fps] == [fps[i] for i in want]


def test_components_of_chain_star_and_self_loop(spark):
    rows = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(500, 500), (None, 3)]
    got = {r["node"]: r["label"] for r in common.components(spark, spark.createDataFrame(rows, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}, 500: 500}
    assert common.components(spark, spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_and_keep_one(spark):
    rnd = random.Random(11)
    vocab = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(80):
        base = rows[rnd.randrange(len(rows))][1] if rows and rnd.random() < 0.5 else " ".join(rnd.choices(vocab, k=rnd.choice([1, 2, 30, 200])))
        rows.append((i, base if rnd.random() < 0.6 else base + " tail"))
    rows += [(5, rows[5][1]), (90, None), (91, ""), (92, " \n"), (None, "lone row"), (None, rows[3][1]), (95, "Z " * 20000)]
    docs = spark.createDataFrame([(a, b, "x", 1) for a, b in rows], "doc_id long, text string, component_id string, fp int")
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["fp"], r["component_id"]) for r in simhash.near_duplicates(spark, docs).collect()), key=str)
    fps = [brute_fp(t) for _, t in rows]
    low = brute_components(fps)
    want = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if low[j] == low[k] and rows[j][0] is not None]
        want.append((i is None, i or 0, signed(fps[k]), min(ids) if ids else None))
    assert got == sorted(want, key=str)
    kept = simhash.keep_one(spark, docs)
    assert kept.columns == docs.columns
    ids = sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect())
    low2 = brute_components([f for f, (i, _) in zip(fps, rows) if i is not None])
    named = [i for i, _ in rows if i is not None]
    assert ids == sorted({min(named[j] for j in range(len(named)) if low2[j] == c) for c in set(low2)})
    assert kept.where("doc_id is null").count() == 2


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(spark, docs).count() == 0
    assert simhash.keep_one(spark, docs).count() == 0
