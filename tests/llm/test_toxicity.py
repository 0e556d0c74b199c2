"""Toxicity: held-out accuracy on invented text, windows, degenerate tables."""
import random
import zlib

import pytest

from marketlens.llm import toxicity


def corpus(n=600):
    rnd = random.Random(6)
    syl = ["an", "er", "th", "ion", "ed", "ou", "re", "he", "st", "nd", "ti", "ble"]
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rnd.choices(syl, k=rnd.randint(1, 4))) for _ in range(rnd.randint(30, 200))]
        toxic = int(rnd.random() < 0.25)
        for _ in range(rnd.randint(2, 6) if toxic else 0):
            words.insert(rnd.randrange(len(words)), rnd.choice(["zquork", "Vilgump", "braxxo"]) + rnd.choice(["", ".", "s", "ly"]))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    return rows, labels


def test_windows_cover_all_words():
    for n in range(0, 30):
        words = [str(i).encode() for i in range(n)]
        parts = toxicity.windows(words)
        assert {w for p in parts for w in p.split()} == set(words)
        assert all(len(p.split()) <= toxicity.WINDOW_WORDS for p in parts)


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame([(a, b, "en", 0.5) for a, b in rows], "doc_id long, text string, lang string, score double")
    out = toxicity.toxicity(spark, docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    truth, hit, n = {i: t for i, _, t in labels}, 0, 0
    for r in out.collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        if r["held_out"]:
            n, hit = n + 1, hit + (r["predicted"] == truth[r["doc_id"]])
    assert n > 80 and hit / n > 0.93


def test_learning_never_reads_held_out_labels(spark):
    rows, labels = corpus(200)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    a, b = (toxicity.fit(docs, spark.createDataFrame(x, "doc_id long, quality int, toxic int")) for x in (labels, flipped))
    assert (a.ordinary, a.toxic, a.weights.tolist()) == (b.ordinary, b.toxic, b.weights.tolist())


@pytest.mark.parametrize("labels,score", [([], 0.0), ([(2, 1)], 0.0), ([(1, None), (None, 1)], 0.0)])
def test_without_both_classes(spark, labels, score):
    docs = spark.createDataFrame([(1, None), (1, ""), (None, "some text"), (2, "b " * 50000)], "doc_id long, text string")
    marks = spark.createDataFrame([(i, t if t != 1 else 0) for i, t in labels], "doc_id long, toxic int")
    assert [r["score"] for r in toxicity.toxicity(spark, docs, marks).collect()] == [score] * 4


def test_keep_ordinary_leaves_the_columns(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame([(a, b, "x", [1]) for a, b in rows] + [(9999, None, None, None), (9998, "", "y", [])], "doc_id long, text string, predicted string, held array<int>")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    kept = toxicity.keep_ordinary(docs, model)
    assert kept.schema == docs.schema
    want = {r["doc_id"] for r in toxicity.scored(docs, model).collect() if r["score"] < 0.5}
    assert {r["doc_id"] for r in kept.collect()} == want and {9998, 9999} <= want and len(want) < len(rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert toxicity.toxicity(spark, docs, spark.createDataFrame([], "doc_id long, toxic int")).count() == 0


def test_scores_equal_a_brute_force_version(spark):
    """The score by the definition: every window compressed alone with fresh compressors of both dictionaries."""
    import math

    import zstandard as zs
    rows, labels = corpus(300)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    params = zs.ZstdCompressionParameters.from_level(toxicity.LEVEL, source_size=64, dict_size=toxicity.ORDINARY_BYTES + toxicity.TOXIC_BYTES,
                                                     write_content_size=False, write_checksum=False, write_dict_id=False, format=zs.FORMAT_ZSTD1_MAGICLESS)

    def length(window, dictionary):
        d = zs.ZstdCompressionDict(dictionary, dict_type=zs.DICT_TYPE_FULLDICT)
        d.precompute_compress(compression_params=params)
        return len(zs.ZstdCompressor(dict_data=d, compression_params=params).compress(window))

    def score(text):
        words, gains, n = text.lower().encode().split(), [], 0
        for start in range(0, max(1, len(words) - 8 + 4), 4):
            if words:
                window = b" " + b" ".join(words[start:start + 8]) + b" "
                n += 1
                gains.append(length(window, model.ordinary) - length(window, model.ordinary + model.toxic))
        gains = sorted((g for g in gains if g > 0), reverse=True)
        x = [*(gains + [0, 0, 0])[:3], *(math.log1p(len([g for g in gains if g >= k])) for k in (1, 2, 3, 4, 5, 6, 8)), math.log1p(n), 1.0]
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(a * b for a, b in zip(x, model.weights))))))

    some = rows[:25] + [(9001, ""), (9002, "zquork"), (9003, "É zquorkly. " * 40)]
    got = {r["doc_id"]: r["score"] for r in toxicity.scored(spark.createDataFrame(some, "doc_id long, text string"), model).collect()}
    assert all(abs(got[i] - score(t)) < 1e-9 for i, t in some)


def test_training_pieces_come_from_the_whole_text():
    text = " ".join(f"w{i}" for i in range(100_000))
    picked = toxicity.sampled(text, 20_000, 500)
    assert len(picked) <= 20_000 + 40 and toxicity.sampled("short", 20_000) == "short"
    numbers = [int(w[1:]) for w in picked.split() if w.startswith("w") and w[1:].isdigit()]
    assert min(numbers) < 20_000 and max(numbers) > 80_000
