"""Best-fit packing against a plain per-piece best-fit decreasing and exact round trips."""
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marketlens.llm import common, packing

FILE = public_tokenizers.path("byte_bpe_50k.json")


def brute_bfd(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(rooms) if r >= n]
        if fits:
            i = min(fits, key=lambda i: rooms[i])
            rooms[i] -= n
        else:
            rooms.append(capacity - n)
    return len(rooms)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=120))
def test_runs_equal_item_by_item_best_fit(lengths):
    hist = {n: lengths.count(n) for n in set(lengths)}
    runs, used = packing.plan_runs(hist, 40)
    assert used == brute_bfd(lengths, 40)
    room = {}
    for n, count in hist.items():
        own = sorted(r for r in runs if r[0] == n)
        for r in range(count):
            _, first, seq, per, off = [x for x in own if x[1] <= r][-1]
            j = r - first
            room.setdefault(seq + j // per, []).append((off + j % per * n, n))
    for parts in room.values():
        at = 0
        for off, n in sorted(parts):
            assert off == at
            at += n
        assert at <= 40


def test_cut_leaves_only_the_first_piece_short():
    assert packing.cut(0, 4) == []
    assert packing.cut(3, 4) == [(0, 3)]
    assert packing.cut(4, 4) == [(0, 4)]
    assert packing.cut(9, 4) == [(0, 1), (1, 4), (5, 4)]


def test_cached_encoding_equals_the_library():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(FILE)
    t.encode_special_tokens = True
    texts = ["", " ", "a  b\n\n c\t d ", "it's 12 o'clock...  ", " x  y", "a\x1cb \x85c", "<|endoftext|> x", "ééé\r\n日本語 テキスト", "x" * 5000, "\n\n\n", "  lead", "a \n b"]
    got = packing.WordCachingEncoder(FILE).encode(texts)
    for text, raw in zip(texts, got):
        assert np.frombuffer(raw, "<u4").tolist() == t.encode(text, add_special_tokens=False).ids, repr(text)


def test_words_met_again_outlive_a_full_cache(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 300)
    texts = [" often rather " + " ".join(f"w{i}x{j}" for j in range(250)) for i in range(12)]
    enc, learnt = packing.WordCachingEncoder(FILE), []
    plain = enc._learn
    monkeypatch.setattr(enc, "_learn", lambda units: (learnt.extend(units), plain(units)))
    got = [raw for t in texts for raw in enc.encode([t])]
    assert got == [np.array(enc._tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert len(learnt) == len(set(learnt)) and len(enc._cache) + len(enc._older) < 4 * 300


def test_words_are_learnt_without_the_signs_around_them(monkeypatch):
    enc, learnt = packing.WordCachingEncoder(FILE), []
    plain = enc._learn
    monkeypatch.setattr(enc, "_learn", lambda units: (learnt.extend(units), plain(units)))
    texts = ["x often, often. often; often\u00e9, often\u00e9! often", "x often: often\noften\noften,\noften"]
    got = [raw for t in texts for raw in enc.encode([t])]
    assert got == [np.array(enc._tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert len(learnt) == len(set(learnt)) and sorted(u for u in learnt if "often" in u) == [" often", " often\u00e9", "often"]


PARTS = list("ab'stl12.,!(-_ \n\t\r\x0b\x1c\x00\x7f\x85\xa0\u1680\u2003\u2028\u202f\u3000\u200b\u00c9\u00d7\u00f7\u00b2\u0301\u65e5\u2026\U0001f600") + [
    "  ", "\n\n", "'s", "'re", " the", "ing", "\u00e9t\u00e9"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=25).map("".join), max_size=8))
def test_any_texts_are_encoded_as_the_library_does(texts):
    enc = packing.encoder(FILE)
    want = [np.array(enc._tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    old, enc._cache, enc._older = packing.BLOCK_BYTES, {}, {}
    try:
        assert enc.encode(texts) == want
        packing.BLOCK_BYTES = 20
        for kind in (pa.string(), pa.large_string()):
            assert enc.encode(pa.array(["before", *texts], kind)[1:]) == want
    finally:
        packing.BLOCK_BYTES = old


def test_other_patterns_keep_signs_with_their_words(tmp_path):
    from tokenizers import Regex, Tokenizer, pre_tokenizers
    t = Tokenizer.from_file(FILE)
    t.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(Regex(r"[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"), "isolated"),
                                               pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    t.save(str(tmp_path / "t.json"))
    texts = ["a (the,the) x/the 'the' ", "_the -the\nthe  the\n\nthe", "\u00e9,the"]
    got = packing.WordCachingEncoder(str(tmp_path / "t.json")).encode(texts)
    assert got == [np.array(t.encode(x, add_special_tokens=False).ids, "<u4").tobytes() for x in texts]


def test_pack_documents_round_trip(spark):
    rnd = random.Random(3)
    rows = [(i, " ".join(rnd.choice("the of and zyx qu".split()) for _ in range(rnd.choice([0, 1, 5, 40, 400]))), "x", 1) for i in range(60)]
    rows += [(7, rows[7][1], "x", 1), (None, "null id", "x", 1), (100, None, None, None), (101, "", "x", 1), (102, "long " * 3000, "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sequence_id string, part int")
    placed = packing.pack_documents(spark, docs, FILE, capacity=256)
    out = placed.collect()
    assert placed.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    seqs = {}
    for r in out:
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in seqs.values():
        at = 0
        for off, n in sorted(parts):
            assert off == at
            at += n
        assert at <= 256
    assert len(seqs) == brute_bfd([r["length"] for r in out], 256)
    assert sum(r["doc_id"] == 7 for r in out) == 2 * len({r["piece"] for r in out if r["doc_id"] == 7})
    assert [(r["length"], r["ids_crc32"]) for r in out if r["doc_id"] == 100] == [(1, zlib.crc32(b"\0\0\0\0"))]
    built = {r["sequence_id"]: r["ids"] for r in packing.sequences(docs, placed, FILE, capacity=256).collect()}
    for r in out:
        ids = built[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]]
        assert zlib.crc32(np.asarray(ids, "<u4").tobytes()) == r["ids_crc32"]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack_documents(spark, docs, FILE).count() == 0


def test_special_tokens_as_the_library_encodes_them(spark):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(FILE)
    texts = ["a <|endoftext|> b", "plain text", "<|endoftext|>", "x<|endoftext|>y  z\n", "", "<|endoftext|><|endoftext|> two", "a <|endoftex b"]
    want = [t.encode(x, add_special_tokens=False).ids for x in texts]
    got = [np.frombuffer(raw, "<u4").tolist() for raw in packing.encoder(FILE).encode(texts)]
    assert got == want and want[0] == [64, 220, 50256, 275]
    rows = packing.token_pieces(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), FILE).collect()
    assert {r["doc_id"]: r["length"] for r in rows} == {i: len(x) + 1 for i, x in enumerate(want)}
