"""Byte-level BPE against the tiktoken library, and exact round trips."""
import hashlib
import random

import public_tokenizers as P
import tiktoken

from marketlens.llm import byte_bpe

RANKS = byte_bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
LIB = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def texts():
    rnd = random.Random(4)
    out = [None, "", " ", "a", "it's we'll DON'T 've", "  two  spaces\n\n\tand tabs \r\n end  ", "héllo wörld ñandú ß", "日本語のテキスト 한국어 текст 🙂🙂", "a\x1cb\x85c\xa0d　e",
           "<|endoftext|> x", "1234567 12,5 ½ ²", "don''t ''''", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "\n", " \n ", "x\u0000y ​", "'s", " 's's", "word " * 3000]
    for _ in range(30):
        out.append("".join(rnd.choice("abcdeé ñ.,'\n\t 漢0123#*s") for _ in range(rnd.randint(1, 200))))
        out.append(" ".join("".join(rnd.choices(["th", "ion", "eau", "sch", "ción", "x", "Q"], k=rnd.randint(1, 6))) for _ in range(30)))
    return out


def test_equals_tiktoken_and_round_trips(spark):
    rows = [(i, t, [i]) for i, t in enumerate(texts())] + [(None, "null id", None), (3, "a", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids array<long>")
    for head in (0, 50, 1 << 16):
        got = byte_bpe.encode_documents(spark, docs, RANKS, P.PATTERN, head=head, with_ids=True).collect()
        assert len(got) == len(rows)
        want = {(i, hashlib.sha256((t or "").encode()).hexdigest()): t or "" for i, t, _ in rows}
        for r in got:
            t = want[(r["doc_id"], r["decoded_sha256"])]
            ids = LIB.encode_ordinary(t)
            assert r["ids"] == ids, t
            assert r["n_tokens"] == len(ids) and bytes(r["decoded"]) == t.encode()
            assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_folds_equal_tiktoken():
    rnd = random.Random(1)
    for n in (1, 2, 3, 7, 20, 150, 201, 400, 3000):
        for alphabet in ("ab", "aeiounrst", "thesingreation", "éñç漢"):
            text = "".join(rnd.choices(alphabet, k=n))  # letters only: one match of the pattern
            piece = text.encode()
            assert byte_bpe.fold(piece, RANKS) == LIB.encode_ordinary(text)
            assert byte_bpe._fold_long(piece, RANKS) == byte_bpe.fold(piece, RANKS) or piece in RANKS


def test_units_survive_a_full_memory(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(byte_bpe, "REMEMBER", 3)
    none = pa.table({"u": pa.array([], pa.string()), "i": pa.array([], pa.string()), "b": pa.array([], pa.binary())})
    coder = byte_bpe.UnitCoder(none, RANKS, P.PATTERN)
    for text in ["a b c d e", "c d x y", "x a b zz", "a a a", "q r s t u v w a"] * 2:
        (ids, line, raw), (none_ids, no_line, no_bytes) = coder.encode([text, ""])
        want = LIB.encode_ordinary(text)
        assert ids.tolist() == want and bytes(line).decode() == ",".join(map(str, want)) and bytes(raw) == text.encode()
        assert not len(none_ids) and not bytes(no_line) and not bytes(no_bytes)


def test_folding_side_by_side_equals_folding_one_by_one():
    rnd = random.Random(2)
    pieces = [bytes(rnd.choice(b"aeinrst \xc3\xa9xQ0") for _ in range(rnd.randint(2, 64))) for _ in range(1500)]
    pieces = [p for p in pieces if p not in RANKS]
    ids, sizes = byte_bpe.fold_many(pieces, byte_bpe.PairTable(RANKS))
    ends = sizes.cumsum()
    assert [ids[b - n:b].tolist() for b, n in zip(ends, sizes)] == [byte_bpe.fold(p, RANKS) for p in pieces]


def test_empty_table(spark):
    assert byte_bpe.encode_documents(spark, spark.createDataFrame([], "doc_id long, text string"), RANKS, P.PATTERN).count() == 0
