"""Token-count rollups: signed changes, replayed and unfinished commits, compaction, and the registered query."""
import os
import re
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from marketlens.llm import token_counts
from marketlens.llm.queries import QUERIES

SCHEMA = "op string, source string, lang string, text string, old_source string, old_lang string, old_text string, n_docs int, sign string, tokenizer_version int"
BPE = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


def brute(state, bpe=None):
    out = Counter()
    for source, lang, text in state:
        counts = {"words-1": len(re.findall("[^\x20\x09-\x0D]+", text or "")),
                  "classes-1": len(re.findall(r"[^\W\d_]+|\d+|(?:[^\w\x20\x09-\x0D]|_)+", text or ""))}
        if bpe:
            counts["bpe"] = len(bpe.encode(text or "", add_special_tokens=False).ids)
        for version, n in counts.items():
            out[(source, lang, version, "docs")] += 1
            out[(source, lang, version, "tokens")] += n
    return {k: v for k, v in out.items() if v}


def totals(store):
    return {(r["source"], r["lang"], r["tokenizer_version"], k): r["n_" + k] for r in store.totals().collect() for k in ("docs", "tokens") if r["n_" + k]}


@pytest.mark.parametrize("vocabularies", [{}, {"bpe": BPE}])
def test_changes_replays_and_compaction(spark, tmp_path, vocabularies):
    bpe = Tokenizer.from_file(BPE) if vocabularies else None
    open_store = lambda: token_counts.Rollup(spark, str(tmp_path / "store"), vocabularies=vocabularies)
    store = open_store()
    assert store.totals().count() == 0
    docs = [("a", "en", "one two, three"), ("a", "en", "one two, three"), ("a", None, None), (None, "fr", "é 12x"), ("b", "en", ""), ("b", "en", "w " * 5000)]
    row = lambda *v: (*v, 1, "+", 2)
    ins = spark.createDataFrame([row("insert", *d, None, None, None) for d in docs], SCHEMA)
    change = spark.createDataFrame([row("delete", *docs[1], None, None, None), row("revise", "b", "en", "new text!", *docs[3])], SCHEMA)
    after = [docs[0], ("b", "en", "new text!"), docs[2], docs[4], docs[5]]
    assert store.commit("a/b @1", ins)
    assert totals(store) == brute(docs, bpe)
    assert store.commit("2", change)
    assert not store.commit("a/b @1", ins) and not open_store().commit("2", change)
    assert totals(open_store()) == brute(after, bpe)
    store.commit("3", spark.createDataFrame([], SCHEMA))
    assert totals(store) == brute(after, bpe) and store.batches() == {"a/b @1", "2", "3"}
    store.compact()
    assert totals(store) == brute(after, bpe) and store.batches() == {"a/b @1", "2", "3"}
    assert not store.commit("2", change)
    store.commit("5", spark.createDataFrame([row("delete", *d, None, None, None) for d in after], SCHEMA))
    store.compact()
    assert store.totals().count() == 0 and store.batches() == {"a/b @1", "2", "3", "5"}


def test_a_commit_killed_before_its_switch_counts_nothing_and_may_be_retried(spark, tmp_path, monkeypatch):
    store = token_counts.Rollup(spark, str(tmp_path / "s"))
    rows = spark.createDataFrame([("insert", "a", "en", "t u")], "op string, source string, lang string, text string")
    store.commit("x", rows)

    def killed(self, kind, name):
        raise RuntimeError("killed")
    with monkeypatch.context() as m:
        m.setattr(token_counts.Rollup, "_switch_on", killed)
        for act in (lambda: store.commit("y", rows), store.compact):
            with pytest.raises(RuntimeError):
                act()
    assert len(os.listdir(tmp_path / "s/folders")) == 3 and totals(store) == brute([("a", "en", "t u")])
    assert store.commit("y", rows) and totals(store) == brute([("a", "en", "t u")] * 2)
    # a replay that died in the middle leaves the batch counted
    assert not store.commit("x", rows) and totals(store) == brute([("a", "en", "t u")] * 2)


def test_changes_without_old_columns(spark, tmp_path):
    store = token_counts.Rollup(spark, str(tmp_path / "s"))
    store.commit("x", spark.createDataFrame([("insert", "a", "en", "t")], "op string, source string, lang string, text string"))
    assert totals(store) == brute([("a", "en", "t")])


def after_all_batches(docs, labels):
    bpe, out = Tokenizer.from_file(BPE), Counter()
    toxic, quality = {}, {}
    for d, q, t in labels:
        if d is not None:
            toxic[d] = max((x for x in (toxic.get(d), t) if x is not None), default=None)
            quality[d] = max((x for x in (quality.get(d), q) if x is not None), default=None)
    for d, source, lang, text in docs:
        if d is not None and toxic.get(d) == 1:
            continue
        if d is not None and quality.get(d) == 0 and text is not None:
            text = re.sub(r"[#*$%&|<>]+", " ", text)
        for k, v in brute([(source, lang, text)]).items():
            out[k] += v
        out[(source, lang, "byte_bpe_50k", "docs")] += 1
        out[(source, lang, "byte_bpe_50k", "tokens")] += len(bpe.encode(text or "", add_special_tokens=False).ids)
    return {k: v for k, v in out.items() if v}


def result(rows):
    return {(r["source"], r["lang"], r["tokenizer_version"], k): r["n_" + k] for r in rows for k in ("docs", "tokens") if r["n_" + k]}


def test_registered_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "lang", "text").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    got = QUERIES["op5_token_counts"](spark, SF)
    assert got.columns == ["source", "lang", "tokenizer_version", "n_docs", "n_tokens"]
    assert result(got.collect()) == after_all_batches(docs, labels)


def test_registered_query_with_clashing_columns_repeated_labels_and_nulls(spark, tmp_path):
    docs = [(1, "a", "en", "x # y"), (2, "a", "en", "p q"), (2, "a", "en", "p q"), (3, None, None, None), (None, "b", "en", "z"), (4, "b", "fr", "a$$b c"), (5, "b", "fr", "")]
    labels = [(1, 0, 0), (1, 0, None), (2, 1, 1), (2, 0, 0), (3, 0, 0), (4, 0, 0), (4, 1, 0), (None, 0, 1), (9, 1, 1)]
    kinds = "doc_id long, source string, lang string, text string"
    spark.createDataFrame([(*d, 1, 0, "t", [1], "n") for d in docs], kinds + ", toxic int, quality long, tokens string, new_tokens array<int>, differs string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(*x, "s", "l", "t") for x in labels], "doc_id long, quality int, toxic int, source string, lang string, text string").write.parquet(str(tmp_path / "labels.parquet"))
    assert result(QUERIES["op5_token_counts"](spark, str(tmp_path)).collect()) == after_all_batches(docs, labels)


def test_registered_query_on_empty_tables(spark, tmp_path):
    for t in ("documents", "labels"):
        spark.read.parquet(f"{SF}/{t}.parquet").where("false").write.parquet(str(tmp_path / f"{t}.parquet"))
    assert QUERIES["op5_token_counts"](spark, str(tmp_path)).count() == 0
