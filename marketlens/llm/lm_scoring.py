"""Language-model scoring: a hashed maximum-entropy model with class-factored softmax.

log P(token | history) = log P(class | history) + log P(token | class). The class factor is a
maximum-entropy model over CLASSES classes whose features are hashed: the previous word, the words
two and three back (skip features) and the classes of the two previous words, plus a bias. The
word factor has one feature per word, whose maximum-entropy solution is the word's smoothed share
of its class: (c + 1) / (T + V + 1), T and V being the class's training tokens and distinct words
and c = 0 standing for any unseen word. So every history gives a proper distribution.

Words are hashed by their ends into BUCKETS; classes are clusters of buckets by the words seen before
them, counted over the whole training set. Weights are trained by distributed gradient updates:
every partition runs Adagrad over its documents from the common weights, and the partitions'
weights are averaged by how often each row was updated, in rounds of at most FAN_IN tables a task
(model size is fixed, group size is bounded). Unigram counts cover the whole training set and grow
with it: the HEAD most frequent words travel to the executors, all others meet their count in a join.

Defined results: null text counts as empty (one end token); repeated rows are scored (and learned)
as often as they occur; a null id counts as the empty text in the fold's crc32; an empty training
set gives uniform classes and counts of zero; an empty table gives no rows.
"""
from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

BUCKETS, CONTEXTS, CLASSES, SINGLES = 1 << 13, 32, 64, 24
TEMPLATES = 3
ROWS = TEMPLATES * BUCKETS + CLASSES * CLASSES + 1
BIAS = ROWS - 1
#: Words whose counts are sent to the executors; the others' counts are joined.
HEAD = 1 << 18
#: Words a worker remembers beyond these (memory bound only).
REMEMBER = 400_000
#: DAMPING keeps the first steps of rarely seen rows small.
BATCH, RATE, DAMPING, EPOCHS = 4096, 2.0, 3.0, 1
FAN_IN, BLOCK_ROWS = 16, 1024
#: Tokens whose sums fit a core's cache.
CACHED = 512
#: Longest run of equal rows that is summed together with the others.
SHORT = 6
END = b"\n"  # no word holds white space
HELD_OUT = (7, 2)


def tokens(text: str | None) -> list[bytes]:
    words = (text or "").encode().lower().split()
    words.append(END)
    return words


def bucket(word: bytes) -> int:
    """Hash of a word's ends: words formed alike share a bucket."""
    return zlib.crc32(word[:3] + b" " + word[-3:]) % BUCKETS


class Lexicon(dict):
    """Word -> code; codes below ``known`` are head words, others are given out as words come."""

    def __init__(self, head: list[bytes]) -> None:
        super().__init__(zip(head, range(len(head))))
        self.known, self._head = len(head), head
        self.buckets = np.empty(len(head) + REMEMBER, dtype="i4")
        self.buckets[:self.known] = [bucket(w) for w in head]

    def __missing__(self, word: bytes) -> int:
        code = len(self)
        self.buckets[code] = bucket(word)
        self[word] = code
        return code

    def full(self, words: list[bytes]) -> bool:
        """The codes given out so far end with the next call."""
        return len(self) + len(words) > len(self.buckets)

    def codes(self, words: list[bytes]) -> np.ndarray:
        """Codes of one text's words, valid until the next call."""
        if self.full(words):
            self.clear()
            self.update(zip(self._head, range(self.known)))
            if self.known + len(words) > len(self.buckets):
                self.buckets = np.resize(self.buckets, self.known + len(words))
        return np.fromiter(map(self.__getitem__, words), dtype="i4", count=len(words))


def contexts(buckets: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """All texts' buckets in one array, and the buckets one to TEMPLATES tokens back (END before a text)."""
    flat, end = np.concatenate(buckets), bucket(END)
    place = np.concatenate([np.arange(len(b)) for b in buckets])
    back = []
    for k in range(1, TEMPLATES + 1):
        b = np.full(len(flat), end, dtype="i4")
        b[k:] = flat[:-k] if k < len(flat) else flat[:0]
        b[place < k] = end
        back.append(b)
    return flat, back


def feature_rows(back: list[np.ndarray], classes: np.ndarray) -> np.ndarray:
    """Weight rows of every token: one column per feature, the bias apart."""
    pair = classes[back[1]].astype("i4") * CLASSES + classes[back[0]]
    return np.stack([*(b + t * BUCKETS for t, b in enumerate(back)), pair + TEMPLATES * BUCKETS], axis=1)


def log_softmax(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    out = np.empty((len(rows), weights.shape[1]), dtype=weights.dtype)
    more = np.empty_like(out[:CACHED])
    for i in range(0, len(rows), CACHED):
        at, z = rows[i:i + CACHED], out[i:i + CACHED]
        np.take(weights, at[:, 0], axis=0, out=z, mode="clip")
        z += weights[BIAS]
        for j in range(1, at.shape[1]):
            z += np.take(weights, at[:, j], axis=0, out=more[:len(at)], mode="clip")
        z -= z.max(axis=1, keepdims=True)
        z -= np.log(np.exp(z, out=more[:len(at)]).sum(axis=1, keepdims=True))
    return out


def run_sums(grad: np.ndarray, order: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of ``grad[order]`` over runs: short runs, which are most, by their first, second, ... rows together."""
    out = grad[order[starts]]
    for k in range(1, SHORT):
        at = np.nonzero((sizes > k) & (sizes <= SHORT))[0]
        out[at] += grad[order[starts[at] + k]]
    for i in np.nonzero(sizes > SHORT)[0]:
        out[i] = grad[order[starts[i]:starts[i] + sizes[i]]].sum(axis=0)
    return out


def train_rows(weights: np.ndarray, squares: np.ndarray, used: np.ndarray, rows: np.ndarray, target: np.ndarray) -> None:
    """One Adagrad step on a batch, in place (a step size for each row); ``used`` counts the tokens behind each row."""
    grad = np.exp(log_softmax(weights, rows))
    grad[np.arange(len(target)), target] -= 1

    def step(at: np.ndarray, g: np.ndarray, n) -> None:
        squares[at] += np.einsum("ij,ij->i", g, g)
        g *= (RATE / np.sqrt(squares[at] + DAMPING))[:, None]
        weights[at] -= g
        used[at] += n

    totals = []
    for j in range(rows.shape[1]):
        order = np.argsort(rows[:, j].astype("u2") if ROWS <= 1 << 16 else rows[:, j], kind="stable")
        own = rows[order, j]
        starts = np.nonzero(np.r_[True, own[1:] != own[:-1]])[0]
        sizes = np.diff(np.r_[starts, len(own)])
        totals.append((own[starts], run_sums(grad, order, starts, sizes), sizes))
    totals.append((np.array([BIAS]), grad.sum(axis=0, keepdims=True), len(target)))
    for total in totals:
        step(*total)


# ------------------------------------------------------------------ distributed sums of fixed-size tables

def _table_batches(table: np.ndarray, shard: int) -> Iterator[pa.RecordBatch]:
    for no in range(0, len(table), BLOCK_ROWS):
        part = np.ascontiguousarray(table[no:no + BLOCK_ROWS], dtype="<f4")
        if part.any():
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([no // BLOCK_ROWS], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["shard", "block", "data"])


def _summed(key, pdf):
    import pandas as pd
    total = np.sum([np.frombuffer(x, "<f4").astype("f8") for x in pdf["data"]], axis=0)
    return pd.DataFrame({"shard": [key[1]], "block": [key[0]], "data": [total.astype("<f4").tobytes()]})


def table_sum(spark: SparkSession, parts: DataFrame, shape: tuple[int, int]) -> np.ndarray:
    """Sum of the tables that partitions gave as (shard, block, data); no task sums more than FAN_IN at once."""
    parts = common.materialize(spark, parts)
    shards = (parts.agg(F.max("shard")).first()[0] or 0) + 1
    while shards > 1:
        shards = -(-shards // FAN_IN)
        grouped = parts.withColumn("shard", F.floor(F.col("shard") / FAN_IN)).groupBy("block", "shard")
        parts = grouped.applyInPandas(_summed, "shard long, block int, data binary")
        parts = common.materialize(spark, parts) if shards > 1 else parts
    out = np.zeros(shape, dtype="f4")
    for r in parts.select("block", "data").collect():  # one table of fixed size
        got = np.frombuffer(r["data"], "<f4").reshape(-1, shape[1])
        out[r["block"] * BLOCK_ROWS:r["block"] * BLOCK_ROWS + len(got)] = got
    return out


# ------------------------------------------------------------------ training

def _train_texts(docs: DataFrame) -> DataFrame:
    return docs.where(F.pmod(common.id_crc32(), F.lit(HELD_OUT[0])) != HELD_OUT[1]).select(common.text_or_empty().alias("text"))


def coded_texts(train: DataFrame) -> DataFrame:
    """The training texts read once: rows word (bytes), c, which count the words in part, and rows text, the buckets of a text's tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, total, found = Lexicon([]), np.zeros(0, dtype="i8"), []
        names = ["word", "c", "text"]

        def tally() -> None:
            nonlocal total
            if found:
                got = np.bincount(np.concatenate(found), minlength=len(total))
                got[:len(total)] += total
                total = got
                found.clear()

        def counted() -> pa.RecordBatch:
            nonlocal total
            tally()
            n, total = total, np.zeros(0, dtype="i8")
            return pa.RecordBatch.from_arrays([pa.array(list(lexicon)[:len(n)], pa.binary()), pa.array(n, pa.int64()), pa.nulls(len(n), pa.binary())], names=names)

        for batch in batches:
            texts = []
            for text in batch.column(0).to_pylist():
                words = tokens(text)
                if lexicon.full(words):
                    yield counted()
                found.append(lexicon.codes(words))
                texts.append(lexicon.buckets[found[-1]].astype("<u2").tobytes())
            tally()
            yield pa.RecordBatch.from_arrays([pa.nulls(len(texts), pa.binary()), pa.nulls(len(texts), pa.int64()), pa.array(texts, pa.binary())], names=names)
        yield counted()

    return train.mapInArrow(run, "word binary, c long, text binary")


def _buckets(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(x, "<u2").astype("i4") for x in batch.column(0).to_pylist()]


def _numbered(df: DataFrame) -> DataFrame:
    return df.withColumn("shard", F.spark_partition_id().cast("long"))


def context_table(spark: SparkSession, train: DataFrame) -> np.ndarray:
    """From rows text (buckets): for each bucket, how often each hashed previous word came before it (whole training set)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, shard = np.zeros(BUCKETS * CONTEXTS, dtype="i8"), 0
        for batch in batches:
            shard = batch.column(1)[0].as_py() if len(batch) else shard
            parts = _buckets(batch)
            if parts:
                flat, back = contexts(parts)
                total += np.bincount(flat.astype("i8") * CONTEXTS + back[0] % CONTEXTS, minlength=len(total))
        yield from _table_batches(total.reshape(BUCKETS, CONTEXTS), shard)

    return table_sum(spark, _numbered(train).mapInArrow(run, "shard long, block int, data binary"), (BUCKETS, CONTEXTS))


def cluster(table: np.ndarray, rounds: int = 12) -> np.ndarray:
    """Class of every bucket: the SINGLES most frequent stand alone, the others are k-means clusters of
    what precedes them, weighted by frequency; buckets never seen join class 0."""
    mass = table.sum(axis=1)
    order = np.argsort(-mass, kind="stable")
    out = np.zeros(BUCKETS, dtype="i4")
    out[order[:SINGLES]] = np.arange(SINGLES)
    rest = order[SINGLES:]
    rest = rest[mass[rest] > 0]
    if not len(rest):
        return out
    x = np.sqrt(table[rest] / mass[rest][:, None]).astype("f4")
    centres = x[:CLASSES - SINGLES].copy()
    for _ in range(rounds):
        near = np.argmax(x @ centres.T - 0.5 * (centres ** 2).sum(axis=1), axis=1)
        for k in range(len(centres)):
            own = near == k
            if own.any():
                centres[k] = np.average(x[own], axis=0, weights=mass[rest][own])
    out[rest] = SINGLES + near
    return out


@dataclass
class Model:
    classes: np.ndarray       # bucket -> class
    weights: np.ndarray       # hashed rows x classes
    log_size: np.ndarray      # log10(T + V + 1) of every class
    head: list[bytes]
    head_log: np.ndarray      # log10(c + 1) of the head words
    train_tokens: int
    vocabulary: int
    counts: DataFrame         # word, c: all training words


def train_weights(spark: SparkSession, train: DataFrame, classes: np.ndarray, prior: np.ndarray, epochs: int = EPOCHS) -> np.ndarray:
    weights = np.zeros((ROWS, CLASSES), dtype="f4")
    weights[BIAS] = prior
    for _ in range(epochs):
        sent = spark.sparkContext.broadcast(weights)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            w = sent.value.copy()
            squares, used, shard = np.zeros(ROWS, dtype="f4"), np.zeros(ROWS, dtype="f4"), 0
            for batch in batches:
                shard = batch.column(1)[0].as_py() if len(batch) else shard
                parts = _buckets(batch)
                if parts:
                    flat, back = contexts(parts)
                    rows, target = feature_rows(back, classes), classes[flat]
                    for i in range(0, len(flat), BATCH):
                        train_rows(w, squares, used, rows[i:i + BATCH], target[i:i + BATCH])
            yield from _table_batches(np.c_[w * used[:, None], used], shard)

        total = table_sum(spark, _numbered(train).mapInArrow(run, "shard long, block int, data binary"), (ROWS, CLASSES + 1))
        seen = total[:, -1] > 0
        weights = weights.copy()
        weights[seen] = total[seen, :-1] / total[seen, -1:]
    return weights


def fit(spark: SparkSession, docs: DataFrame, head: int = HEAD) -> Model:
    coded = common.materialize(spark, coded_texts(_train_texts(docs)))
    train = coded.where("text is not null").select("text")
    counts = common.materialize(spark, coded.where("word is not null").groupBy("word").agg(F.sum("c").alias("c")))
    classes = cluster(context_table(spark, train))

    def classed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [int(classes[bucket(w)]) for w in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), b.column(1)], names=["k", "c"])

    sizes = {r["k"]: (r["t"], r["v"]) for r in counts.mapInArrow(classed, "k int, c long").groupBy("k").agg(F.sum("c").alias("t"), F.count("*").alias("v")).collect()}
    t = np.array([sizes.get(k, (0, 0))[0] for k in range(CLASSES)], dtype="f8")
    v = np.array([sizes.get(k, (0, 0))[1] for k in range(CLASSES)], dtype="f8")
    weights = train_weights(spark, train, classes, np.log((t + 1) / (t.sum() + CLASSES)).astype("f4"))
    top = counts.orderBy(F.desc("c"), "word").limit(head).toArrow()  # compact on the driver, at most ``head`` rows
    return Model(classes, weights, np.log10(t + v + 1), top.column("word").to_pylist(),
                 np.log10(np.array(top.column("c").to_pylist(), dtype="f8") + 1), int(t.sum()), int(v.sum()), counts)


# ------------------------------------------------------------------ scoring

def _score_batches(batches: Iterator[pa.RecordBatch], model, names: list[str]) -> Iterator[pa.RecordBatch]:
    classes, weights, log_size, head, head_log = model
    lexicon = Lexicon(head)
    for batch in batches:
        parts, n, known, logs, tail_words, tail_n = [], [], [], [], [], []
        for text in batch.column(2).to_pylist():
            words = tokens(text)
            codes = lexicon.codes(words)
            parts.append(lexicon.buckets[codes])
            own = codes[codes < len(head)]
            rare = Counter(words[i] for i in np.nonzero(codes >= len(head))[0])
            n.append(len(words))
            known.append(len(own))
            logs.append(float(head_log[own].sum()))
            tail_words.append(list(rare))
            tail_n.append(list(rare.values()))
        model_log = []
        if parts:
            flat, back = contexts(parts)
            rows, target = feature_rows(back, classes), classes[flat]
            each = np.empty(len(flat))
            for i in range(0, len(flat), BATCH):
                z = log_softmax(weights, rows[i:i + BATCH])
                each[i:i + BATCH] = z[np.arange(len(z)), target[i:i + BATCH]] / math.log(10)
            each -= log_size[target]
            model_log = np.add.reduceat(each, np.cumsum([0, *n[:-1]]))
        yield pa.RecordBatch.from_arrays([
            batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(logs, pa.float64()),
            pa.array(model_log, pa.float64()), pa.array(tail_words, pa.list_(pa.binary())), pa.array(tail_n, pa.list_(pa.int64()))], names=names)


def scored(spark: SparkSession, docs: DataFrame, model: Model) -> DataFrame:
    """Rows doc_id, n_tokens, n_known, train_tokens, base_score, score: one per row of ``docs``."""
    sent = spark.sparkContext.broadcast((model.classes, model.weights, model.log_size, model.head, model.head_log))
    src = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", common.text_or_empty().alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    names = ["row", "doc_id", "n_tokens", "known", "logs", "model_log", "words", "times"]
    part = common.materialize(spark, src.mapInArrow(
        lambda it: _score_batches(it, sent.value, names),
        f"row long, doc_id {kind}, n_tokens long, known long, logs double, model_log double, words array<binary>, times array<long>"))
    rare = part.select("row", F.explode(F.arrays_zip("words", "times")).alias("x")).select("row", F.col("x.words").alias("word"), F.col("x.times").alias("n"))
    found = (rare.join(model.counts, "word").groupBy("row")
             .agg(F.sum("n").alias("rare_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("rare_logs")))
    logs = F.col("logs") + F.coalesce("rare_logs", F.lit(0.0))
    return part.join(found, "row", "left").select(
        "doc_id", "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * math.log10(model.train_tokens + model.vocabulary + 1)).alias("base_score"),
        (logs + F.col("model_log")).alias("score"))


def lm_scores(spark: SparkSession, docs: DataFrame) -> DataFrame:
    common.small_batches(spark)
    out = scored(spark, docs, fit(spark, docs))
    held = F.pmod(common.id_crc32(), F.lit(HELD_OUT[0])) == HELD_OUT[1]
    return out.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
