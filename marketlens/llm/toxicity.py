"""Toxicity by compression distance.

Two zstandard dictionaries are trained: one on ordinary text, and one on what toxic text has and
ordinary text hardly has (the words around character runs that are over-represented in toxic
text). The toxic compressor holds the ordinary dictionary too, so common words cost the same under both and
the two compressed lengths of a window of words differ by what the toxic dictionary explains. A
document's largest such gains, and how many windows pass each gain, go to a logistic model that
is calibrated on labelled rows the dictionaries have not seen; 0.5 is the threshold.

Only the trained model (about 20 KB) travels to the executors. Training reads a bounded sample of
labelled rows: ``TRAIN_ROWS`` of each class, the ones with the smallest hash of their id, and of a text beyond ``TRAIN_CHARS``
characters the pieces of ``PIECE`` characters with the smallest hash, wherever they stand; all rows are scored over their whole text.

Defined results: null text counts as empty; an empty text has no window and gets the model's
score of no gain; repeated rows get equal scores; without labelled rows of both classes every
score is 0 (none toxic) or 1 (none ordinary); an empty table gives no rows.
"""
from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: Rows a class and characters a row to train on; characters of a piece of a longer text.
TRAIN_ROWS, TRAIN_CHARS, PIECE = 2000, 65_536, 1024
#: The ordinary dictionary is trained on at most so many samples of so many bytes, those with the smallest hash.
SAMPLES, SAMPLE_BYTES = 20_000, 512
WINDOW_WORDS, STEP_WORDS = 8, 4
ORDINARY_BYTES, TOXIC_BYTES = 16_384, 2_048
GRAM, MIN_SHARE, MIN_PLACES, MIN_RATIO = 5, 0.01, 5, 20.0
LEVEL = 3
GAINS = (1, 2, 3, 4, 5, 6, 8)
TOP = 3
RIDGE = 1e-2


def _words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().split()


def sampled(text: str, chars: int = TRAIN_CHARS, piece: int = PIECE) -> str:
    """``text``, or if it is longer the pieces of it with the smallest hash, ``chars`` characters of them, in order."""
    if len(text) <= chars:
        return text
    pieces = [text[i:i + piece] for i in range(0, len(text), piece)]
    chosen = sorted(range(len(pieces)), key=lambda i: (xxhash.xxh64_intdigest(pieces[i]), i))[:max(1, chars // piece)]
    return " ".join(pieces[i] for i in sorted(chosen))


def windows(words: list[bytes], size: int = WINDOW_WORDS, step: int = STEP_WORDS) -> list[bytes]:
    """Overlapping runs of ``size`` words that cover all words."""
    return [b" " + b" ".join(words[i:i + size]) + b" " for i in range(0, max(1, len(words) - size + step), step)] if words else []


def _grams(word: bytes) -> set[bytes]:
    word = b" " + word + b" "
    return {word[i:i + GRAM] for i in range(len(word) - GRAM + 1)}


def _support(seqs: set[tuple[bytes, ...]], of=None) -> tuple[Counter, int]:
    """In how many distinct places (word with both neighbours) each character run occurs, and the number of
    places; text that copies share has the same places and so counts once."""
    places = {(seq[i - 1] if i else b"", word, seq[i + 1] if i + 1 < len(seq) else b"") for seq in seqs for i, word in enumerate(seq)}
    count: Counter = Counter()
    for word, n in Counter(word for _, word, _ in places).items():
        for gram in _grams(word) if of is None else _grams(word) & of:
            count[gram] += n
    return count, max(1, len(places))


@dataclass
class Model:
    """Two dictionaries and a logistic model; ``weights`` is None when one class is missing."""
    ordinary: bytes = b""
    toxic: bytes = b""
    weights: np.ndarray | None = None
    constant: float = 0.0
    _pair: tuple | None = field(default=None, repr=False, compare=False)

    def __getstate__(self):
        return {**self.__dict__, "_pair": None}

    def _compressors(self):
        if self._pair is None:
            import zstandard as zs
            params = zs.ZstdCompressionParameters.from_level(
                LEVEL, source_size=64, dict_size=ORDINARY_BYTES + TOXIC_BYTES, write_content_size=False,
                write_checksum=False, write_dict_id=False, format=zs.FORMAT_ZSTD1_MAGICLESS)
            pair = []
            for content in (self.ordinary, self.ordinary + self.toxic):
                d = zs.ZstdCompressionDict(content, dict_type=zs.DICT_TYPE_FULLDICT)
                d.precompute_compress(compression_params=params)
                pair.append(zs.ZstdCompressor(dict_data=d, compression_params=params).compress)
            self._pair = tuple(pair)
        return self._pair

    def features(self, text: str | None) -> np.ndarray:
        plain, toxic = self._compressors()
        parts = windows(_words(text))
        gains = sorted((g for g in (len(plain(w)) - len(toxic(w)) for w in parts) if g > 0), reverse=True)
        top = (gains + [0] * TOP)[:TOP]
        return np.array([*top, *(math.log1p(sum(g >= k for g in gains)) for k in GAINS), math.log1p(len(parts)), 1.0])

    def score(self, text: str | None) -> float:
        if self.weights is None:
            return self.constant
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, float(self.features(text) @ self.weights)))))


def _logistic(x: np.ndarray, y: np.ndarray, share: float) -> np.ndarray:
    """Ridge logistic regression by Newton steps; rows weigh as if ``share`` of them were toxic."""
    mean, sd = x[:, :-1].mean(axis=0), x[:, :-1].std(axis=0) + 1e-9
    z = np.c_[(x[:, :-1] - mean) / sd, np.ones(len(x))]
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    w = np.zeros(z.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hess = (z * (weight * p * (1 - p))[:, None]).T @ z + RIDGE * np.eye(len(w))
        w = w - np.linalg.solve(hess, z.T @ (weight * (p - y)) + RIDGE * w)
    out = np.append(w[:-1] / sd, w[-1] - (w[:-1] * mean / sd).sum())
    return out


def train(toxic: list[str], ordinary: list[str], toxic_share: float) -> Model:
    """Fit from two lists of texts: two thirds make the dictionaries, the rest calibrates."""
    import zstandard as zs
    if not toxic or not ordinary:
        return Model(constant=1.0 if toxic else 0.0)
    held = lambda texts: ([t for i, t in enumerate(texts) if i % 3], texts[::3])
    (dict_t, cal_t), (dict_o, cal_o) = held(toxic), held(ordinary)
    seqs_t, seqs_o = ({tuple(_words(t)) for t in texts} for texts in (dict_t, dict_o))
    in_toxic, size_t = _support(seqs_t)
    in_toxic = {g: n for g, n in in_toxic.items() if n >= max(MIN_PLACES, MIN_SHARE * len(seqs_t))}
    in_ordinary, size_o = _support(seqs_o, in_toxic.keys())
    marked = {g for g, n in in_toxic.items() if n / size_t > MIN_RATIO * (in_ordinary[g] + 0.5) / size_o}
    samples = []
    for seq in seqs_t:
        own = sorted(w for w in set(seq) if not marked.isdisjoint(_grams(w)))
        if own:
            samples.append(b" " + b" ".join(own) + b" ")
    samples.sort()
    plain = [b" " + b" ".join(s) + b" " for s in sorted(seqs_o)]
    plain = [p[i:i + SAMPLE_BYTES] for p in plain for i in range(0, len(p), SAMPLE_BYTES)]
    if len(plain) > SAMPLES:
        plain = sorted(sorted(plain, key=lambda p: (xxhash.xxh64_intdigest(p), p))[:SAMPLES])
    try:
        # few or tiny samples are repeated: the trainer wants a minimum of data
        ordinary_dict = zs.train_dictionary(ORDINARY_BYTES, plain * (1 + 2000 // max(1, len(plain)))).as_bytes()
        toxic_dict = zs.train_dictionary(TOXIC_BYTES, samples * (1 + 4000 // len(samples)), k=64, d=6).as_bytes() if samples else b""
    except zs.ZstdError:
        return Model(constant=1.0 if toxic_share >= 0.5 else 0.0)
    model = Model(ordinary_dict, toxic_dict)
    x = np.array([model.features(t) for t in cal_t + cal_o])
    y = np.array([1.0] * len(cal_t) + [0.0] * len(cal_o))
    model.weights = _logistic(x, y, min(0.9, max(0.1, toxic_share)))
    return model


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, chars: int = TRAIN_CHARS) -> Model:
    """Train on labelled rows outside the held-out fold (crc32 of the id, modulo 5, is 0)."""
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where("toxic in (0, 1)")
    marks = marks.where(F.pmod(common.id_crc32(), F.lit(5)) != 0)
    shares = {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}
    picked = None
    for kind in (0, 1):
        own = marks.where(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        picked = own if picked is None else picked.union(own)
    texts = docs.select("doc_id", common.text_or_empty().alias("text")).join(F.broadcast(picked), "doc_id")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([sampled(t, chars) for t in b.column(1).to_pylist()], pa.string()), b.column(2)], names=b.schema.names)

    got = texts.mapInArrow(pieces, texts.schema).dropDuplicates(["doc_id", "toxic"]).collect()  # at most 2 * rows
    got.sort(key=lambda r: str(r["doc_id"]))
    split = [[r["text"] for r in got if r["toxic"] == kind] for kind in (0, 1)]
    return train(split[1], split[0], shares.get(1, 0) / max(1, sum(shares.values())))


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, score) for every row, each over its whole text."""
    src = docs.select(F.col(id_col), common.text_or_empty(text_col).alias("text"))
    schema = T.StructType([T.StructField(id_col, src.schema[id_col].dataType), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([model.score(t) for t in b.column(1).to_pylist()], pa.float64())], names=[id_col, "score"])

    return src.mapInArrow(run, schema)


def keep_ordinary(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows scored 0.5 or more, all columns as they were."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = [model.score(t) < 0.5 for t in b.column(b.schema.get_field_index(text_col)).to_pylist()]
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows doc_id, held_out, score, predicted: one per row of ``docs``."""
    common.small_batches(spark)
    out = scored(docs, fit(docs, labels))
    return out.select("doc_id", (F.pmod(common.id_crc32(), F.lit(5)) == 0).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))
