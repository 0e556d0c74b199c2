"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints are 64-bit majority votes over the XXH64 hashes of a text's word shingles. Distinct
fingerprints meet in buckets: 64 bits are split into radius + 2 segments, two fingerprints within
``radius`` agree on at least two of them, so each fingerprint goes to one bucket per pair of
segments. A bucket of up to BLOCK fingerprints is compared in one go: bit planes are stored
vertically, carry-save counters add up many distances at once, and a block is abandoned once all
its distances exceed the radius. A larger bucket is split exactly: the bits not yet agreed on are
segmented again (at most three times, after which a bucket holds at most 256 distinct
fingerprints), so no group is cut short and none grows with the data. A bucket yields a spanning
forest of its links, not all pairs; connected components over these give the groups.

Defined results: null text counts as empty and has fingerprint zero, which links like any other;
rows with a null id are fingerprinted but never name a group (a group of only such rows has a null
component); repeated rows share a fingerprint; an empty table gives no rows; further columns of
the input are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

BITS = 64
RADIUS = 2
SHINGLE_WORDS = 3
SEED = 42
#: Fingerprints compared as one block; larger buckets are split further (exactly).
BLOCK = 2048
#: Up to this many members, a bucket's pairs are compared across buckets in shared blocks.
SMALL = 32


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Signed 64-bit fingerprint of one text."""
    import xxhash
    words = (text or "").encode().lower().split()  # bytes: A-Z only, ASCII white space
    if not words:
        return 0
    if len(words) < shingle_words:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), seed)]
    else:
        digest = xxhash.xxh64_intdigest
        hashes = [digest(b" ".join(s), seed) for s in zip(*(words[i:] for i in range(shingle_words)))]
    h, votes = np.array(hashes, dtype=">u8"), np.zeros(BITS, dtype="i8")
    for i in range(0, len(h), 1 << 16):
        votes += np.unpackbits(h[i:i + (1 << 16)].view("u1").reshape(-1, 8), axis=1).sum(axis=0, dtype="i8")
    return int.from_bytes(np.packbits(votes * 2 > len(h)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, fp): the signed fingerprint of every row."""
    src = docs.select(F.col(id_col), common.text_or_empty(text_col).alias("text"))
    schema = T.StructType([T.StructField(id_col, src.schema[id_col].dataType), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([fingerprint(t) for t in b.column(1).to_pylist()], pa.int64())], names=[id_col, "fp"])

    return src.mapInArrow(run, schema)


class CarrySave:
    """Bit-sliced counters: add one bit plane at a time to many counts; counts past ``limit`` stick."""

    def __init__(self, shape, limit: int) -> None:
        self._limit = limit
        self._digits = [np.zeros(shape, dtype="u8") for _ in range((limit + 1).bit_length())]
        self._over = np.zeros(shape, dtype="u8")

    def add(self, plane: np.ndarray) -> None:
        carry = plane
        for i, digit in enumerate(self._digits):
            self._digits[i], carry = digit ^ carry, digit & carry
        self._over |= carry

    def within(self) -> np.ndarray:
        """Bits set where the count is ``limit`` or less."""
        above, same = self._over.copy(), ~np.zeros_like(self._over)
        for i in reversed(range(len(self._digits))):
            if self._limit >> i & 1:
                same &= self._digits[i]
            else:
                above |= same & self._digits[i]
                same &= ~self._digits[i]
        return ~above


def _bits(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.astype(">i8").view("u1").reshape(-1, 8), axis=1)


def _planes(bits: np.ndarray) -> np.ndarray:
    """Vertical bit planes: row b holds bit b of all members, 64 members to a word."""
    packed = np.packbits(bits, axis=0)
    pad = -packed.shape[0] % 8
    packed = np.pad(packed, ((0, pad), (0, 0)))
    return np.ascontiguousarray(packed.T).view("u8")


def pairs_within(xors: np.ndarray, radius: int, block: int = 4096) -> np.ndarray:
    """For each XOR of two fingerprints, whether it has at most ``radius`` bits."""
    out = np.zeros(len(xors), dtype=bool)
    for at in range(0, len(xors), block):
        part = xors[at:at + block]
        planes, sums = _planes(_bits(part)), None
        sums = CarrySave(planes.shape[1], radius)
        for i, plane in enumerate(planes):
            sums.add(plane)
            if i % 8 == 7 and not sums.within().any():
                break
        else:
            out[at:at + block] = np.unpackbits(sums.within().view("u1"))[:len(part)]
    return out


def adjacency(fps: np.ndarray, radius: int, queries: int = 256) -> np.ndarray:
    """Packed link matrix of one block: row q, bit m set if fps q and m are within ``radius``."""
    bits = _bits(fps)
    planes = _planes(bits)
    rows = np.zeros((len(fps), planes.shape[1]), dtype="u8")
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    for at in range(0, len(fps), queries):
        own = bits[at:at + queries].astype("u8") * full
        sums, live = CarrySave((len(own), planes.shape[1]), radius), True
        for i, plane in enumerate(planes):
            if not (own[:, i] == own[0, i]).all() or plane.any() or own[0, i]:
                sums.add(plane[None, :] ^ own[:, i][:, None])
            if i % 8 == 7 and not sums.within().any():
                live = False
                break
        if live:
            rows[at:at + queries] = sums.within()
    return rows


def _block_forest(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """(smallest member, member) of every linked group of one block, by breadth-first bit sets."""
    order = np.sort(fps)
    links, n = adjacency(order, radius), len(order)
    unseen, out = np.ones(n, dtype=bool), []
    for root in range(n):
        if not unseen[root]:
            continue
        unseen[root] = False
        frontier = np.array([root])
        while len(frontier):
            reach = np.unpackbits(np.bitwise_or.reduce(links[frontier], axis=0).view("u1"))[:n].astype(bool) & unseen
            frontier = np.nonzero(reach)[0]
            unseen[frontier] = False
            out += [(int(order[root]), int(order[i])) for i in frontier]
    return out


def _small_forest(group: np.ndarray, fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Spanning links of many small groups at once (rows sorted by group)."""
    label, left, right = np.arange(len(fps)), [], []
    for step in range(1, SMALL):
        i = np.nonzero(group[:-step] == group[step:])[0] if step < len(fps) else np.empty(0, int)
        if not len(i):
            break
        hit = i[pairs_within(fps[i] ^ fps[i + step], radius)]
        left.append(hit)
        right.append(hit + step)
    if not left:
        return []
    a, b = np.concatenate(left), np.concatenate(right)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    own = np.nonzero(label != np.arange(len(fps)))[0]
    return [(int(x), int(y)) for x, y in zip(fps[label[own]], fps[own])]


def _forest(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Links of buckets arriving in order (mask, key, fp); a bucket may span two batches."""
    held: list[np.ndarray] = []

    def emit(mask, key, fp):
        start = np.r_[True, (mask[1:] != mask[:-1]) | (key[1:] != key[:-1])]
        group = np.cumsum(start) - 1
        size = np.bincount(group)
        out = _small_forest(group[(size <= SMALL)[group]], fp[(size <= SMALL)[group]], radius)
        ends = np.cumsum(size)
        for g in np.nonzero(size > SMALL)[0]:
            out += _block_forest(fp[ends[g] - size[g]:ends[g]], radius)
        a, b = zip(*out) if out else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    for batch in batches:
        cols = [np.asarray(batch.column(i)) for i in range(3)]
        held = [np.concatenate([h, c]) for h, c in zip(held, cols)] if held else cols
        if not len(held[0]):
            continue
        last = np.nonzero((held[0] != held[0][-1]) | (held[1] != held[1][-1]))[0]
        done = last[-1] + 1 if len(last) else 0
        if done:
            yield emit(*(h[:done] for h in held))
            held = [h[done:] for h in held]
    if held and len(held[0]):
        yield emit(*held)


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def refined_masks(agreed: int, radius: int) -> list[int]:
    """Masks that add to ``agreed`` every pair of radius + 2 segments of the other bits."""
    free = [b for b in range(BITS) if not agreed >> b & 1]
    parts = [free[i * len(free) // (radius + 2):(i + 1) * len(free) // (radius + 2)] for i in range(radius + 2)]
    return sorted({agreed | sum(1 << b for p in two for b in p) for two in combinations(parts, 2)})


def links(spark: SparkSession, fps: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Spanning links (a, b) between distinct fingerprints (column fp) at most ``radius`` bits apart."""
    masks, found = [0], None
    rows = fps.select(F.lit(0).cast("long").alias("mask"), "fp")
    while True:
        # next masks of each mask: a table of at most C(radius + 2, 2) ** 3 rows
        nexts = spark.createDataFrame([(_signed(m), _signed(n)) for m in masks for n in refined_masks(m, radius)], "mask long, next long")
        masks = sorted({n for m in masks for n in refined_masks(m, radius)})
        rows = (rows.join(F.broadcast(nexts), "mask").select(F.col("next").alias("mask"), "fp")
                .withColumn("key", F.col("fp").bitwiseAND(F.col("mask"))))
        sizes = rows.groupBy("mask", "key").agg(F.count("*").alias("members")).where("members > 1")
        rows = common.materialize(spark, rows.join(sizes, ["mask", "key"]).select("mask", "key", "fp", "members"))
        cold = rows.where(F.col("members") <= block).select("mask", "key", "fp").repartition("mask", "key").sortWithinPartitions("mask", "key", "fp")
        own = cold.mapInArrow(lambda it: _forest(it, radius), "a long, b long")
        found = own if found is None else found.union(own)
        rows = rows.where(F.col("members") > block).select("mask", "fp").distinct()
        if not rows.limit(1).count():
            return found


def near_duplicates(spark: SparkSession, docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Rows doc_id, fp, component_id: one per row of ``docs``."""
    common.small_batches(spark)
    marks = common.materialize(spark, fingerprints(docs))
    distinct = common.materialize(spark, marks.groupBy("fp").agg(F.min("doc_id").alias("low")))
    comps = common.components(spark, links(spark, distinct.select("fp"), radius))
    lows = comps.join(distinct, F.col("node") == F.col("fp")).select("label", "low").groupBy("label").agg(F.min("low").alias("group_low"))
    by_fp = (distinct.join(comps.join(lows, "label").select(F.col("node").alias("fp"), "group_low"), "fp", "left")
             .select("fp", F.coalesce("group_low", "low").alias("component_id")))
    # stored, so that both sides of the join are dealt anew and Spark can split a fingerprint that many documents share
    return marks.join(common.materialize(spark, by_fp), "fp").select("doc_id", "fp", "component_id")


def hex_fingerprint(col: str = "fp"):
    return F.lower(F.lpad(F.hex(F.col(col)), 16, "0"))


def keep_one(spark: SparkSession, docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest id.

    Rows that repeat an id and its text are one document; rows without an id are all kept, for
    nothing can name them.
    """
    groups = near_duplicates(spark, docs.where("doc_id is not null"), radius)
    kept, cid = groups.select("component_id").distinct(), common.fresh(docs, "component_id")
    kept = kept.withColumnRenamed("component_id", cid)
    named = docs.where("doc_id is not null").join(kept, F.col("doc_id") == F.col(cid), "left_semi").dropDuplicates(["doc_id", "text"])
    return named.unionByName(docs.where("doc_id is null"))
