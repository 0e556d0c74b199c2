"""Exact deduplication through counting quotient filters, with byte verification of what they count twice.

Every task adds the 64-bit fingerprints of its texts to counting quotient filters: a fingerprint's high
bits are its home slot (quotient), the rest is the remainder that the slot keeps; remainders of one
quotient stand in one sorted run, and counts above one follow their remainder as digits, in slots of
their own. Nothing is lost in a filter, so filters merge by merging their sorted remainders. The
filters are cut by the fingerprint's first bits, so that a merging task holds about ``SHARD_KEYS`` of all
fingerprints. Fingerprints that the merged filters count more than once are joined to the documents; only the texts of
these are grouped, by their bytes.

Defined results: a null text equals an empty one; rows that repeat an id and its text are counted as
rows, and exactly one row of every group stays, that with the largest id (null ids are smallest; of rows that
repeat the largest id any one); very long texts are whole; an empty table gives no rows; further
columns of any name are ignored.
"""
from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Fingerprints a task adds to one filter before it emits it, and expected ones a merging task holds.
CHUNK_KEYS, SHARD_KEYS = 1 << 20, 1 << 18
HEADER = struct.Struct("<QQBB")


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def _digit_counts(counts: np.ndarray, width: int) -> np.ndarray:
    """Slots that each count needs besides its remainder: digits of count - 1 in base 256 ** width."""
    extra, rest = np.zeros(len(counts), np.int64), counts - np.uint64(1)
    while rest.any():
        extra += rest > 0
        rest = rest >> np.uint64(8 * width) if width < 8 else np.zeros_like(rest)
    return extra


def pack(keys: np.ndarray, counts: np.ndarray, bits: int) -> bytes:
    """The filter of distinct ascending ``keys`` (below 2 ** bits) and their ``counts`` (1 or more).

    It is written once and merged, never inserted into, so it is packed full: at most two keys a home slot on average."""
    n = len(keys)
    q = max(1, min(bits - 1, int(np.log2(max(n, 1)))))
    width = (bits - q + 7) // 8
    home = (keys >> np.uint64(bits - q)).astype(np.int64)
    remainder = keys & np.uint64((1 << (bits - q)) - 1)
    counts = counts.astype(np.uint64)
    extra = _digit_counts(counts, width)
    # a run starts at its home slot, or right after the run before it
    first = np.r_[True, home[1:] != home[:-1]] if n else np.zeros(0, bool)
    before = np.cumsum(1 + extra) - (1 + extra)
    shift = np.maximum.accumulate(np.where(first, home - before, np.iinfo(np.int64).min)) if n else before
    slot = before + shift
    size = max(1 << q, int(slot[-1] + 1 + extra[-1]) if n else 0)
    occupied, run_end, digit = np.zeros(1 << q, bool), np.zeros(size, bool), np.zeros(size, bool)
    values = np.zeros(size, np.uint64)
    values[slot] = remainder
    left, k = counts - np.uint64(1), 1
    base = np.uint64((1 << (8 * width)) - 1) if width < 8 else np.uint64(0xFFFFFFFFFFFFFFFF)
    while (has := extra >= k).any():
        values[slot[has] + k], digit[slot[has] + k] = left[has] & base, True
        left = left >> np.uint64(8 * width) if width < 8 else np.zeros_like(left)
        k += 1
    occupied[home] = True
    last = np.r_[first[1:], True] if n else first
    run_end[(slot + extra)[last]] = True
    slots = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()
    return HEADER.pack(n, size, q, bits) + _bits(occupied) + _bits(run_end) + _bits(digit) + slots


def unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The ascending keys of a filter, and their counts."""
    n, size, q, bits = HEADER.unpack_from(blob)
    width, at = (bits - q + 7) // 8, HEADER.size

    def flags(count: int) -> np.ndarray:
        nonlocal at
        taken = np.unpackbits(np.frombuffer(blob, np.uint8, (count + 7) // 8, at), count=count).astype(bool)
        at += (count + 7) // 8
        return taken

    occupied, run_end, digit = flags(1 << q), flags(size), flags(size)
    values = np.zeros((size, 8), np.uint8)
    values[:, :width] = np.frombuffer(blob, np.uint8, size * width, at).reshape(size, width)
    values = values.view("<u8").ravel()
    homes, ends = np.flatnonzero(occupied), np.flatnonzero(run_end)
    starts = np.maximum(homes, np.r_[-1, ends[:-1]] + 1) if n else homes
    used = np.zeros(size + 1, np.int64)
    np.add.at(used, starts, 1)
    np.add.at(used, ends + 1, -1)
    used = np.cumsum(used)[:size] > 0
    slot = np.flatnonzero(used & ~digit)
    run = np.searchsorted(ends, slot)
    keys = (homes[run].astype(np.uint64) << np.uint64(bits - q)) | values[slot] if n else np.zeros(0, np.uint64)
    counts = np.ones(n, np.uint64)
    places = np.flatnonzero(digit)
    if len(places):
        owner = np.searchsorted(slot, places) - 1
        power = (places - slot[owner] - 1).astype(np.uint64) * np.uint64(8 * width)
        np.add.at(counts, owner, values[places] << np.minimum(power, np.uint64(63)))
    return keys, counts


def merge(blobs: Iterable[bytes], bits: int) -> bytes:
    """One filter of all: sorted remainders are merged, counts of equal fingerprints are added."""
    parts = [unpack(b) for b in blobs]
    keys, counts = np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts])
    order = np.argsort(keys, kind="stable")  # merges the ascending runs
    keys, counts = keys[order], counts[order]
    new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return pack(keys[new], np.add.reduceat(counts, new) if len(keys) else counts, bits)


def shard_bits(rows: int) -> int:
    return max(0, int(np.ceil(np.log2(max(rows, 1) / SHARD_KEYS))))


def build_filters(prints: DataFrame, top: int) -> DataFrame:
    """Rows (shard, filter) of the long column ``fp``: each task's filters, cut by the first ``top`` bits."""
    bits, low = 64 - top, np.uint64((1 << (64 - top)) - 1)

    def cut(keys: np.ndarray) -> pa.RecordBatch:
        keys, counts = np.unique(keys, return_counts=True)
        shard = (keys >> np.uint64(bits)).astype(np.int64) if top else np.zeros(len(keys), np.int64)
        edges = np.r_[np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]]), len(keys)]
        pieces = list(zip(edges[:-1], edges[1:]))
        return pa.RecordBatch.from_pydict({
            "shard": pa.array([shard[a] for a, _ in pieces], pa.int64()),
            "filter": pa.array([pack(keys[a:b] & low, counts[a:b], bits) for a, b in pieces], pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            size += len(held[-1])
            if size >= CHUNK_KEYS:
                yield cut(np.concatenate(held))
                held, size = [], 0
        if size:
            yield cut(np.concatenate(held))

    return prints.select("fp").mapInArrow(run, "shard long, filter binary")


def merge_filters(filters: DataFrame, top: int) -> DataFrame:
    """One filter a shard. Works on any union of ``build_filters`` and ``merge_filters`` of the same ``top``."""
    bits = 64 - top

    def run(group: pa.Table) -> pa.Table:
        return pa.table({"shard": group.column("shard").slice(0, 1),
                         "filter": pa.array([merge((b.as_py() for b in group.column("filter")), bits)], pa.binary())})

    return filters.groupBy("shard").applyInArrow(run, "shard long, filter binary")


def repeated(filters: DataFrame, top: int, least: int = 2) -> DataFrame:
    """Rows (fp, n) of the fingerprints that merged ``filters`` count at least ``least`` times."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                keys, counts = unpack(blob.as_py())
                many = counts >= least
                keys = keys[many] | np.uint64((shard << (64 - top)) if top else 0)
                yield pa.RecordBatch.from_pydict({"fp": pa.array(keys.view(np.int64)), "n": pa.array(counts[many].astype(np.int64))})

    return filters.select("shard", "filter").mapInArrow(run, "fp long, n long")


def text_groups(spark: SparkSession, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(rows, groups)``: a row (doc_id, row, fp, sha, salt) per document, and a row (fp, sha, n, keep, keep_row, salt) per
    text that several rows share (and salt), equal byte for byte.

    With p partitions, fewer than 4 p fingerprints can hold more than a 4 p-th of all rows each. Only these are
    broadcast, to deal their rows over p salts."""
    fp = F.xxhash64("text").alias("fp")
    texts = docs.select("doc_id", common.text_or_empty().alias("text"))
    total, parts = docs.count(), max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    top = shard_bits(total)
    merged = common.materialize(spark, merge_filters(build_filters(texts.select(fp), top), top))
    many = common.materialize(spark, repeated(merged, top).withColumn("hot", F.col("n") > max(1000, total // (4 * parts))))
    salts = F.explode(F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0)))).alias("salt")
    salted = texts.select("doc_id", "text", fp).join(F.broadcast(many.where("hot").select("fp", "hot")), "fp", "left")
    salted = salted.withColumn("salt", F.when(F.col("hot"), F.pmod(F.monotonically_increasing_id(), F.lit(parts))).otherwise(0).cast("int"))
    again = many.select("fp", salts, F.lit(True).alias("again"))
    probed = salted.join(again, ["fp", "salt"], "left").select(
        "doc_id", F.monotonically_increasing_id().alias("row"), "fp", "salt", "hot", F.sha2("text", 256).alias("sha"),
        F.when(F.col("again"), F.col("text")).alias("text"))
    rows = common.materialize(spark, probed)
    # partial sums leave one row a text and task, however many copies there are
    equal = rows.where("text is not null").groupBy("fp", "text").agg(
        F.count("*").alias("n"), F.max(F.struct("doc_id", "row")).alias("top"), F.first("sha").alias("sha"), F.first("hot").alias("hot"))
    groups = common.materialize(spark, equal.where("n > 1").select(
        "fp", "sha", "hot", "n", F.col("top.doc_id").alias("keep"), F.col("top.row").alias("keep_row")))
    return rows.drop("text", "hot"), groups.select("fp", "sha", "n", "keep", "keep_row", salts)


def dedup(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs`` (columns doc_id, text)."""
    rows, groups = text_groups(spark, docs)
    joined = rows.join(groups, ["fp", "sha", "salt"], "left")
    alone = F.col("n").isNull()
    return joined.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"), F.col("sha").alias("text_sha256"))


#: DuckDB SQL of the same result over ``documents``.
SQL = """
WITH rows_of AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) AS k FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size, k = 1 AS kept, sha256(t) AS text_sha256
FROM rows_of
"""
