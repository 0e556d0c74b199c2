"""Best-fit packing: best-fit decreasing with a segment tree over remaining capacities.

Documents become token pieces of at most ``capacity`` tokens; the pieces are packed into as few
sequences as best-fit decreasing finds. Best-fit decreasing only looks at lengths, so the whole
corpus is described by a histogram of at most ``capacity`` lengths. The driver runs the exact
algorithm on that bounded histogram: a segment tree over the remaining capacities finds the
tightest open sequences in O(log capacity), and all equal pieces that go to equal sequences
are placed in one step (a "run"). Spark numbers the pieces of each length and every piece reads
its place off the runs, so nothing but counts ever reaches the driver.

Defined results: null text counts as empty (one piece holding the end token); repeated rows are
packed as often as they occur; a null id is an id like any other; an empty table gives no rows;
further columns of the input, whatever their names, are ignored.
"""
from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

CAPACITY = 2048
END_ID = 0
#: Entries of each of the two halves of one worker's cache of encoded words: a full one replaces the older (memory bound only).
CACHE_WORDS = 500_000
#: Bytes of text in one block of the encoder, or one longer text (memory bound only).
BLOCK_BYTES = 1 << 22
#: Pieces of one length are numbered in so many independent parts, or in more, that a part holds about PART_PIECES pieces of all
#: lengths: a length shared by most pieces is not numbered by a few tasks.
NUMBERING_PARTS, PART_PIECES = 64, 1 << 18

# Unicode white space: where the byte-level pre-tokenizer may split.
_SPACE = "\\t-\\r\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_SPACES = frozenset("\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
_UNIT = re.compile(f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")


# Classes of bytes, and the pairs of them with a sure split in between (see unit_starts).
_OTHER, _LETTER, _DIGIT, _MARK, _QUOTE, _BLANK, _WHITE = range(7)


def _classes() -> np.ndarray:
    cls = np.full(256, _OTHER, "u1")
    for b in range(33, 127):
        cls[b] = _LETTER if chr(b).isalpha() else _DIGIT if chr(b).isdigit() else _MARK
    cls[ord("'")] = _QUOTE
    cls[9:14], cls[32] = _WHITE, _BLANK
    return cls


def _splits(fine: bool) -> np.ndarray:
    at = np.zeros((8, 8), bool)
    at[:_BLANK, _BLANK:] = True  # white space after other characters
    at[_WHITE, _LETTER:_BLANK] = True
    if fine:
        at[[_LETTER, _DIGIT], _MARK] = at[[_LETTER, _DIGIT], _QUOTE] = at[_MARK, [_LETTER, _DIGIT]] = True
    return at.ravel()


_CLASS, _SPLIT = _classes(), {fine: _splits(fine) for fine in (False, True)}
_WIDE_SPACE = np.array(sorted(int.from_bytes(c.encode()) for c in _SPACES if ord(c) > 127))


def unit_starts(data: np.ndarray, ends: np.ndarray, fine: bool) -> np.ndarray:
    """Where units start in the UTF-8 bytes ``data`` of texts between ``ends``: a flag for each byte, and one more for the end.

    A unit starts where the pre-tokenizer splits whatever stands around: at white space after another character, and on both
    sides of white space that is no blank and ends its run; if ``fine``, also between letters or digits and signs, but for an
    apostrophe before them ('s is one). Characters beyond ASCII that are no letters of Latin-1 may be of any class: only white
    space is parted from them.
    """
    starts, cls = np.zeros(len(data) + 1, bool), _CLASS[data]
    wide = bool(len(data)) and int(data.max()) > 127
    if wide:
        latin = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7))
        cls[latin] = cls[latin + 1] = _LETTER
    starts[1:-1] = _SPLIT[fine][cls[:-1] * 8 + cls[1:]]
    if wide:  # no split between white space beyond ASCII and what follows it
        at = np.flatnonzero(starts[1:-1] & (data[:-1] > 127) & (cls[:-1] == _OTHER)) + 1
        two = data[at - 2].astype("i8") << 8 | data[at - 1]
        three = data[np.maximum(at - 3, 0)].astype("i8") << 16 | two
        starts[at[np.isin(two, _WIDE_SPACE) | np.isin(three, _WIDE_SPACE)]] = False
    last = starts[1:-1] & (cls[:-1] == _WHITE) & (cls[1:] < _BLANK)
    last[ends[(ends > 0) & (ends < len(data))] - 1] = False  # what follows is another text
    starts[:-2][last] = True
    starts[ends] = True
    return starts


class WordCachingEncoder:
    """Ids of whole texts, encoding each distinct unit once.

    Units are cut where the pre-tokenizer always splits (``unit_starts``), so the ids of a text are the joined ids of its
    units. Units are found, told apart and joined for a block of texts at once, on arrays; only distinct units of a block are
    looked up. Ids come as little-endian unsigned 32-bit bytes.
    """

    def __init__(self, tokenizer_file: str, special: bool = False) -> None:
        """``special``: the string of a special token in a text becomes its id, as in Tokenizer.encode; else it is ordinary text."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self._tok = Tokenizer.from_file(tokenizer_file)
        self._tok.encode_special_tokens = True  # units hold none, or are ordinary text
        self._plain = Tokenizer.from_file(tokenizer_file) if special else None
        self._special = [t.content for t in self._tok.get_added_tokens_decoder().values() if t.special] if special else []
        self._cache: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        vocab = self._tok.get_vocab()
        self._bytes = np.zeros(max(vocab.values()) + 1, dtype="i8")
        for token, no in vocab.items():
            self._bytes[no] = len(token)  # a byte-level token has one character per byte
        split = self._tok.pre_tokenizer
        #: Signs are parted from words by the library's own byte-level pattern; other patterns may join them.
        self._fine = isinstance(split, pre_tokenizers.ByteLevel) and split.use_regex and not split.add_prefix_space and self._tok.normalizer is None

    def _learn(self, units: list[str]) -> None:
        """Cache the ids of new units. Those that end without white space are encoded as one text, for the pre-tokenizer splits
        before white space that starts the next, or on both sides of a line feed put before it, and byte-level tokens show
        where a unit ends."""
        joined = [u for u in units if u[-1] not in _SPACES and (u[0] in _SPACES if self._fine else u[0] == " ")]
        fed = [u for u in units if u[-1] not in _SPACES and u[0] not in _SPACES] if self._fine else []
        for feed, group in (("", joined), ("\n", fed)):
            for i in range(0, len(group), 5000):
                part = group[i:i + 5000]
                ids = np.array(self._tok.encode_batch_fast([feed + feed.join(part)], add_special_tokens=False)[0].ids, dtype="<u4")
                long = np.array([len(u.encode()) for u in part])
                ends = np.cumsum(long + len(feed))
                after = np.concatenate(([0], np.cumsum(self._bytes[ids])))
                cuts = (4 * np.searchsorted(after, ends)).tolist()
                raw = ids.tobytes()
                for unit, start, end in zip(part, (4 * np.searchsorted(after, ends - long)).tolist(), cuts):
                    self._cache[unit] = raw[start:end]
        done = {*joined, *fed}
        rest = [u for u in units if u not in done]
        for unit, enc in zip(rest, self._tok.encode_batch_fast(rest, add_special_tokens=False)):
            self._cache[unit] = np.array(enc.ids, dtype="<u4").tobytes()

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """The ids of each text; ``texts``: a list, or an Arrow array of strings without nulls."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        found = np.zeros(len(texts), bool)
        for x in self._special:
            found |= pc.match_substring(texts, x).to_numpy(zero_copy_only=False)
        out = self._encode_units(pc.if_else(pa.array(found), pa.scalar("", texts.type), texts) if found.any() else texts)
        for i in np.flatnonzero(found).tolist():
            out[i] = np.array(self._plain.encode(texts[i].as_py(), add_special_tokens=False).ids, dtype="<u4").tobytes()
        return out

    def _encode_units(self, texts: pa.Array) -> list[bytes]:
        kind = np.dtype("i8" if pa.types.is_large_string(texts.type) else "i4")
        out: list[bytes] = []
        if not len(texts):
            return out
        _, offsets, data = texts.buffers()
        ends = np.frombuffer(offsets, kind, len(texts) + 1, texts.offset * kind.itemsize).astype("i8")
        chars = np.frombuffer(data, "u1") if data is not None and data.size else np.zeros(0, "u1")
        while len(out) < len(texts):
            row = len(out)
            stop = max(row + 1, int(np.searchsorted(ends, ends[row] + BLOCK_BYTES, side="right")) - 1)
            out += self._encode_block(chars[ends[row]:ends[stop]], ends[row:stop + 1] - ends[row])
        return out

    def _encode_block(self, data: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """Ids of the texts between ``ends`` of the UTF-8 bytes ``data``."""
        if not len(data):
            return [b""] * (len(ends) - 1)
        starts = np.flatnonzero(unit_starts(data, ends, self._fine))
        units = pa.LargeStringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts), pa.py_buffer(data)).dictionary_encode()
        held = self._ids_of(units.dictionary.to_numpy(zero_copy_only=False).tolist())
        sizes = np.fromiter(map(len, held), "i8", len(held)) // 4
        which = units.indices.to_numpy()
        long = sizes[which]
        after = np.concatenate(([0], np.cumsum(long)))
        takes = np.repeat((np.cumsum(sizes) - sizes)[which] - after[:-1], long) + np.arange(after[-1])
        raw = np.frombuffer(b"".join(held), "<u4")[takes].tobytes()
        cuts = (4 * after[np.searchsorted(starts, ends)]).tolist()
        return [raw[a:b] for a, b in zip(cuts, cuts[1:])]

    def _ids_of(self, units: list[str]) -> list[bytes]:
        """Ids of distinct units, from the cache or learnt."""
        if len(self._cache) > CACHE_WORDS:
            self._older, self._cache = self._cache, {}
        cache, older, learn = self._cache, self._older, []
        held = list(map(cache.get, units))
        absent = [i for i, ids in enumerate(held) if ids is None]
        for i in absent:
            ids = older.get(units[i])
            if ids is None:
                learn.append(units[i])
            else:
                cache[units[i]] = ids  # words met again outlive the older half
        if learn:
            self._learn(learn)
        for i in absent:
            held[i] = cache[units[i]]
        return held


@lru_cache(maxsize=2)
def encoder(tokenizer_file: str) -> WordCachingEncoder:
    """The worker process's own encoder: its cache outlives a task, for Spark reuses workers."""
    return WordCachingEncoder(tokenizer_file, special=True)


def cut(total: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``total`` tokens; only the first may be shorter."""
    first = total % capacity or min(total, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, total, capacity)] if total else []


def token_pieces(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, end_id: int = END_ID,
                 id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Rows (id, piece, start, length, ids_crc32[, ids]): every document's ids, an end id, cut to pieces."""
    src = docs.select(F.col(id_col), common.text_or_empty(text_col).alias("text"))
    id_type = src.schema[id_col].dataType
    fields = [T.StructField(id_col, id_type), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
              T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.LongType())))
    schema = T.StructType(fields)
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_file)
        for batch in batches:
            take, cols = [], [[], [], [], []]
            ids: list = []
            for row, raw in enumerate(enc.encode(batch.column(1))):
                raw += end
                for no, (start, length) in enumerate(cut(len(raw) // 4, capacity)):
                    part = raw[4 * start:4 * (start + length)]
                    take.append(row)
                    for c, v in zip(cols, (no, start, length, zlib.crc32(part))):
                        c.append(v)
                    if with_ids:
                        ids.append(np.frombuffer(part, dtype="<u4").astype("i8"))
            arrays = [batch.column(0).take(pa.array(take, pa.int32())), pa.array(cols[0], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[1:])]
            if with_ids:
                arrays.append(pa.array(ids, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in fields])

    return src.mapInArrow(run, schema)


class TightestFit:
    """Segment tree over remaining capacities 0..capacity; a leaf is set while open sequences have it."""

    def __init__(self, capacity: int) -> None:
        self._size = 1 << (capacity + 1).bit_length()
        self._set = bytearray(2 * self._size)

    def put(self, at: int, present: bool) -> None:
        i = at + self._size
        self._set[i] = present
        while i > 1:
            i //= 2
            self._set[i] = self._set[2 * i] or self._set[2 * i + 1]

    def at_least(self, need: int) -> int | None:
        """The smallest set capacity that is ``need`` or more."""
        i = need + self._size
        if not self._set[i]:
            while i > 1 and not (i % 2 == 0 and self._set[i + 1]):
                i //= 2
            if i <= 1:
                return None
            i += 1
        while i < self._size:
            i = 2 * i if self._set[2 * i] else 2 * i + 1
        return i - self._size


def plan_runs(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Best-fit decreasing over {length: pieces}: the runs (length, first, sequence, per, offset) and the
    number of sequences. Piece number r of a length, in the run with the largest ``first`` <= r, goes to
    sequence + (r - first) // per at offset + (r - first) % per * length."""
    tree, open_at, runs, used = TightestFit(capacity), {}, [], 0
    for length in sorted((n for n in histogram if n > 0), reverse=True):
        if length > capacity:
            raise ValueError("a piece is longer than a sequence")
        first, left = 0, histogram[length]

        def fill(seq: int, bins: int, room: int, per: int) -> None:
            nonlocal first, left
            runs.append((length, first, seq, per, capacity - room))
            first += bins * per
            left -= bins * per
            rest = room - per * length
            if rest:
                open_at.setdefault(rest, []).append((seq, bins))
                tree.put(rest, True)

        while left:
            room = tree.at_least(length)
            if room is None:
                per = min(capacity // length, left)
                bins = left // per
                fill(used, bins, capacity, per)
                used += bins
                continue
            seq, bins = open_at[room].pop()
            per = min(room // length, left)
            take = min(bins, left // per)
            if take < bins:
                open_at[room].append((seq + take, bins - take))
            if not open_at[room]:
                tree.put(room, False)
            fill(seq, take, room, per)
    return runs, used


def place(spark: SparkSession, pieces: DataFrame, capacity: int = CAPACITY, length_col: str = "length",
         order_by: tuple[str, ...] = ()) -> DataFrame:
    """``pieces`` with sequence_id and offset. ``pieces`` must be a stored table (it is read twice);
    ``order_by`` (default: all columns) numbers equal lengths, ties are alike in every column."""
    order = list(order_by) or pieces.columns
    counts = {int(r[0]): int(r[1]) for r in pieces.groupBy(length_col).count().collect()}  # at most ``capacity`` rows
    runs, _ = plan_runs(counts, capacity)
    part, before, rank, spot = (common.fresh(pieces, c) for c in ("part", "before", "rank", "place"))
    parts = max(NUMBERING_PARTS, sum(counts.values()) // PART_PIECES)
    parted = pieces.withColumn(part, F.pmod(F.xxhash64(*order), F.lit(parts)))
    from pyspark.sql import Window as W
    offsets = parted.groupBy(length_col, part).agg(F.count("*").alias(before)).withColumn(
        before, F.sum(before).over(W.partitionBy(length_col).orderBy(part).rowsBetween(W.unboundedPreceding, -1)))
    numbered = parted.withColumn(rank, F.row_number().over(W.partitionBy(length_col, part).orderBy(*order)) - 1)
    table: dict[int, np.ndarray] = {}
    for run in runs:
        table.setdefault(run[0], []).append(run[1:])
    table = {k: np.asarray(v, dtype="i8") for k, v in table.items()}

    @F.pandas_udf("sequence_id long, offset long")
    def placed(lengths, ranks):
        import pandas as pd
        n, r = lengths.to_numpy("i8"), ranks.to_numpy("i8")
        seq, off = np.empty(len(n), "i8"), np.empty(len(n), "i8")
        for length in np.unique(n):
            m = n == length
            t = table[int(length)]
            hit = t[np.searchsorted(t[:, 0], r[m], side="right") - 1]
            j = r[m] - hit[:, 0]
            seq[m], off[m] = hit[:, 1] + j // hit[:, 2], hit[:, 3] + j % hit[:, 2] * length
        return pd.DataFrame({"sequence_id": seq, "offset": off})

    return (numbered.join(offsets, [length_col, part])
            .withColumn(spot, placed(F.col(length_col), F.col(rank) + F.coalesce(F.col(before), F.lit(0))))
            .select(*[F.col(c) for c in pieces.columns], F.col(spot)["sequence_id"].alias("sequence_id"), F.col(spot)["offset"].alias("offset")))


def pack_documents(spark: SparkSession, docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY,
                   end_id: int = END_ID) -> DataFrame:
    """Placement of every piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    common.small_batches(spark)
    pieces = common.materialize(spark, token_pieces(docs, tokenizer_file, capacity, end_id))
    return place(spark, pieces, capacity, order_by=("doc_id", "piece", "ids_crc32"))


def sequences(docs: DataFrame, placement: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (array), by joining a placement to the ids again."""
    ids = token_pieces(docs, tokenizer_file, capacity, end_id, with_ids=True).select("doc_id", "piece", "ids_crc32", "ids").dropDuplicates(["doc_id", "piece", "ids_crc32"])
    on = [placement[c].eqNullSafe(ids[c]) for c in ("doc_id", "piece", "ids_crc32")]
    rows = placement.join(ids, on).select("sequence_id", F.struct("offset", "ids").alias("part"))
    return rows.groupBy("sequence_id").agg(F.sort_array(F.collect_list("part")).alias("parts")).select(
        "sequence_id", F.flatten(F.col("parts.ids")).alias("ids"))
