"""Byte-level BPE: ranked merges folded by Spark's higher-order functions, and decoding by concatenation.

Text splits into units (an optional space and a run of other characters, or a run of white space);
a unit splits into the pattern's matches, and each match is folded: its bytes are an array, every
step merges the adjacent pair of the lowest rank, leftmost first, until no pair has a rank. Ranks
come from a literal map, kept as an array of small maps so that a look-up compares few keys. Byte
strings are held as text of one character per byte (Latin-1).

Only distinct units are folded. The HEAD most frequent of the corpus are folded once by these functions and
their ids travel to the executors; the units of a document that are not among these are folded
there by the same merges on numpy arrays, many units side by side, for folding every rare unit in the row took the higher-order
functions about 300 microseconds a unit, beyond the limits (figures in the README). Nothing is
shuffled but unit counts, so a document's length or a frequent word gathers nothing in one task.

Defined results: null text counts as empty (no ids, decoded to no bytes); rows with a null id and
repeated rows are encoded like any other; an empty table gives no rows; further columns are ignored.
"""
from __future__ import annotations

import base64
import hashlib
import heapq
import json
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .packing import _SPACE, _UNIT

#: Units whose ids are sent to the executors; all others are folded in their document's task.
HEAD = 1 << 17
#: Distinct units a task counts before it hands them on, or remembers when folded (memory bound only).
REMEMBER = 300_000
#: Characters of text, and byte strings, that a task folds side by side (memory bound only).
GROUP_CHARS, SIDE_BY_SIDE = 1 << 20, 1 << 12
RANK_MAPS = 1 << 13
NO_RANK = 2 ** 31 - 1


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def rank_literal(ranks: dict[bytes, int]) -> Column:
    """The ranks as a literal: array of maps, a byte string's map chosen by its hash."""
    maps: list[dict[str, int]] = [{} for _ in range(RANK_MAPS)]
    for piece, rank in ranks.items():
        key = piece.decode("latin-1")
        maps[xxhash.xxh64_intdigest(key.encode(), 42) % RANK_MAPS][key] = rank
    return F.from_json(F.lit(json.dumps(maps)), "array<map<string,int>>")


def piece_literal(ranks: dict[bytes, int]) -> Column:
    """The byte string of every id, as a literal array."""
    pieces = [""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece.decode("latin-1")
    return F.from_json(F.lit(json.dumps(pieces)), "array<string>")


def _rank(text: str) -> str:
    return f"coalesce(try_element_at(get(t, cast(pmod(xxhash64({text}), {RANK_MAPS}) as int)), {text}), {NO_RANK})"


def _bind(name: str, value: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


def _fold_sql(units: str, pattern: str) -> str:
    """SQL that turns array ``units`` into the array of their id arrays; the rank maps are bound to t."""
    none = "cast(array() as array<int>)"
    merged = "concat(a.p[j - 1], a.p[j])"
    step = _bind("m", "array_min(a.r)", f"if(m = {NO_RANK} or m is null, a, " + _bind(
        "j", "cast(array_position(a.r, m) as int)", _bind(
            "x", merged, "named_struct('p', concat(slice(a.p, 1, j - 1), array(x), slice(a.p, j + 2, size(a.p))), 'r', concat("
            f"slice(a.r, 1, greatest(j - 2, 0)), if(j > 1, array({_rank('concat(a.p[j - 2], x)')}), {none}), "
            f"if(j < size(a.r), array({_rank('concat(x, a.p[j + 1])')}), {none}), slice(a.r, j + 2, size(a.r))))")) + ")")
    first = f"named_struct('p', c, 'r', transform(sequence(0, size(c) - 2), i -> {_rank('concat(c[i], c[i + 1])')}))"
    ids = f"transform(aggregate(sequence(1, size(c) - 1), {first}, (a, k) -> {step}, a -> a.p), q -> {_rank('q')})"
    whole = _bind("g", _rank("s"), f"if(g < {NO_RANK}, array(g), {_bind('c', 'split(s, chr(0) || chr(0) || chr(0) || chr(0))', ids)})")
    whole = whole.replace("split(s, chr(0) || chr(0) || chr(0) || chr(0))", "split(s, '')")
    word = _bind("s", "decode(encode(w, 'UTF-8'), 'ISO-8859-1')", whole)
    quoted = pattern.replace("\\", "\\\\").replace("'", "\\'")
    return f"transform({units}, u -> flatten(transform(regexp_extract_all(u, '(?U){quoted}', 0), w -> {word})))"


def encoded(units: Column, ranks: dict[bytes, int], pattern: str, df: DataFrame) -> DataFrame:
    """``df`` with columns ids (arrays, one per unit of array column ``units``) and bytes (their decoded bytes)."""
    rows = df.withColumn("_units", units)
    t, ids = common.fresh(rows, "ids"), common.fresh(rows, "ids")
    rows = rows.withColumn("_t", rank_literal(ranks)).withColumn("_p", piece_literal(ranks))
    rows = rows.withColumn(ids, F.expr(f"transform(array(_t), t -> {_fold_sql('_units', pattern)})[0]"))
    rows = rows.withColumn("bytes", F.expr(
        f"transform(array(_p), p -> transform({ids}, x -> encode(array_join(transform(x, i -> get(p, i)), ''), 'ISO-8859-1')))[0]"))
    return rows.drop("_units", "_t", "_p")


def unit_counts(docs: DataFrame) -> DataFrame:
    """Rows unit, n over all documents, counted per partition before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(count):
            return pa.RecordBatch.from_arrays([pa.array(list(count), pa.string()), pa.array(list(count.values()), pa.int64())], names=["unit", "n"])
        count: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                count.update(_UNIT.findall(text))
                if len(count) > REMEMBER:
                    yield flush(count)
                    count = Counter()
        if count:
            yield flush(count)

    return docs.select(common.text_or_empty().alias("text")).mapInArrow(run, "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n"))


def _ipc(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def split_pattern(pattern: str) -> str:
    """``pattern`` with its white space spelled out as Unicode's, as the library and Java's (?U) read it."""
    return pattern.replace("[^\\s", f"[^{_SPACE}").replace("\\S", f"[^{_SPACE}]").replace("\\s", f"[{_SPACE}]")


def fold(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one match of the pattern: the lowest-ranked adjacent pair is merged, leftmost first, until none has a rank."""
    if piece in ranks:
        return [ranks[piece]]
    if len(piece) > 200:
        return _fold_long(piece, ranks)
    parts = [piece[i:i + 1] for i in range(len(piece))]
    pairs = [ranks.get(a + b, NO_RANK) for a, b in zip(parts, parts[1:])]
    while pairs:
        low = min(pairs)
        if low == NO_RANK:
            break
        j = pairs.index(low)
        parts[j:j + 2] = [parts[j] + parts[j + 1]]
        del pairs[j]
        if j:
            pairs[j - 1] = ranks.get(parts[j - 1] + parts[j], NO_RANK)
        if j < len(pairs):
            pairs[j] = ranks.get(parts[j] + parts[j + 1], NO_RANK)
    return [ranks[p] for p in parts]


def _fold_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges in n log n steps: a heap of pairs over a linked list of parts."""
    end, n = [i + 1 for i in range(len(piece))], len(piece)  # a part that starts at i ends at end[i]; 0: merged away
    before = [i - 1 for i in range(n + 1)]
    heap = []

    def offer(i: int) -> None:
        if 0 <= i and end[i] < n:
            rank = ranks.get(piece[i:end[end[i]]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, end[i], end[end[i]]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, mid, stop = heapq.heappop(heap)
        if end[i] != mid or mid >= n or end[mid] != stop:
            continue  # a part of this pair has been merged meanwhile
        end[i], end[mid] = stop, 0
        before[stop] = i
        offer(i)
        offer(before[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return out


class PairTable:
    """Which two ids may merge, and into what: for every byte string with a rank, all its cuts into two that have ranks."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        pairs = [(ranks[p[:i]], ranks[p[i:]], r) for p, r in ranks.items() for i in range(1, len(p)) if p[:i] in ranks and p[i:] in ranks]
        left, right, into = np.array(pairs, np.int64).reshape(-1, 3).T
        keys = left << 32 | right
        order = np.argsort(keys)
        self.keys, self.into = np.r_[keys[order], np.iinfo(np.int64).max], np.r_[into[order], NO_RANK].astype(np.int32)
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.keys, keys)
        return np.where(self.keys[at] == keys, self.into[at], NO_RANK)


def fold_many(pieces: list[bytes], table: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """``fold`` of many byte strings of 2 to 64 bytes side by side, as all ids and how many each has: each step merges the
    lowest-ranked pair of every one that still has one.

    Row r of the arrays is a piece; a part keeps the place of its first byte, and ``nxt`` and ``prv`` lead from part to part."""
    n = np.array([len(p) for p in pieces])
    width, rows = int(n.max()) + 1, len(pieces)
    inside = np.arange(width) < n[:, None]
    ids = np.zeros((rows, width), np.int32)
    ids[inside] = table.of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
    nxt, prv = np.tile(np.arange(1, width + 1), (rows, 1)), np.tile(np.arange(-1, width - 1), (rows, 1))
    pairs = np.full((rows, width), NO_RANK, np.int32)
    joint = inside[:, :-1] & inside[:, 1:]
    pairs[:, :-1][joint] = table.rank(ids[:, :-1][joint], ids[:, 1:][joint])
    active = np.arange(rows)
    while len(active):
        low = pairs[active].argmin(axis=1)  # the leftmost of the lowest
        best = pairs[active, low]
        active, low, best = active[best < NO_RANK], low[best < NO_RANK], best[best < NO_RANK]
        gone = nxt[active, low]
        after, before = nxt[active, gone], prv[active, low]
        ids[active, low], inside[active, gone] = best, False
        pairs[active, gone], nxt[active, low] = NO_RANK, after
        more = after < n[active]
        prv[active[more], after[more]] = low[more]
        pairs[active, low] = NO_RANK
        pairs[active[more], low[more]] = table.rank(best[more], ids[active[more], after[more]])
        left = before >= 0
        pairs[active[left], before[left]] = table.rank(ids[active[left], before[left]], best[left])
    return ids[inside], inside.sum(axis=1)


class UnitCoder:
    """A worker's units: ids (little-endian unsigned 32-bit) from the head, or folded when first met."""

    def __init__(self, head: pa.Table, ranks: dict[bytes, int], pattern: str) -> None:
        import regex
        units, ids = ([x for c in col.chunks for x in c.to_pylist()] for col in head.columns[:2])
        self.ids = {u: np.array(i.split(",") if i else [], "<u4").tobytes() for u, i in zip(units, ids)}
        self._room, self._head = len(self.ids) + REMEMBER, units
        self._ranks, self._table = ranks, PairTable(ranks)
        pieces = [b""] * (max(ranks.values()) + 1)
        for piece, i in ranks.items():
            pieces[i] = piece
        self._pieces = pa.array(pieces, pa.large_binary())
        self._numbers = pa.array([b"%d," % i for i in range(len(pieces))], pa.large_binary())
        self._match = regex.compile(split_pattern(pattern)).findall

    def learn(self, units: Iterable[str]) -> None:
        """Fold new units match by match. A match is a unit too (`` word`` of `` word,``), so what is known of it is used."""
        split = {unit: self._match(unit) for unit in units}
        new = {m: m.encode() for matches in split.values() for m in matches if m not in self.ids}
        short: dict[int, list[str]] = {}
        for match, piece in new.items():
            if piece in self._ranks or len(piece) > 64:
                self.ids[match] = np.array(fold(piece, self._ranks), "<u4").tobytes()
            else:
                short.setdefault(len(piece) // 8, []).append(match)  # alike in length, so that little is padding
        for group in short.values():
            for i in range(0, len(group), SIDE_BY_SIDE):
                part = group[i:i + SIDE_BY_SIDE]
                ids, sizes = fold_many([new[m] for m in part], self._table)
                raw, ends = ids.astype("<u4").tobytes(), (4 * np.cumsum(sizes)).tolist()
                self.ids.update((m, raw[a:b]) for m, a, b in zip(part, [0, *ends], ends))
        for unit, matches in split.items():
            if len(matches) != 1:
                self.ids[unit] = b"".join([self.ids[m] for m in matches])

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, memoryview, memoryview]]:
        """Of each text its ids, the ids as decimals joined by commas, and the bytes they decode to."""
        if len(self.ids) > self._room:
            self.ids = {u: self.ids[u] for u in self._head}
        split = [_UNIT.findall(text) for text in texts]
        got = [list(map(self.ids.get, units)) for units in split]
        missing = {u for units, ids in zip(split, got) if None in ids for u, x in zip(units, ids) if x is None}
        if missing:
            self.learn(missing)
        lines = [b"".join(map(self.ids.__getitem__, units) if None in ids else ids) for units, ids in zip(split, got)]
        ids = np.frombuffer(b"".join(lines), "<u4")
        ends = np.cumsum([len(x) // 4 for x in lines])
        # taken side by side, the binary pieces of consecutive ids lie one after another in one buffer
        (text, text_at), (back, back_at) = (_joined(table.take(pa.array(ids))) for table in (self._numbers, self._pieces))
        for a, b in zip([0, *ends[:-1].tolist()], ends.tolist()):
            yield ids[a:b], text[text_at[a]:max(text_at[a], text_at[b] - 1)], back[back_at[a]:back_at[b]]


def _joined(pieces: pa.LargeBinaryArray) -> tuple[memoryview, np.ndarray]:
    """The concatenated pieces, and where each begins and the last ends."""
    _, offsets, data = pieces.buffers()
    return memoryview(data) if data is not None else memoryview(b""), np.frombuffer(offsets, np.int64, len(pieces) + 1) if len(pieces) else np.zeros(1, np.int64)


def _groups(texts: list[str]) -> Iterator[list[str]]:
    """Texts in order, some at a time: about ``GROUP_CHARS`` characters, and a longer one alone."""
    group, size = [], 0
    for text in texts:
        if group and size + len(text) > GROUP_CHARS:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        yield group


_CODERS: dict[str, UnitCoder] = {}


def encode_documents(spark: SparkSession, docs: DataFrame, ranks: dict[bytes, int], pattern: str, head: int = HEAD, with_ids: bool = False) -> DataFrame:
    """Rows doc_id, n_tokens, ids_sha256, decoded_sha256[, ids, decoded]: every row's whole text encoded and decoded again."""
    common.small_batches(spark)
    top = unit_counts(docs).orderBy(F.desc("n"), "unit").limit(head).select("unit")
    top = common.materialize(spark, top).repartition(max(1, spark.sparkContext.defaultParallelism * 4))
    known = encoded(F.array("unit"), ranks, pattern, top).select("unit", F.array_join(F.col("ids")[0], ",").alias("ids"), F.col("bytes")[0].alias("bytes"))
    # at most ``head`` rows, as Arrow bytes: neither the driver nor a broadcast holds an object per unit
    sent, name = spark.sparkContext.broadcast((_ipc(known.toArrow()), ranks)), uuid.uuid4().hex
    src = docs.select("doc_id", common.text_or_empty().alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _CODERS:  # built once per worker and query
            _CODERS.clear()
            _CODERS[name] = UnitCoder(pa.ipc.open_stream(sent.value[0]).read_all(), sent.value[1], pattern)
        coder = _CODERS[name]
        for b in batches:
            cols: list[list] = [[], [], [], [], []]
            for ids, line, back in (found for group in _groups(b.column(1).to_pylist()) for found in coder.encode(group)):
                cols[0].append(len(ids))
                cols[1].append(hashlib.sha256(line).hexdigest())
                cols[2].append(hashlib.sha256(back).hexdigest())
                if with_ids:
                    cols[3].append(ids.astype(np.int32))
                    cols[4].append(bytes(back))
            arrays = [b.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string())]
            if with_ids:
                arrays += [pa.array(cols[3], pa.list_(pa.int32())), pa.array(cols[4], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"][:len(arrays)])

    return src.mapInArrow(assemble, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded binary" if with_ids else ""))
