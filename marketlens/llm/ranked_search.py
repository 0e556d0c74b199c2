"""Ranked lexical search by best positions: the exact top k documents of each query, from impact lists read only as far as needed.

One pass over the documents counts the queries' terms in every text. Documents are dealt over shards; a
shard keeps, per term, the list of its documents by descending impact, and per document all its impacts with their
places in those lists (direct access). A query reads the lists of its terms from the top, in step. Every document met is
scored at once by direct access, which also marks its place in the other lists as seen. A list's best position is
the end of its seen prefix, often far below what was read; no document unseen so far can score more than the sum of
the impacts that follow the best positions. Reading stops when that sum is strictly below the k-th score, so equal
scores are never lost. A first wave of shards yields k-th scores of its own, lower bounds of the final ones, from which
all other shards start.

Queries are taken in blocks of at most ``BLOCK_ITEMS`` and ``BLOCK_BYTES`` of text (a longer one is a block of
its own), each against all documents: this bounds the driver, the vocabulary sent to tasks and the term weights.

Defined results: a null or empty text has no term, a document without one counts nowhere, a query without one has no row; very
long texts are counted whole, piece by piece; equal scores ascend by id, null ids first; rows that repeat an id
are documents of their own, repeated queries are answered each; an empty table on either side gives no
rows; further columns of any name are ignored.
"""
from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

BLOCK_ITEMS, BLOCK_BYTES = 4096, 16 << 20
#: Postings a shard holds, expected; of so many shards one belongs to the first wave; rows read from each list in the first step.
SHARD_POSTINGS, WAVE, STEP = 1 << 17, 8, 64
#: Bytes of a text split at a time.
PIECE = 1 << 20

_LETTERS = b"0123456789abcdefghijklmnopqrstuvwxyz"
_TABLE = bytes(c if c >= 0x80 or c in _LETTERS else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))


def terms_of(text: bytes | None) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text in order, some at a time: ASCII letters and digits, lower-cased, and all non-ASCII characters."""
    data, at = (text or b"").translate(_TABLE), 0
    while at < len(data):
        end = data.find(b" ", at + PIECE) if len(data) - at > PIECE else -1
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def count_terms(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Rows (doc_id, n, terms, tfs) of the documents that have a term: number of all terms, and counts of those in ``vocabulary``."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value.get
        for batch in batches:
            picked, ns, terms, tfs, ends = [], [], [], [], [0]
            for i, text in enumerate(batch.column(1)):
                n, found = 0, Counter()
                for words in terms_of(text.as_py()):
                    n += len(words)
                    found.update(map(known, words))
                if n:
                    found.pop(None, None)
                    picked.append(i)
                    ns.append(n)
                    terms.extend(found.keys())
                    tfs.extend(found.values())
                    ends.append(len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int64())) for x in (terms, tfs)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(picked, pa.int64())), pa.array(ns, pa.int64()), *lists],
                                             names=["doc_id", "n", "terms", "tfs"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, terms array<long>, tfs array<long>")


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Shard:
    """Impact lists of some documents, and the direct access to them.

    ``lengths`` are all terms of each document, ``ends`` cut ``terms`` and ``tfs`` into documents; ``weights`` is by term."""

    def __init__(self, lengths: np.ndarray, ends: np.ndarray, terms: np.ndarray, tfs: np.ndarray, weights: np.ndarray, n_docs: int, n_terms: int):
        m = np.array([50 + 50 * n * n_docs // n_terms for n in lengths.tolist()], np.int64)
        doc = np.repeat(np.arange(len(lengths)), np.diff(ends))
        impact = weights[terms] * ((1000000000 * tfs) // (1000 * tfs + 20 * m[doc]))
        keep = impact > 0
        self.term, doc, self.impact = terms[keep], doc[keep], impact[keep]
        self.doc_start = np.r_[0, np.cumsum(np.bincount(doc, minlength=len(lengths)))]
        order = np.lexsort((-self.impact, self.term))
        self.list_doc, self.list_impact = doc[order], self.impact[order]
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.arange(len(order))
        self.list_start = np.r_[0, np.cumsum(np.bincount(self.term, minlength=len(weights)))]
        self.seen = np.zeros(len(order) + 1, bool)  # one more, never seen, ends the last list
        self.met = np.zeros(len(lengths), bool)
        self.asked = np.zeros(len(weights), bool)

    def _direct(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores of ``docs`` (each in some list of the query), and their places in the query's lists."""
        first, size = self.doc_start[docs], self.doc_start[docs + 1] - self.doc_start[docs]
        at = np.arange(size.sum()) + np.repeat(first - (np.cumsum(size) - size), size)
        wanted = self.asked[self.term[at]]
        sums = np.add.reduceat(np.where(wanted, self.impact[at], 0), np.cumsum(size) - size)
        return sums, self.place[at[wanted]]

    def top(self, query: np.ndarray, ids: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of the best ``k``; ``ids`` orders equal scores. Documents that score below ``floor`` may miss."""
        lists = query[self.list_start[query + 1] > self.list_start[query]]
        start, end = self.list_start[lists], self.list_start[lists + 1]
        best, self.asked[lists] = start.copy(), True
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        touched, read, step = [], 0, STEP
        while len(lists):
            fresh = np.concatenate([self.list_doc[a + read:min(a + read + step, b)] for a, b in zip(start, end) if a + read < b] or [docs[:0]])
            fresh = np.unique(fresh[~self.met[fresh]])
            read, step = read + step, step * 2
            if len(fresh):
                self.met[fresh] = True
                sums, places = self._direct(fresh)
                self.seen[places] = True
                touched.append((fresh, places))
                docs, scores = np.r_[docs, fresh], np.r_[scores, sums]
                order = np.lexsort((ids[docs], -scores))[:k]
                docs, scores = docs[order], scores[order]
            bound = 0
            for i, (a, b) in enumerate(zip(best, end)):
                while a < b and self.seen[a]:  # to the end of the seen prefix
                    ahead = self.seen[a:min(a + step, b)]
                    a += len(ahead) if ahead.all() else int(np.argmin(ahead))
                best[i] = a
                bound += int(self.list_impact[a]) if a < b else 0
            if bound == 0 or bound < max(floor, int(scores[-1]) if len(scores) == k else 0):
                break
        for fresh, places in touched:
            self.met[fresh] = False
            self.seen[places] = False
        self.asked[lists] = False
        return docs, scores


def _search(counts: DataFrame, queries: list[np.ndarray], weights: np.ndarray, n_docs: int, n_terms: int, k: int, floors: list[int]) -> DataFrame:
    """Every shard's best (query, doc_id, score) of each query."""
    shared = counts.sparkSession.sparkContext.broadcast((queries, weights, floors))

    def run(group: pa.Table) -> pa.Table:
        queries, weights, floors = shared.value
        group = group.combine_chunks()
        ids, n = group.column("doc_id").combine_chunks(), group.column("n").to_numpy()
        lists = [group.column(c).combine_chunks() for c in ("terms", "tfs")]
        ends = np.r_[0, np.cumsum(lists[0].value_lengths().to_numpy(zero_copy_only=False))]
        shard = Shard(n, ends, *[x.flatten().to_numpy(zero_copy_only=False) for x in lists], weights, n_docs, n_terms)
        order = np.empty(len(n), np.int64)
        order[pc.array_sort_indices(ids, null_placement="at_start").to_numpy()] = np.arange(len(n))
        out = [[], [], []]
        for q, (query, floor) in enumerate(zip(queries, floors)):
            docs, scores = shard.top(query, order, k, floor)
            good = (scores > 0) & (scores >= floor)
            out[0].append(np.full(good.sum(), q, np.int64))
            out[1].append(docs[good])
            out[2].append(scores[good])
        q, d, s = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out]
        return pa.table({"query": q, "doc_id": ids.take(pa.array(d)), "score": s})

    return counts.groupBy("shard").applyInArrow(run, "query long, doc_id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _blocks(items: DataFrame) -> Iterator[list[tuple]]:
    block, size = [], 0
    for row in items.select("item_id", F.col("text").cast("binary").alias("text")).toLocalIterator():
        length = len(row["text"] or b"")
        if block and (len(block) >= BLOCK_ITEMS or size + length > BLOCK_BYTES):
            yield block
            block, size = [], 0
        block.append((row["item_id"], sorted({bytes(w) for words in terms_of(row["text"] and bytes(row["text"])) for w in words})))
        size += length
    if block:
        yield block


def _block(spark: SparkSession, docs: DataFrame, block: list[tuple], k: int) -> DataFrame:
    vocabulary = {w: i for i, w in enumerate(dict.fromkeys(w for _, words in block for w in words))}
    counts = common.materialize(spark, count_terms(docs, vocabulary).withColumn("row", F.monotonically_increasing_id()))
    n_docs, n_terms, postings = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()
    weights = np.zeros(len(vocabulary) + 1, np.int64)
    for term, df in counts.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
        weights[term] = weight(n_docs, df)
    shards = max(1, -(-postings // SHARD_POSTINGS))
    dealt = counts.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards))).drop("row")
    queries = [np.array([vocabulary[w] for w in words], np.int64) for _, words in block]
    search = lambda rows, floors: _search(rows, queries, weights, n_docs, max(n_terms, 1), k, floors)
    first = common.materialize(spark, _best(search(dealt.where(F.col("shard") % WAVE == 0), [1] * len(block)), k))
    floors = {q: s for q, s in first.where(F.col("rank") == k).select("query", "score").toLocalIterator()}
    rest = search(dealt.where(F.col("shard") % WAVE != 0), [floors.get(q, 1) for q in range(len(block))])
    best = _best(first.drop("rank").union(rest), k)
    names = spark.createDataFrame([(q, item) for q, (item, _) in enumerate(block)], "query long, item_id long")
    return best.join(names, "query").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(spark: SparkSession, docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents (doc_id, text) of every query (item_id, text)."""
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in _blocks(items):
        out = out.union(common.materialize(spark, _block(spark, docs, block, k)))
    return out


#: DuckDB SQL of the same result over ``documents`` and ``benchmark``.
SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS l FROM documents
), q AS (
  SELECT DISTINCT r, item_id, unnest(l) AS t FROM (SELECT row_number() OVER () AS r, item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS l FROM benchmark)
), c AS (
  SELECT count(*) AS n_docs, CAST(sum(len(l)) AS BIGINT) AS n_terms FROM d WHERE len(l) > 0
), tf AS (
  SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(l) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY r, t
), w AS (
  SELECT t, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, c GROUP BY t, n_docs
), m AS (
  SELECT r, doc_id, 50 + (50 * len(l) * n_docs) // n_terms AS m FROM d, c WHERE len(l) > 0
), s AS (
  SELECT q.r, q.item_id, m.doc_id, m.r AS d, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM q JOIN tf ON q.t = tf.t JOIN w ON w.t = q.t JOIN m ON m.r = tf.r GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, doc_id NULLS FIRST) <= 50
"""
