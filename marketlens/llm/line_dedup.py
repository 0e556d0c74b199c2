"""Line deduplication by overlapping three-line windows, in DataFrame functions only.

Every run of three consecutive lines (lines without a word are skipped) is hashed to 128 bits. A
window found more than once in the corpus keeps its first occurrence, by (doc_id, place); every
later one marks its three lines, the marked positions of a document are merged, and the lines
they cover go. A line that goes always remains at an earlier place.

Defined results: null text stays null and has no line; a text that loses nothing is returned as it
is, one that loses lines also loses its blank lines; texts of fewer than three lines have no window; rows that
repeat an id and its text are one document (equal results, not copies of each other); rows that
share an id but not the text are told apart by the text's hash; null ids come first; an empty
table gives no rows. Further columns pass through under their own names.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

WINDOW = 3


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value`` evaluated once per row (lambdas would otherwise evaluate it per element)."""
    return F.transform(F.array(value), body)[0]


def worded_lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda line: line.rlike(f"[^{common.ASCII_SPACE}]"))


def _windows(text: Column, width: int) -> Column:
    """(hi, lo) hash of every window of ``width`` lines, in order."""
    def body(lines: Column) -> Column:
        at = lambda i: [F.get(lines, i + k) for k in range(width)]
        pair = lambda i: F.struct(F.xxhash64(*at(i)).alias("hi"), F.xxhash64(F.lit(1), *reversed(at(i))).alias("lo"))
        return F.transform(F.when(F.size(lines) >= width, F.sequence(F.lit(0), F.size(lines) - width)), pair)
    return let(worded_lines(text), body)


def covered_lines(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """Rows doc_id, text_hash, gone (array of positions among the worded lines): what later occurrences cover."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(_windows(F.col("text"), width)).alias("pos", "w"))
    rows = rows.select("doc_id", "text_hash", "pos", "w.hi", "w.lo")
    place = F.struct("doc_id", "text_hash", "pos")
    first = rows.groupBy("hi", "lo").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last")
    later = rows.join(first.select("hi", "lo", "first"), ["hi", "lo"]).where(place != F.col("first"))
    gone = F.array_distinct(F.flatten(F.transform(F.collect_set("pos"), lambda p: F.sequence(p, p + (width - 1)))))
    return later.groupBy("doc_id", "text_hash").agg(gone.alias("gone"))


def dedup_lines(docs: DataFrame, width: int = WINDOW, removed: str = "removed_lines") -> DataFrame:
    """``docs`` with the text that remains, and the number of lines that went in column ``removed``."""
    marks = covered_lines(docs, width).select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("gone").alias("__gone"))
    names = {c: common.fresh(docs, c) for c in marks.columns}
    marks = marks.select(*[F.col(c).alias(n) for c, n in names.items()])
    gid, ghash, gone = names.values()
    joined = docs.join(marks, F.col("doc_id").eqNullSafe(F.col(gid)) & (F.xxhash64("text") == F.col(ghash)), "left")
    rest = let(worded_lines(F.col("text")), lambda lines: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone)), lambda i: F.get(lines, i)), "\n"))
    text = F.when(F.col(gone).isNull(), F.col("text")).otherwise(rest)
    return joined.select(*[text.alias(c) if c == "text" else F.col(c) for c in docs.columns],
                         F.coalesce(F.size(gone), F.lit(0)).cast("long").alias(removed))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` after line deduplication: documents of which nothing is left go, n_chars is that of the new text."""
    count = common.fresh(docs, "removed_lines")
    out = dedup_lines(docs, removed=count).where((F.col(count) == 0) | (F.col("text") != ""))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col(count) > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


#: DuckDB SQL of the same result over ``documents``.
SQL = r"""
WITH lines AS (
  SELECT DISTINCT doc_id, text, [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS l FROM documents
), win AS (
  SELECT doc_id, text, p, [l[p + 1], l[p + 2], l[p + 3]] AS w FROM (SELECT doc_id, text, l, unnest(range(0, greatest(len(l) - 2, 0))) AS p FROM lines)
), ranked AS (
  SELECT doc_id, text, p, row_number() OVER (PARTITION BY w ORDER BY doc_id, p) AS k FROM win
), gone AS (
  SELECT doc_id, text, list_distinct(flatten(list([p, p + 1, p + 2]))) AS g FROM ranked WHERE k > 1 GROUP BY doc_id, text
), cut AS (
  SELECT l.doc_id, l.text, len(g.g) AS n, array_to_string([l.l[i + 1] FOR i IN range(0, len(l.l)) IF NOT list_contains(g.g, i)], chr(10)) AS rest
  FROM lines l JOIN gone g ON l.doc_id = g.doc_id AND l.text = g.text
)
SELECT d.doc_id, CASE WHEN c.n IS NULL THEN d.text ELSE c.rest END AS text, CAST(coalesce(c.n, 0) AS BIGINT) AS removed_lines
FROM documents d LEFT JOIN cut c ON d.doc_id = c.doc_id AND d.text = c.text
"""
