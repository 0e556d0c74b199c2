"""Line deduplication against brute force and DuckDB."""
import random

import duckdb
import pyarrow as pa

from marketlens.llm import line_dedup


def brute(rows):
    """rows of (doc_id, text), distinct; the first occurrence of each window of three lines stays."""
    lines = [[ln for ln in (t or "").split("\n") if ln.strip("\x20\t\n\x0b\x0c\r")] if t is not None else [] for _, t in rows]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    seen, out = set(), {}
    for i in order:
        gone = set()
        for p in range(len(lines[i]) - 2):
            w = tuple(lines[i][p:p + 3])
            if w in seen:
                gone |= {p, p + 1, p + 2}
            seen.add(w)
        out[rows[i][0]] = ("\n".join(x for k, x in enumerate(lines[i]) if k not in gone) if gone else rows[i][1], len(gone))
    return out


def sample():
    rnd = random.Random(9)
    pool = [f"line {i}" for i in range(30)] + ["", " "]
    rows = [(i, "\n".join(rnd.choices(pool, k=rnd.randint(0, 14)))) for i in range(80)]
    common_part = "p one\np two\np three\np four"
    rows += [(100 + i, f"a{i}\n{common_part}\n\nb{i}") for i in range(40)] + [(200, rows[0][1]), (201, "A\nA\nA\nA\nA"), (202, None), (203, ""), (204, "\n".join(map(str, range(3000))))]
    return rows


def test_equals_brute_force(spark):
    rows = [*sample(), (None, "n1\nn2\nn3")]
    docs = spark.createDataFrame([(a, b, "x", 3) for a, b in rows], "doc_id long, text string, gone string, pos int")
    out = line_dedup.dedup_lines(docs)
    assert out.columns == [*docs.columns, "removed_lines"]
    got = {r["doc_id"]: (r["text"], r["removed_lines"]) for r in out.collect()}
    assert got == brute(rows)


def test_equals_duckdb(spark):
    rows = [r for r in sample() if r[1] is not None]
    documents = pa.table({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows]})
    con = duckdb.connect()
    con.register("documents", documents)
    want = sorted(con.execute(line_dedup.SQL).fetchall())
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in line_dedup.dedup_lines(docs).collect()) == want


def test_repeated_rows_are_one_document(spark):
    docs = spark.createDataFrame([(1, "a\nb\nc"), (1, "a\nb\nc"), (2, "x\na\nb\nc")], "doc_id long, text string")
    assert sorted(tuple(r) for r in line_dedup.dedup_lines(docs).collect()) == [(1, "a\nb\nc", 0), (1, "a\nb\nc", 0), (2, "x", 3)]


def test_without_repeats_keeps_the_columns(spark):
    docs = spark.createDataFrame([(1, "a\nb\nc", 5, "k"), (2, "a\nb\nc", 5, "k"), (3, "a\nb\nc\nd", 7, None), (4, "", 0, "k"), (5, None, None, "k")], "doc_id long, text string, n_chars int, removed_lines string")
    out = line_dedup.without_repeats(docs)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    assert sorted((r[0], r[1], r[2]) for r in out.collect()) == [(1, "a\nb\nc", 5), (3, "d", 1), (4, "", 0), (5, None, None)]


def test_empty_table(spark):
    assert line_dedup.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = line_dedup.dedup_lines(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
