"""Scans over a whole order, filter contexts, hierarchies, mergeable distincts, relationship paths."""
import datetime as dt
import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from marketlens.operators.context import ALL, Measure, average_of, evaluate, is_, rows_of, sum_of
from marketlens.operators.distincts import distinct_count, distinct_state, merge_state
from marketlens.operators.hierarchy import drill_down
from marketlens.operators.scan import look_back, running_totals
from marketlens.plans.model import AmbiguousPath, Model, Relationship


def rows_of_frame(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def test_scans_equal_plain_windows(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.choice([None, 1, 2, 2, 2, 2]), rnd.choice([None, 1, 5, 7])) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, k int, x long").withColumn("d", F.col("x").cast("decimal(12,2)") / 4)
    got = running_totals(df, [("k", False), ("id", True)], {"t": "x", "td": "d"}, "pos", buckets=7)
    got = look_back(got, "pos", {"ma": ("x", 5)}, {"l1": ("id", 1), "l9": ("x", 9)}, chunk_rows=40)
    w = Window.orderBy(F.col("k").desc_nulls_last(), "id")
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = df.select("*", F.sum("x").over(so_far).alias("t"), F.sum("d").over(so_far).alias("td"), F.row_number().over(w).cast("long").alias("pos"),
                     F.avg("x").over(w.rowsBetween(-4, 0)).alias("ma"), F.lag("id", 1).over(w).alias("l1"), F.lag("x", 9).over(w).alias("l9"))
    assert rows_of_frame(got.select(*want.columns)) == rows_of_frame(want)
    assert dict(got.dtypes) == dict(want.dtypes)
    assert running_totals(df.where("false"), [("id", True)], {"t": "x"}).count() == 0


def test_a_million_rows_without_a_one_task_window(spark):
    df = spark.range(1_000_000).select(F.col("id"), F.lit(1).alias("same"), (F.col("id") % 10).alias("x"))
    out = running_totals(df, [("same", True), ("id", True)], {"t": "x"}, "pos")
    out = look_back(out, "pos", {}, {"before": ("id", 1)})
    got = out.agg(F.count("*"), F.max("t"), F.sum(F.when(F.col("pos") != F.col("id") + 1, 1).otherwise(0)),
                  F.sum(F.when(F.col("before") != F.col("id") - 1, 1).otherwise(0)), F.count("before")).first()
    assert tuple(got) == (1_000_000, 4_500_000, 0, 0, 999_999)
    plan = running_totals(df, [("id", True)], {"t": "x"})._jdf.queryExecution().executedPlan().toString()
    # the one window without a partition runs over one row a range
    loose = [line for line in plan.splitlines() if "Window [" in line and "_b#" not in line]
    assert not loose and "Exchange rangepartitioning" not in plan


def brute_measures(rows, by, measures):
    """measures: name -> (function of rows, {column: predicate or None}); rows are dicts."""
    out = []
    for key in {tuple(r[b] for b in by) for r in rows}:
        line = list(key)
        for fn, filters in measures.values():
            kept = [r for r in rows if all(r[b] == k for b, k in zip(by, key) if b not in filters)]
            line.append(fn([r for r in kept if all(p is None or (r[c] is not None and p(r[c])) for c, p in filters.items())]))
        out.append(tuple(line))
    return sorted(map(repr, out))


@pytest.mark.parametrize("by", [["a"], ["a", "b"], ["b", "c", "a"], ["c"], ["d"]])
def test_measures_replace_the_axis_on_their_columns(spark, by):
    rnd = random.Random(9)
    rows = [{"a": rnd.choice([0, 1, None]), "b": rnd.choice(["x", "y"]), "c": rnd.choice([1, 2, 3, None]), "d": 5, "v": rnd.choice([None, 1, 2, 3])} for _ in range(60)]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "a int, b string, c int, d int, v long")
    big = Measure(lambda kept: F.sum(kept(F.col("v"))), {"c": lambda c: c >= 2})
    measures = {"n": rows_of(), "ones": rows_of(a=is_(1)), "both": rows_of(a=is_(0), b=is_("x")), "big": big, "free": rows_of(a=ALL, b=ALL),
                "nested": rows_of(a=is_(1)).within({"a": is_(0), "c": is_(2)}), "s": sum_of("v", b=is_("y"))}
    total = lambda rs: sum(r["v"] for r in rs if r["v"] is not None) if any(r["v"] is not None for r in rs) else None
    want = {"n": (len, {}), "ones": (len, {"a": lambda x: x == 1}), "both": (len, {"a": lambda x: x == 0, "b": lambda x: x == "x"}), "big": (total, {"c": lambda x: x >= 2}),
            "free": (len, {"a": None, "b": None}), "nested": (len, {"a": lambda x: x == 1, "c": lambda x: x == 2}), "s": (total, {"b": lambda x: x == "y"})}
    got = evaluate(df, measures, by)
    assert sorted(repr(tuple(r)) for r in got.select(*by, *measures).collect()) == brute_measures(rows, by, want)


def test_measures_without_axis_and_derived(spark):
    df = spark.createDataFrame([(1, 10), (0, 4)], "won int, v long")
    out = evaluate(df, {"_w": rows_of(won=is_(1)), "n": rows_of(), "avg": average_of("v")}, (), {"rate": lambda: F.col("_w") / F.col("n")})
    assert out.columns == ["n", "avg", "rate"] and tuple(out.first()) == (2, 7.0, 0.5)
    assert evaluate(df.where("false"), {"n": rows_of(), "w": rows_of(won=is_(1))}, ["won"]).count() == 0


def test_drill_down_keeps_null_members_apart_from_totals(spark):
    rows = [("a", "x", 1), ("a", None, 2), (None, None, 4), (None, "x", 8), ("a", "x", 16)]
    df = spark.createDataFrame(rows, "p string, q string, v long")
    got = {(r["level"], r["p"], r["q"]): (r["t"], r["parent_t"]) for r in drill_down(df, ["p", "q"], {"t": "v"}, parents=["t"]).collect()}
    assert got == {(0, None, None): (31, None), (1, "a", None): (19, 31), (1, None, None): (12, 31), (2, "a", "x"): (17, 19), (2, "a", None): (2, 19),
                   (2, None, None): (4, 12), (2, None, "x"): (8, 12)}


def test_distinct_states_merge_exactly(spark):
    rnd = random.Random(2)
    rows = [(rnd.randrange(6), rnd.choice([None, 0, -5, 1, 32768, 32769, 10**12 + rnd.randrange(50), rnd.randrange(70_000)])) for _ in range(4000)]
    df = spark.createDataFrame(rows, "day int, m long")
    state = distinct_state(df, ["day"], "m")
    for days in ({0}, {1, 2, 3}, set(range(6))):
        got = distinct_count(state, [], "n", F.col("day").isin(*days)).first()["n"]
        assert got == len({m for d, m in rows if d in days and m is not None})
    halves = merge_state(distinct_state(df.where("day < 3"), ["day"], "m").union(distinct_state(df.where("day > 1"), ["day"], "m")), ["day"])
    assert {r["day"]: r["n"] for r in distinct_count(halves, ["day"], "n").collect()} == {d: len({m for e, m in rows if e == d and m is not None}) for d in range(6)}


def test_filters_travel_paths_and_ambiguity_is_an_error(spark):
    region = spark.createDataFrame([(1, "north"), (2, "south"), (None, "nowhere")], "rid int, rname string")
    shop = spark.createDataFrame([(10, 1), (11, 2), (12, None), (10, 1)], "sid int, rid int")  # a key that repeats multiplies nothing
    sale = spark.createDataFrame([(10, 5, 1), (11, 7, 1), (12, 9, 2), (None, 1, 2), (10, 3, 2)], "sid int, v int, rid2 int")
    rel = [Relationship("SaleShop", "sale", "sid", "shop", "sid"), Relationship("ShopRegion", "shop", "rid", "region", "rid"), Relationship("SaleRegion", "sale", "rid2", "region", "rid")]
    model = Model({"region": lambda: region, "shop": lambda: shop, "sale": lambda: sale}, rel)
    with pytest.raises(AmbiguousPath, match=re.escape("SaleRegion; SaleShop > ShopRegion")):
        model.filtered("sale", {"region": {"rname": "north"}})
    with pytest.raises(ValueError, match="no relationship"):
        model.filtered("region", {"sale": {"v": 5}})
    chain = ["SaleShop", "ShopRegion"]
    assert sorted(r.v for r in model.filtered("sale", {"region": {"rname": "north"}}, chain).collect()) == [3, 5]
    assert sorted(r.v for r in model.filtered("sale", {"region": {"rname": "south"}}, ["SaleRegion"]).collect()) == [1, 3, 9]
    assert sorted(r.v for r in model.filtered("sale", {"region": {"rname": ["north", "south"]}, "sale": {"v": (4, None)}}, chain).collect()) == [5, 7]
    names = {(r.v, r.where_) for r in model.related("sale", "region", {"rname": "where_"}, chain).select("v", "where_").collect()}
    assert names == {(5, "north"), (3, "north"), (7, "south"), (9, None), (1, None)}


def test_every_plan_of_the_new_operators_is_lazy(spark):
    sc = spark.sparkContext
    sc.setJobGroup("lazy-scan", "plan only")
    try:
        df = spark.createDataFrame([(i, dt.date(2024, 1, 1 + i % 9)) for i in range(40)], "id long, d date")
        look_back(running_totals(df, [("d", True)], {"t": "id"}), "position", {"m": ("id", 3)}, {})
        assert list(sc.statusTracker().getJobIdsForGroup("lazy-scan")) == []
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
