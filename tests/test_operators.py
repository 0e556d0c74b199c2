"""DataFrame operators: latest record, dimension attach, global ranks, fan-out weights."""
import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from marketlens.operators.dims import attach
from marketlens.operators.latest import latest_by_key, not_deleted
from marketlens.operators.ranks import dense_ranks_within, global_ranks, top_n
from marketlens.operators.shares import with_group_aggs


def test_latest_by_key_and_deleted_rules(spark):
    rows = [(1, "b", dt.datetime(2024, 1, 3), True), (1, "a", dt.datetime(2024, 1, 2), False),
            (2, "x", dt.datetime(2024, 1, 2), None)]
    h = spark.createDataFrame(rows, "id long, name string, _fivetran_synced timestamp_ntz, _fivetran_deleted boolean")
    search = {r.id: r.name for r in latest_by_key(h, "id").collect()}
    social = {r.id: r.name for r in latest_by_key(h, "id", where=not_deleted(lenient=True)).collect()}
    assert search == {1: "b", 2: "x"}          # no delete rule: deleted latest version still used
    assert social == {1: "a", 2: "x"}          # lenient rule: falls back, NULL flag kept


def test_attach_keeps_facts_without_dimension(spark):
    fact = spark.createDataFrame([(1, 10), (9, 5)], "k long, v long")
    dim = spark.createDataFrame([(1, "one")], "k long, name string")
    out = {r.k: r.name for r in attach(fact, dim, "k", {"name": "name"}).collect()}
    assert out == {1: "one", 9: None}


def _plain(df, order, kind):
    fn = {"dense": F.dense_rank, "rank": F.rank, "percent": F.percent_rank}[kind]
    cols = [F.col(c).asc_nulls_first() if asc else F.col(c).desc_nulls_last() for c, asc in order]
    return df.select("id", fn().over(Window.orderBy(*cols)).alias("r"))


def test_bucketed_global_ranks_equal_single_partition_window(spark):
    rnd = random.Random(7)
    rows = [(i, rnd.choice([None] + list(range(40))), rnd.randint(0, 5)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, v long, w long")
    specs = {"d_desc": ("dense", [("v", False)]), "d_asc": ("dense", [("v", True), ("w", False)]),
             "r": ("rank", [("v", True)]), "p": ("percent", [("v", False)])}
    got = global_ranks(df, specs, buckets=6).collect()
    for name, (kind, order) in specs.items():
        want = {r.id: r.r for r in _plain(df, order, kind).collect()}
        assert {r.id: r[name] for r in got} == want, name


def test_dense_rank_ties_and_single_row(spark):
    df = spark.createDataFrame([(1, 10), (2, 10), (3, 8)], "id long, v long")
    out = {r.id: r.d for r in global_ranks(df, {"d": ("dense", [("v", False)])}).collect()}
    assert out == {1: 1, 2: 1, 3: 2}
    one = spark.createDataFrame([(1, 5)], "id long, v long")
    assert global_ranks(one, {"p": ("percent", [("v", True)])}).first().p == 0.0


def test_share_of_total_via_one_row_aggregate(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3)], "k string, x long")
    out = {r.k: r.t for r in with_group_aggs(df, [], {"t": F.sum("x")}).collect()}
    assert out == {"a": 4, "b": 4}


def test_bucketed_partitioned_ranks_equal_windows(spark):
    rnd = random.Random(11)
    # one hot partition ("hot"), a NULL partition, and many small ones
    rows = [(i, rnd.choice(["hot"] * 6 + [None, "a", "b", "c"]), rnd.choice([None] + list(range(25))),
             rnd.randint(0, 3)) for i in range(2500)]
    df = spark.createDataFrame(rows, "id long, p string, v long, w long")
    got = dense_ranks_within(df, ["p"], {"r1": [("v", False)], "r2": [("w", True), ("v", False)]}, buckets=5).collect()
    for name, order in {"r1": [("v", False)], "r2": [("w", True), ("v", False)]}.items():
        cols = [F.col(c).asc_nulls_first() if asc else F.col(c).desc_nulls_last() for c, asc in order]
        want = {r.id: r.r for r in df.select("id", F.dense_rank().over(Window.partitionBy("p").orderBy(*cols)).alias("r")).collect()}
        assert {r.id: r[name] for r in got} == want, name


def test_ranks_are_lazy(spark):
    df = spark.createDataFrame([(i, i % 7, "a") for i in range(50)], "id long, v long, p string")
    sc = spark.sparkContext
    sc.setJobGroup("lazy-ranks", "plan only")
    try:
        global_ranks(df, {"d": ("dense", [("v", False)]), "p2": ("percent", [("v", True)])})
        dense_ranks_within(df, ["p"], {"r": [("v", False)]})
        assert list(sc.statusTracker().getJobIdsForGroup("lazy-ranks")) == []
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_a_value_shared_by_most_rows_spans_many_ranges(spark):
    from marketlens.operators.ordered import spread
    from marketlens.operators.ranks import _unpivoted
    df = spark.createDataFrame([(i, 0 if i % 50 else 1) for i in range(4000)], "id long, v long")
    rows = _unpivoted(spread(df), [[("v", False)]], 8)
    assert max(r["count"] for r in rows.groupBy("_j", "_b").count().collect()) < 1200


def test_ranks_of_ties_across_ranges_and_repeated_rows(spark):
    rnd = random.Random(3)
    # nearly all rows share one value, and rows repeat as a whole
    rows = [(i % 700, rnd.choice(["x"] * 8 + ["y", None]), rnd.choice([0] * 9 + [1, None])) for i in range(2100)]
    df = spark.createDataFrame(rows, "id long, p string, v long")
    got = global_ranks(df, {"r": ("rank", [("v", False)]), "d": ("dense", [("v", True)]), "q": ("percent", [("v", True), ("id", False)])}, buckets=9)
    w = lambda *o: Window.orderBy(*o)
    want = df.select("*", F.rank().over(w(F.desc("v"))).alias("r"), F.dense_rank().over(w(F.asc("v"))).alias("d"),
                     F.percent_rank().over(w(F.asc("v"), F.desc("id"))).alias("q"))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    within = dense_ranks_within(df, ["p"], {"r": [("v", False)], "s": [("id", True)]}, buckets=9)
    inside = Window.partitionBy("p")
    want = df.select("*", F.dense_rank().over(inside.orderBy(F.desc("v"))).alias("r"), F.dense_rank().over(inside.orderBy("id")).alias("s"))
    assert sorted(map(repr, within.collect())) == sorted(map(repr, want.collect()))


def test_top_n_breaks_ties_by_the_order(spark):
    df = spark.createDataFrame([(i, i % 2) for i in range(20)], "id long, v long")
    assert [r.id for r in top_n(df, [("v", False), ("id", True)], 3).collect()] == [1, 3, 5]


def test_attach_can_ignore_case(spark):
    fact = spark.createDataFrame([("Ab", 1), ("x", 2), (None, 3)], "k string, v long")
    dim = spark.createDataFrame([("aB", "one")], "k string, name string")
    out = {r.k: r.name for r in attach(fact, dim, "k", {"name": "name"}, ignore_case=True).collect()}
    assert out == {"Ab": "one", "x": None, None: None}
    assert {r.name for r in attach(fact, dim, "k", {"name": "name"}).collect()} == {None}


def test_dimensions_that_grow_are_merged_whatever_the_estimate_says(spark, tmp_path):
    """The size estimate does not count exploded rows: a small file can stand for a dimension that the driver cannot hold."""
    from marketlens.operators.dims import attach
    from marketlens.plans.search_ads import keyword_top_performers
    from marketlens.sources.roles import ADS_AS_OF, DriverTables
    spark.range(20).selectExpr("id s_suppkey", "concat('Supplier#', id) s_name").write.parquet(str(tmp_path / "supplier.parquet"))
    spark.range(200).selectExpr("id % 40 l_partkey", "id % 20 l_suppkey", "int(id % 7) l_linenumber", "double(id % 50 + 1) l_quantity", "100.0d + id l_extendedprice",
                                "0.05d l_discount", "if(id % 3 = 0, 'R', 'N') l_returnflag", "'O' l_linestatus", "timestamp'1995-04-20 00:00:00' l_shipdate") \
        .write.parquet(str(tmp_path / "lineitem.parquet"))
    found = keyword_top_performers(DriverTables(spark, str(tmp_path)), ADS_AS_OF)
    joins = [line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "LeftOuter" in line]
    by = lambda key: {line.split("Join")[0].split()[-1] for line in joins if f"Join [{key}#" in line}
    assert by("criterion_id") == by("ad_group_id") == {"SortMerge"}
    rows = found.collect()
    assert len({r.keyword_id for r in rows}) == len(rows) == 40 and {r.keyword_text for r in rows if r.keyword_id == 3003} == {"kw-3-3"}
    # without a match, and keys without regard to case
    fact, dim = spark.createDataFrame([("A", 1), ("b", 2), ("c", 3), (None, 4)], "k string, v int"), spark.createDataFrame([("a", "x"), ("B", "y")], "k string, w string")
    assert sorted((r.v, r.w) for r in attach(fact, dim, "k", ["w"], ignore_case=True, grows=True).collect()) == [(1, "x"), (2, "y"), (3, None), (4, None)]
