"""Every registered query against its DuckDB oracle on the smallest driver tables."""
import os

import duckdb
import pytest

import sys
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import __spark_entry__ as E  # noqa: E402
from marketlens.registry import REGISTRY  # noqa: E402
from oracle_check import _SPARK2DUCK, TABLES, key_of, norm  # noqa: E402

SF = "/root/testdata/sf0.001"
KEYS = sorted(k for k in REGISTRY if k in E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    names = df.columns
    srows = df.collect()
    res = con.execute(E.oracle_sql()[key])
    dnames = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(names) == sorted(dnames)
    assert len(srows) == len(drows)
    dtypes = {d[0]: str(d[1]) for d in con.execute(f"SELECT * FROM ({E.oracle_sql()[key]}) LIMIT 0").description}
    for f in df.schema.fields:
        st = f.dataType.simpleString()
        want, got = _SPARK2DUCK.get(st, st.upper()), dtypes[f.name]
        if want.startswith("DECIMAL") and got.startswith("DECIMAL"):
            assert want.split(",")[1] == got.split(",")[1], f"{f.name}: {st} vs {got}"  # same scale
        else:
            assert want == got, f"{f.name}: {st} vs {got}"
    order = sorted(range(len(names)), key=lambda i: names[i])
    dorder = [dnames.index(names[i]) for i in order]
    a = sorted((tuple(norm(r[i]) for i in order) for r in srows), key=key_of)
    b = sorted((tuple(norm(r[i]) for i in dorder) for r in drows), key=key_of)
    assert a == b


ORDERED = {"q_weekly_wow_yoy": [("year", False), ("week_of_year", False)], "q_monthly_mom_yoy": [("year", False), ("month_number", False)],
           "q_weekly_wow_yoy_long": [("year", False), ("week_of_year", False)], "q_monthly_mom_yoy_long": [("year", False), ("month_number", False)],
           "q_day_of_week": [("campaign_name", True), ("day_of_week", True)], "q_daily_trend": [("date", True)]}


@pytest.mark.parametrize("key", sorted(ORDERED))
def test_final_order(spark, key):
    rows = [tuple((r[c] is not None, r[c]) for c, _ in ORDERED[key]) for r in E.queries()[key](spark, SF).collect()]
    ascending = ORDERED[key][0][1]
    assert rows and rows == sorted(rows, reverse=not ascending)


def test_top_keywords_is_a_top_10(spark):
    assert E.queries()["q_top_keywords"](spark, SF).count() == 10


def test_rank_queries_start_no_job_before_an_action(spark):
    sc = spark.sparkContext
    sc.setJobGroup("lazy-queries", "plans only")
    try:
        for key in ("keyword_top_performers", "campaign_trend_analysis", "ad_group_drilldown", "p_global_ranks", "q_owner_leaderboard"):
            E.queries()[key](spark, SF)
        tracker = sc.statusTracker()
        infos = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("lazy-queries")]
        # one-stage jobs read Parquet footers for the schema; nothing is shuffled before an action
        assert all(len(i.stageIds) == 1 for i in infos if i is not None)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
