"""Property checks on the smallest driver tables, plus a randomized
check of the KPI ratio against exact decimal arithmetic."""
import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketlens.functions import ratio
from marketlens.operators.latest import latest_by_key
from marketlens.plans import engagements, search_ads
from marketlens.sources.roles import ADS_AS_OF, CRM_AS_OF, DriverTables

SF = "/root/testdata/sf0.001"


def test_shares_sum_to_100_per_parent(spark):
    d = search_ads.ad_group_drilldown(DriverTables(spark, SF), ADS_AS_OF)
    sums = d.groupBy("campaign_id").agg(F.sum("pct_of_campaign_spend").alias("s"), F.count(F.lit(1)).alias("n"),
                                        F.sum("total_spend").alias("spend")).collect()
    for r in sums:
        if r.spend:  # each share is rounded to 2 places: at most n * 0.005 off
            assert abs(r.s - 100) <= Decimal("0.005") * r.n


def test_dense_ranks_start_at_one_without_gaps(spark):
    k = search_ads.keyword_top_performers(DriverTables(spark, SF), ADS_AS_OF)
    for col in ["conversions_rank", "spend_rank", "roas_rank", "efficiency_rank"]:
        ranks = sorted({r[0] for r in k.select(col).distinct().collect()})
        assert ranks == list(range(1, len(ranks) + 1)), col


def test_latest_by_key_at_most_one_row_per_key(spark):
    t = DriverTables(spark, SF)
    for name, key in [("campaign_history", "campaign_id"), ("ad_group_criterion_history", "criterion_id")]:
        df = latest_by_key(t[name], key)
        assert df.groupBy(key).count().filter("count > 1").count() == 0
        assert df.count() == t[name].select(key).distinct().count()


def test_base_view_keeps_every_fact_row(spark):
    t = DriverTables(spark, SF)
    assert search_ads.campaign_performance(t).count() == t["campaign_stats"].count()
    assert search_ads.keyword_performance(t).count() == t["keyword_stats"].count()


def test_dedup_never_exceeds_faithful_fanout(spark):
    t = DriverTables(spark, SF)
    a = {r.owner_id: r.total_call_minutes for r in engagements.engagement_owner_summary(t, CRM_AS_OF).collect()}
    b = {r.owner_id: r.total_call_minutes for r in engagements.engagement_owner_summary_dedup(t, CRM_AS_OF).collect()}
    assert a.keys() == b.keys()
    assert all((b[k] or 0) <= (a[k] or 0) for k in a)


def test_period_sums_are_additive(spark):
    t = DriverTables(spark, SF)
    s = {r.account_id: r.current_spend for r in search_ads.account_performance_summary(t, ADS_AS_OF).collect()}
    start = ADS_AS_OF - dt.timedelta(days=30)
    direct = search_ads.account_performance(t).filter((F.col("date") >= F.lit(start)) & (F.col("date") < F.lit(ADS_AS_OF))) \
        .groupBy("account_id").agg(F.sum("spend").alias("s")).collect()
    assert {r.account_id: r.s for r in direct} == s


def _half_up(num: int, den: int, scale: int) -> Decimal:
    q = Decimal(num) * 100 / Decimal(den)
    return q.quantize(Decimal(1).scaleb(-scale), rounding=ROUND_HALF_UP)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**9), st.integers(1, 10**9)), min_size=1, max_size=20))
def test_ratio_is_exact_half_up(spark, pairs):
    df = spark.createDataFrame(pairs, "n long, d long")
    got = [r.x for r in df.select(ratio("n", "d", "100.0", (38, 4)).alias("x")).collect()]
    assert got == [_half_up(n, d, 4) for n, d in pairs]
