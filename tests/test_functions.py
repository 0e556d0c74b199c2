"""Edge cases of the Column helpers (FIXTURES section 3)."""
from decimal import Decimal

from pyspark.sql import functions as F

from marketlens.functions import (change_pct, concat_safe, date_key, days_between, hours_between_boundary,
                                  minutes_between_boundary, months_between_boundary, ratio, rules, share_pct,
                                  sunday_week_of_year, weeks_between_boundary)


def one(spark, **cols):
    return spark.createDataFrame([tuple(cols.values())], list(cols.keys()))


def test_zero_denominator_is_zero_not_error(spark):
    df = one(spark, clicks=0, impressions=0, spend=Decimal("5.00"))
    r = df.select(ratio("clicks", "impressions", "100.0", (10, 4)).alias("ctr"),
                  ratio("spend", "clicks", None, (18, 4)).alias("cpc")).first()
    assert r.ctr == Decimal("0.0000") and r.cpc == Decimal("0.0000")


def test_null_conversions_give_zero_rate(spark):
    df = spark.sql("SELECT CAST(NULL AS DECIMAL(18,6)) AS conv, 10L AS clicks")
    conv = F.coalesce(F.col("conv"), F.lit(0))
    r = df.select(ratio(conv, "clicks", "100.0", (10, 4)).alias("cvr"),
                  ratio("clicks", conv, None, (18, 4)).alias("cpa")).first()
    assert r.cvr == Decimal("0.0000") and r.cpa == Decimal("0.0000")


def test_kpi_rounding_half_up(spark):
    df = one(spark, clicks=1, impressions=3)
    assert df.select(ratio("clicks", "impressions", "100.0", (10, 4)).alias("x")).first().x == Decimal("33.3333")
    df = one(spark, clicks=1, impressions=16)  # 6.25 -> exact; 1/16*100 at 1 decimal would tie
    assert df.select(ratio("clicks", "impressions", "100.0", (10, 1)).alias("x")).first().x == Decimal("6.3")


def test_change_pct_null_when_previous_zero(spark):
    df = one(spark, cur=5, prev=0)
    assert df.select(change_pct("cur", "prev").alias("x")).first().x is None
    df = one(spark, cur=15, prev=10)
    assert df.select(change_pct("cur", "prev").alias("x")).first().x == Decimal("50.00")


def test_share_pct_null_on_zero_total(spark):
    df = one(spark, x=0, tot=0)
    assert df.select(share_pct("x", "tot").alias("s")).first().s is None


def test_concat_safe_treats_null_as_empty(spark):
    df = spark.sql("SELECT CAST(NULL AS STRING) AS a, 'camp' AS b, 'adg' AS c")
    r = df.select(concat_safe("a", F.lit(" > "), "b", F.lit(" > "), "c").alias("p")).first()
    assert r.p == " > camp > adg"


def test_boundary_date_diffs(spark):
    df = spark.sql("""SELECT TIMESTAMP_NTZ'2024-01-31 23:00:00' AS a, TIMESTAMP_NTZ'2024-02-01 01:00:00' AS b,
                             TIMESTAMP_NTZ'2024-01-01 00:59:00' AS h1, TIMESTAMP_NTZ'2024-01-01 01:01:00' AS h2""")
    r = df.select(months_between_boundary("a", "b").alias("m"), days_between("a", "b").alias("d"),
                  hours_between_boundary("h1", "h2").alias("h"), minutes_between_boundary("h1", "h2").alias("mi")).first()
    assert (r.m, r.d, r.h, r.mi) == (1, 1, 1, 2)


def test_sunday_weeks(spark):
    df = spark.sql("SELECT DATE'2024-01-06' AS sat, DATE'2024-01-07' AS sun, DATE'2024-12-30' AS dec30")
    r = df.select(sunday_week_of_year("sat").alias("w1"), sunday_week_of_year("sun").alias("w2"),
                  F.dayofweek("sat").alias("d1"), F.dayofweek("sun").alias("d2"),
                  F.weekofyear("dec30").alias("iso"), sunday_week_of_year("dec30").alias("w53"),
                  weeks_between_boundary("sat", "sun").alias("wb")).first()
    assert (r.w1, r.w2, r.d1, r.d2, r.iso, r.w53, r.wb) == (1, 2, 7, 1, 1, 53, 1)


def test_date_key(spark):
    df = spark.sql("SELECT DATE'2024-03-05' AS d")
    assert df.select(date_key("d").alias("k")).first().k == 20240305


def test_rules_first_match(spark):
    df = spark.createDataFrame([(7,), (8,), (14,), (15,), (30,), (31,)], ["d"])
    c = F.col("d")
    out = [r.s for r in df.select(rules([(c <= 7, "Healthy"), (c <= 14, "Needs Attention"), (c <= 30, "At Risk")],
                                        "Stale").alias("s")).collect()]
    assert out == ["Healthy", "Needs Attention", "Needs Attention", "At Risk", "At Risk", "Stale"]
